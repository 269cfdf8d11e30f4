"""Table and reference-data readers."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Current snapshot of a table, through the table format."""
    return spark.read.format(fmt).load(path)


def jdbc_options(url: str, table: str, *, user_env: str = "JDBC_USER", password_env: str = "JDBC_PASSWORD",
                 partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, fetchsize: int = 10000, driver: str | None = None) -> dict:
    """Options for a (partitioned) JDBC read.  Credentials are taken from
    environment variables named by the caller, never from code.  With a
    partition column, Spark issues ``num_partitions`` range queries in
    parallel instead of one full-table query."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    if os.environ.get(user_env):
        opts["user"] = os.environ[user_env]
    if os.environ.get(password_env):
        opts["password"] = os.environ[password_env]
    if driver:
        opts["driver"] = driver
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                    numPartitions=str(num_partitions))
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """Reference table over JDBC; filters and column selections applied to
    the result are pushed into the database query by Spark."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()


def spread(df: DataFrame, min_bytes: int = 1 << 20, size_hint: int | None = None) -> DataFrame:
    """Spread a scan that has fewer splits than the cluster has cores.

    A large table on a cluster comes in many files / row groups, so its scan
    already has thousands of splits and this is a no-op.  A single-row-group
    file (as in small local test sets) is read by one task; when it is
    larger than ``min_bytes`` a round-robin repartition to the default
    parallelism lets the per-row work after the scan use every core.
    """
    sc = df.sparkSession.sparkContext
    if size_hint is not None and size_hint < min_bytes:
        return df
    if df.rdd.getNumPartitions() >= sc.defaultParallelism:
        return df
    return df.repartition(sc.defaultParallelism)
