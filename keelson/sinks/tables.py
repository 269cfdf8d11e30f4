"""Batch sinks: full overwrite, dynamic partition overwrite, split write.

The table format is a parameter (``parquet`` here; ``delta`` / ``iceberg``
where their jars are deployed)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
              sort_within: Sequence[str] = ()) -> None:
    """Replace the table.  ``sort_within`` clusters rows inside each file
    (tighter min/max statistics for data skipping)."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace only the partitions present in ``df`` (incremental loads)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(fmt).partitionBy(*partition_by).save(path))


def write_split(checked: DataFrame, path: str, fmt: str = "parquet") -> tuple[str, str]:
    """Valid and quarantined rows in one job: the checked frame is written
    once, partitioned by ``_valid``; returns the two partition paths."""
    checked.write.mode("overwrite").format(fmt).partitionBy("_valid").save(path)
    base = path.rstrip("/")
    return f"{base}/_valid=true", f"{base}/_valid=false"


def read(spark, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Read a table through its format (never by globbing data files), so an
    overwrite is seen as the new content only.

    Schema evolution is additive: with ``merge_schema`` files written before
    a column was added read it as NULL; a column whose type changed is an
    error, not a silent cast.  Off by default: merging reads every file
    footer, so turn it on for tables whose schema has evolved."""
    r = spark.read.format(fmt)
    if fmt == "parquet" and merge_schema:
        r = r.option("mergeSchema", "true")
    return r.load(path)


def with_month(df: DataFrame, ts_col: str, out: str = "month") -> DataFrame:
    """Month partition column (yyyy-MM) for fact tables."""
    return df.withColumn(out, F.date_format(F.col(ts_col), "yyyy-MM"))


def compact(spark, src: str, dst: str, target_files: int, fmt: str = "parquet",
            cluster_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
    """Rewrite a table of many small files (streaming appends, per-batch
    partitions) into ``target_files`` files per output partition.  With
    ``cluster_by`` the rows are range-partitioned and sorted on those
    columns, which keeps per-file min/max statistics tight for data
    skipping.  Without a transactional format the result goes to a new
    location (``dst``); readers switch to it once it is written."""
    df = spark.read.format(fmt).load(src)
    if cluster_by:
        df = df.repartitionByRange(target_files, *cluster_by).sortWithinPartitions(*cluster_by)
    else:
        df = df.repartition(target_files)
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(dst)


def save_bucketed(df: DataFrame, name: str, path: str, key: Sequence[str], buckets: int, fmt: str = "parquet") -> None:
    """Store a table cut and sorted by key hash under a catalog name: two
    tables with the same cut join on the key without a shuffle."""
    (df.repartition(buckets, *key).write.format(fmt).mode("overwrite").option("path", path)
     .bucketBy(buckets, *key).sortBy(*key).saveAsTable(name))


def buckets_for(rows: int, per_bucket: int = 5_000_000, least: int = 8, most: int = 65_536) -> int:
    """Buckets for a table of so many rows: a power of two, so that a table
    that has grown can be cut anew into multiples of its old buckets."""
    n = least
    while n < most and n * per_bucket < rows:
        n *= 2
    return n
