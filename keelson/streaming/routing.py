"""One stream, many tables: route messages by topic inside ``foreachBatch``
and write each table's batch idempotently."""

from __future__ import annotations

from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.operators import cdc
from keelson.sinks import versioned
from keelson.spec import TableSpec


def batch_partition_writer(base_path: str, fmt: str = "parquet") -> Callable[[DataFrame, str, int], None]:
    """Write a batch to ``base_path/<table>/batch_id=<n>`` by overwrite: a
    replayed batch rewrites the same partition, so the table holds each
    batch exactly once without a transactional table format."""
    def write(df: DataFrame, table: str, batch_id: int) -> None:
        (df.write.mode("overwrite").format(fmt)
         .save(f"{base_path.rstrip('/')}/{table}/batch_id={batch_id}"))
    return write


def batch_partition_reader(spark, base_path: str, fmt: str = "parquet") -> Callable[[str, int], DataFrame | None]:
    """What ``batch_partition_writer`` wrote for a table before a batch, or
    None before its first write."""
    def read(table: str, batch_id: int) -> DataFrame | None:
        try:
            t = spark.read.format(fmt).load(f"{base_path.rstrip('/')}/{table}")
        except AnalysisException:
            return None
        return t.filter(F.col("batch_id") < batch_id)
    return read


def topic_router(specs: dict[str, TableSpec], writer: Callable[[DataFrame, str, int], None],
                 topic_col: str = "topic", reader: Callable[[str, int], DataFrame | None] | None = None,
                 delay_seconds: int | None = 86_400, unknown: str = "_unknown_topics") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: for each topic, parse its messages with the
    table's spec (deletes kept), drop repeated deliveries, write.

    Repeats are dropped inside the batch and, with a ``reader`` of what was
    written, against earlier batches by change id.  As with a watermark, that
    looks back a bounded time: at changes at most ``delay_seconds`` older
    than the batch's oldest, so that a batch's work follows the batch; None
    compares with all that was ever written.  Messages of topics without a spec go, as they came, to the table
    ``unknown``."""
    def route(batch: DataFrame, batch_id: int) -> None:
        batch.persist()          # read the micro-batch once for all tables
        try:
            for topic, spec in specs.items():
                part = batch.filter(F.col(topic_col) == topic)
                rows = cdc.dedupe_changes(cdc.parse_changes(part, spec).drop("_before", "_no_before"), spec)
                seen = reader(spec.name, batch_id) if reader else None
                if seen is not None:
                    if delay_seconds is not None:
                        oldest = rows.agg(F.min("kafka_timestamp")).first()[0]
                        if oldest is not None:
                            seen = seen.filter(F.col("kafka_timestamp") >= F.lit(oldest) - F.make_dt_interval(secs=F.lit(delay_seconds)))
                    ids = [*spec.key, *spec.change_id]
                    known = seen.select(*[F.col(c).alias(f"__s_{c}") for c in ids])
                    rows = rows.join(known, [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in ids], "left_anti")
                writer(rows, spec.name, batch_id)
            rest = batch.filter(F.col(topic_col).isNull() | ~F.col(topic_col).isin(list(specs)))
            if rest.limit(1).count():
                writer(rest, unknown, batch_id)
        finally:
            batch.unpersist()
    return route


def first_per_key(raw: DataFrame, spec: TableSpec, order: tuple[str, ...] = ("source_lsn", "source_ts_ms", "kafka_timestamp")) -> DataFrame:
    """One row per key, that of its least change by ``order``, as a streaming
    aggregate (``update`` mode): a batch gives the keys whose first change
    it has moved.  Neither the number of splits nor the order of rows or
    batches matters.  The state holds a row per key."""
    rows = cdc.parse_envelope(raw, spec)
    rest = [c for c in rows.columns if c not in spec.key]
    first = rows.groupBy(*spec.key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return first.select(*spec.key, *[F.col(f"__r.{c}").alias(c) for c in rest])


def keyed_writer(spec: TableSpec, root: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for ``update`` mode: each row replaces its
    key's row in a table cut by key bucket (``sinks.versioned``).  Only the
    buckets that a batch touches are read and written; a replayed batch
    writes the same rows again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
            if old is None:
                return new
            keys = new.select(*spec.key)
            return old.join(keys, list(spec.key), "left_anti").select(*new.columns).unionByName(new)
        versioned.merge_buckets(batch.sparkSession, root, batch, spec.key, merge, buckets)
    return write
