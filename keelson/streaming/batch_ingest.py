"""Bronze ingest in ``foreachBatch``: dedupe with a map-side combine and a
late-rows side table.

Per micro-batch:

1. parse the messages, drop repeated deliveries inside the batch
   (``dedupe_changes``: an aggregate, so a huge group of copies of one
   change collapses map-side before the shuffle);
2. watermark = latest transport time the table has seen (a small file in
   ``_progress``, replaced by each batch) minus the delay;
3. rows older than the watermark are late (repeats included, as with any
   watermark) and go to the late table;
4. on-time rows already written are dropped: an anti join with the
   table's change ids at or after the watermark (of the day folders from
   the watermark's on; no other folder is listed);
5. both outputs are ``batch_id=<n>`` partitions written by overwrite, so
   a replayed batch rewrites the same rows (exactly once).

Only scalars reach the driver (the watermark, one timestamp per batch).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.operators import cdc
from keelson.sinks import versioned
from keelson.spec import TableSpec


def dedupe_batch_writer(spec: TableSpec, table_path: str, late_path: str, delay_seconds: int = 600,
                        fmt: str = "parquet", keep_deletes: bool = False):
    """``foreachBatch`` function implementing the steps above.
    ``keep_deletes`` keeps delete events (key from the before image), as in
    ``ingest.bronze_stream``."""
    ids = [*spec.key, *spec.change_id]

    def parse(batch: DataFrame) -> DataFrame:
        if not keep_deletes:
            return cdc.parse_envelope(batch, spec)
        return cdc.parse_changes(batch, spec).drop("_before", "_no_before")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = cdc.dedupe_changes(parse(batch), spec).withColumn(
            "event_date", F.to_date("kafka_timestamp"))
        # progress: the latest transport time before each of the last two batches
        # (a replayed batch finds what it found the first time)
        progress = versioned.pointer(spark, f"{table_path}/_progress")
        earlier = [(int(b), t) for b, t in progress.items() if int(b) < batch_id]
        prior = _dt.datetime.fromisoformat(max(earlier)[1]) if earlier else None
        wm = prior - _dt.timedelta(seconds=delay_seconds) if prior is not None else None
        if wm is not None:
            # a watermark exists only after a batch wrote on-time rows, so the table exists
            # on-time rows lie between the watermark and the latest time: only those days are listed
            days = [f"{table_path}/data/event_date={wm.date() + _dt.timedelta(days=i)}" for i in range((prior.date() - wm.date()).days + 1)]
            held = [d for d in days if versioned.exists(spark, d)]
            if held:
                seen = spark.read.format(fmt).option("basePath", f"{table_path}/data").load(held)
                recent = (seen.filter((F.col("kafka_timestamp") >= F.lit(wm)) & (F.col("batch_id") < batch_id))
                          .select(*[F.col(c).alias(f"__s_{c}") for c in ids]))
                cond = [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in ids]
                rows = rows.join(recent, cond, "left_anti")
            late_cond = F.col("kafka_timestamp") < F.lit(wm)
        else:
            late_cond = F.lit(False)
        rows = rows.withColumn("__late", late_cond).persist()
        try:
            on_time = rows.filter(~F.col("__late")).drop("__late")
            late = rows.filter(F.col("__late")).drop("__late")
            (on_time.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id")
             .format(fmt).save(f"{table_path}/data"))
            (late.write.mode("overwrite").format(fmt).save(f"{late_path}/batch_id={batch_id}"))
            top = max([t for t in (on_time.agg(F.max("kafka_timestamp")).first()[0], prior) if t is not None], default=None)
            if top is not None:
                last = sorted(earlier)[-1:]
                versioned.write_pointer(spark, f"{table_path}/_progress", {**{str(b): t for b, t in last}, str(batch_id): top.isoformat()})
        finally:
            rows.unpersist()
    return write


def read_table(spark, table_path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{table_path}/data")


def read_late(spark, late_path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(late_path)
