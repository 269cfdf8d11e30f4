"""Referential checks on streams: children that come before their parent.

A child waits for its parent in the state of a stream-stream outer join.
When the watermark passes the waiting time it comes out without one and goes
to the quarantine; when the parent turns up after all, ``redrive`` moves the
child over.  State is bounded by the watermarks on both sides: a child is
held for the waiting time, a parent for ``remember``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def await_parents(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, child_time: str, parent_time: str,
                  wait: str = "1 hour", remember: str = "1 day", watermark: str = "10 minutes") -> DataFrame:
    """Children with ``_has_parent``: true as soon as a parent is there whose
    time is at most ``remember`` before and ``wait`` after the child's,
    false once the watermark says that none can come any more.

    ``parents`` must be unique by key within ``remember`` (their first
    change).  A NULL key has no parent.  A parent older than ``remember`` is
    no longer in the state; its children are found by ``redrive`` at once.
    """
    c = children.withWatermark(child_time, watermark)
    p = (parents.select(F.col(parent_key).alias("__pk"), F.col(parent_time).alias("__pt"))
         .withWatermark("__pt", watermark))
    near = (F.col("__pk") == F.col(child_key)) & (F.col("__pt") >= F.col(child_time) - F.expr(f"interval {remember}")) \
        & (F.col("__pt") <= F.col(child_time) + F.expr(f"interval {wait}"))
    return c.join(p, near, "left_outer").withColumn("_has_parent", F.col("__pk").isNotNull()).drop("__pk", "__pt")


def split_writer(base: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for ``await_parents``: one write, by
    ``_has_parent``, into a folder of the batch; a replayed batch
    overwrites its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").format(fmt).partitionBy("_has_parent")
         .save(f"{base.rstrip('/')}/load=batch-{batch_id}"))
    return write


def _loads(spark: SparkSession, base: str, schema, fmt: str) -> DataFrame:
    return spark.read.format(fmt).schema(schema.add("_has_parent", "boolean").add("load", "string")).load(base)


def accepted(spark: SparkSession, base: str, schema, fmt: str = "parquet") -> DataFrame:
    """Children with a parent, found on the stream or by a re-drive.
    ``schema`` (StructType) is that of the children."""
    names = schema.names
    return _loads(spark, base, _copy(schema), fmt).filter("_has_parent").select(*names)


def quarantined(spark: SparkSession, base: str, schema, key: str, fmt: str = "parquet") -> DataFrame:
    """Children without a parent so far: ``key`` identifies a child, and one
    that a re-drive moved is no longer among them."""
    rows = _loads(spark, base, _copy(schema), fmt)
    moved = rows.filter(F.col("load").startswith("redrive-")).select(F.col(key).alias("__k"))
    left = rows.filter(~F.col("_has_parent"))
    return left.join(moved, F.col(key).eqNullSafe(F.col("__k")), "left_anti").select(*schema.names)


def _copy(schema):
    from pyspark.sql import types as T
    return T.StructType(list(schema.fields))


def redrive(spark: SparkSession, base: str, schema, key: str, child_key: str, parents: DataFrame, parent_key: str,
            run: str, fmt: str = "parquet") -> None:
    """Move quarantined children whose parent is in ``parents`` by now to the
    accepted ones.  ``run`` names the re-drive; the same run again
    overwrites its own rows with the same."""
    known = parents.select(F.col(parent_key).alias("__pk")).distinct()
    rows = _loads(spark, base, _copy(schema), fmt)
    other = rows.filter(F.col("load").startswith("redrive-") & (F.col("load") != f"redrive-{run}")).select(F.col(key).alias("__k"))
    left = rows.filter(~F.col("_has_parent")).join(other, F.col(key).eqNullSafe(F.col("__k")), "left_anti").select(*schema.names)
    found = left.join(known, F.col(child_key) == F.col("__pk"), "left_semi").withColumn("_has_parent", F.lit(True))
    found.write.mode("overwrite").format(fmt).partitionBy("_has_parent").save(f"{base.rstrip('/')}/load=redrive-{run}")
