"""Per-key folds whose step depends on all earlier steps, split over slices.

Some scans are no sums: what a row does depends on the state that earlier
rows of its key left (a balance that refuses, an automaton that ignores
illegal events).  A stretch of rows is then a function of the state it
begins with; a ``Machine`` says how that function is written down.

Rows are range-partitioned by (key, order) and sorted.  Of a slice only its
first and last key can reach into another slice; for these two the
functions are made, in parallel.  The states that stretches begin with
follow from at most two functions for each slice, and a second pass over
the slices settles every row.  A key whose function would be too large is
settled by one task that streams through its rows in order, one state in
memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.session import scratch_path, shuffle_partitions


class Machine(Protocol):
    """States and values are whole numbers."""

    first: int                                    #: the state before any row

    def step(self, state: int, value: int) -> tuple[bool, int]:
        """Whether the row is accepted, and the state after it."""

    def nothing(self):  # noqa: ANN201
        """The function of no rows."""

    def then(self, function, value: int):  # noqa: ANN001, ANN201
        """The function followed by one more row; None when it gets too large."""

    def pack(self, function) -> list[int]:  # noqa: ANN001
        """The function as a list of numbers."""

    def after(self, packed: list[int], state: int) -> int:
        """The state after a packed function."""


def _runs(b: pa.RecordBatch, account: int, amount: int) -> Iterator[tuple[str, list[int]]]:
    """Consecutive rows of one account in a batch."""
    names, amounts = b.column(account).to_pylist(), b.column(amount).to_pylist()
    at = 0
    for i in range(1, len(names) + 1):
        if i == len(names) or names[i] != names[at]:
            yield names[at], amounts[at:i]
            at = i


def _summaries(machine: Machine):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(slice, key, value) sorted to the functions of each slice's first
        and last key; null when too large."""
        done: list[tuple] = []
        current, function, part, begun = None, None, None, False
        for b in batches:
            part = b.column(0)[0].as_py()
            for name, values in _runs(b, 1, 2):
                if not begun or name != current:
                    if begun and not done:
                        done.append((part, current, function))    # the first key; later ones wait until they prove to be the last
                    current, function, begun = name, machine.nothing(), True
                for x in values:
                    if function is None:
                        break
                    function = machine.then(function, x)
        if begun:
            done.append((part, current, function))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string()),
             pa.array([None if d[2] is None else machine.pack(d[2]) for d in done], pa.list_(pa.int64()))], names=["slice", "key", "packed"])
    return run


def _starts(machine: Machine):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Functions in order to the state that each begins with; null after
        one that is not known."""
        current, state, begun = None, None, False
        for b in batches:
            out: list[tuple] = []
            for part, name, packed in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if not begun or name != current:
                    current, state, begun = name, machine.first, True
                out.append((part, name, state))
                if state is not None:
                    state = None if packed is None else machine.after(packed, state)
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string()),
                                              pa.array([o[2] for o in out], pa.int64())], names=["slice", "key", "start"])
    return run


def _settle(machine: Machine):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row, key, value, start) sorted to (row, accepted, state)."""
        current, state, begun = None, None, False
        for b in batches:
            accepted, states, at = [], [], 0
            starts = b.column(3)
            for name, values in _runs(b, 1, 2):
                if not begun or name != current:
                    start = starts[at].as_py()
                    current, state, begun = name, machine.first if start is None else start, True
                for x in values:
                    ok, state = machine.step(state, x)
                    accepted.append(ok)
                    states.append(state)
                at += len(values)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(accepted, pa.bool_()), pa.array(states, pa.int64())], names=["row", "accepted", "state"])
    return run


def _by_slice(fn, at: int):  # noqa: ANN001, ANN202
    """Applies ``fn`` to each slice of a partition's sorted rows (the slice's
    number is column ``at``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        source = iter(batches)

        def one() -> Iterator[pa.RecordBatch]:
            part = waiting[0].column(at)[0].as_py()
            while True:
                b = waiting.pop(0) if waiting else next(source, None)
                if b is None:
                    return
                if not b.num_rows:
                    continue
                parts = b.column(at).to_numpy()
                end = int(np.searchsorted(parts, part, "right"))
                if end:
                    yield b.slice(0, end)
                if end < b.num_rows:
                    waiting.insert(0, b.slice(end))
                    return
        while True:
            if not waiting:
                b = next((x for x in source if x.num_rows), None)
                if b is None:
                    return
                waiting.append(b)
            yield from fn(one())
    return run


def fold_scan(df: DataFrame, key: str, order: Sequence[str], value: Column, machine: Machine, num_partitions: int | None = None) -> DataFrame:
    """``row`` (the whole row of ``df`` as a struct), ``accepted`` and
    ``state`` (after the row).  Rows go by ``order``, which must be total
    per key; a null key is a key."""
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    by = [F.col("key"), *[F.col(f"row.`{c}`") for c in order]]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(key).cast("string").alias("key"), value.cast("long").alias("value"))
    # both passes read the same slices, so they are fixed in the shared folder
    path, kind = scratch_path(spark, "slices"), rows.schema["row"].dataType.simpleString()
    (rows.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("slice", F.spark_partition_id().cast("long"))
     .write.partitionBy("slice").parquet(path))
    cut = spark.read.schema(f"row {kind}, key string, value long, slice long").parquet(path)

    def per_slice(frame: DataFrame) -> DataFrame:
        # a slice lies in one partition again, in its order
        return frame.repartition(n, "slice").sortWithinPartitions("slice", *by)

    functions = per_slice(cut).select("slice", "key", "value").mapInArrow(_by_slice(_summaries(machine), 0), "slice long, key string, packed array<long>")
    starts_path = scratch_path(spark, "starts")
    functions.coalesce(1).sortWithinPartitions("key", "slice").mapInArrow(_starts(machine), "slice long, key string, start long").write.parquet(starts_path)
    starts = spark.read.schema("slice long, key string, start long").parquet(starts_path)
    s = starts.select(F.col("slice").alias("s"), F.col("key").alias("k"), "start")
    alone = starts.where("start is null").select(F.col("key").alias("w"), F.lit(True).alias("alone")).distinct()
    # at most two rows for each slice
    marked = (cut.join(F.broadcast(alone), F.col("key").eqNullSafe(F.col("w")), "left")
              .join(F.broadcast(s), (F.col("slice") == F.col("s")) & F.col("key").eqNullSafe(F.col("k")), "left"))
    schema = f"row {kind}, accepted boolean, state long"
    easy = per_slice(marked.where("alone is null")).select("row", "key", "value", "start", "slice").mapInArrow(_by_slice(_settle(machine), 4), schema)
    hard = (marked.where("alone").repartition(n, "key").sortWithinPartitions(*by)
            .select("row", "key", "value", F.lit(None).cast("long").alias("start")).mapInArrow(_settle(machine), schema))
    return easy.unionByName(hard)
