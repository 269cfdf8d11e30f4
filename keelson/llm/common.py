"""Helpers shared by the corpus operators of this subpackage."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import ensure_checkpoint_dir, scratch_path, table_path

#: Broadcast a side only up to this many rows of a few dozen bytes each;
#: beyond it every operator here falls back to a shuffled join.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def whole_text(c: str | Column = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the cluster's shared checkpoint folder
    and read back: later steps do not recompute it, and lost executors
    lose none of it."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint when the counted ``rows`` are at most ``most``; else
    the plain side, which Spark joins by a shuffle."""
    return F.broadcast(df) if rows <= most else df


def partitions_for(spark: SparkSession, rows: int, per: int) -> int:
    """As many partitions as ``rows`` need at ``per`` rows each, and at least
    the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per), 1)


def row_key(id_col: str, text: str) -> list[Column]:
    """``id`` and ``th`` (hash of the whole text): what tells rows apart here.
    Rows that agree in both count as one row repeated."""
    return [F.col(f"`{id_col}`").alias("id"), F.xxhash64(whole_text(F.col(f"`{text}`"))).alias("th")]


def in_struct(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """The whole row as ``row``, so no column of it can clash, and its key."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key(id_col, text))


def join_keys(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``in_struct`` joined to stored distinct keys (id, th)."""
    r, k = rows.alias("r"), broadcast_if_small(keys, keys.count()).alias("k")
    return r.join(k, F.col("r.id").eqNullSafe(F.col("k.id")) & (F.col("r.th") == F.col("k.th")), how)


def without(docs: DataFrame, losers: DataFrame, id_col: str, text: str) -> DataFrame:
    """``docs`` without the rows whose key is in ``losers`` (id, th)."""
    gone = stored(docs.sparkSession, losers.select("id", "th").distinct(), "losers")
    return join_keys(in_struct(docs, id_col, text), gone, "left_anti").select("row.*")


def once(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``docs`` with one row for each key.  Only keys that do repeat (a count
    over ids and hashes tells them) send their rows through a shuffle."""
    many = stored(docs.sparkSession, docs.select(*row_key(id_col, text)).groupBy("id", "th").count().where("count > 1").select("id", "th"), "repeated")
    if not many.limit(1).count():
        return docs
    rows = in_struct(docs, id_col, text)
    again = join_keys(rows, many, "left_semi").dropDuplicates(["id", "th"])
    return join_keys(rows, many, "left_anti").select("row.*").unionByName(again.select("row.*"))


def crc_text(c: Column) -> Column:
    """crc32 of a value's text; null counts as empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def texts(batch: pa.RecordBatch, column: str | int = "text") -> list[bytes]:
    """A batch's strings as UTF-8 bytes, null as empty."""
    at = column if isinstance(column, int) else batch.schema.get_field_index(column)
    return [t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches: what a task makes of one is small,
    however many rows Spark hands over at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def pieces(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Cuts a list of sizes in consecutive ranges whose sum is at most
    ``most`` (a single larger element is a range of its own)."""
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > most:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def add_blocks(blocks: DataFrame, keys: list[str], value: str, dtype: str, n: int) -> DataFrame:
    """Sums equal-length binary arrays (``value``, of numpy ``dtype``) per
    ``keys``.  Rows are dealt by key and added as they stream by, so a task
    holds one array per key it owns, however many rows a key has."""
    schema = blocks.select(*keys, value).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for b in batches:
            cols = [b.column(b.schema.get_field_index(k)).to_pylist() for k in keys]
            for *key, raw in zip(*cols, b.column(b.schema.get_field_index(value)).to_pylist(), strict=True):
                got = np.frombuffer(raw, dtype)
                old = sums.get(tuple(key))
                sums[tuple(key)] = got.copy() if old is None else np.add(old, got, out=old)
        if sums:
            out = {k: [key[i] for key in sums] for i, k in enumerate(keys)}
            out[value] = [v.tobytes() for v in sums.values()]
            arrow = pa.schema([pa.field(k, pa.string() if schema[k].dataType.typeName() == "string" else pa.int64()) for k in keys] + [pa.field(value, pa.binary())])
            yield from pa.table(out, schema=arrow).to_batches()

    spread = blocks.select(*[F.col(k).cast("string") if schema[k].dataType.typeName() == "string" else F.col(k).cast("long").alias(k) for k in keys], value)
    return spread.repartition(n, *keys).mapInArrow(add, spread.schema)


__all__ = ["add_blocks", "ascii_lower", "broadcast_if_small", "crc_text", "ensure_checkpoint_dir", "once", "partitions_for",
           "pieces", "row_key", "scratch_path", "slices", "stored", "table", "table_path", "texts", "whole_text", "without"]
