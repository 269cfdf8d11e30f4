"""Exact duplicates by 128-bit content hash, with the bytes compared.

Texts are equal when identical after lower-casing A-Z.  Rows are grouped by
the MD5 of the normalised text *and* the text itself, so a group never rests
on the hash alone; the hash only carries the verdict back to the rows, and a
hash that two different texts share is joined by the text instead.

Spark adds up copies map-side, so a text held by a third of all rows costs
one row per map task.  The way back would still send all copies of a hot
text to one task; groups of at least one thousandth of the rows (at most a
thousand of them can exist) are therefore broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, once, row_key, stored, table, whole_text, without

#: A group is hot from this share of the rows on: 1/HOT, so at most HOT groups are.
HOT = 1000


def normalised(text: str = "text") -> Column:
    return ascii_lower(whole_text(text))


def groups_of_texts(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per distinct normalised text: ``h`` (MD5), ``norm``,
    ``keep_id``, ``group_size``."""
    keyed = docs.select(F.col(id_col).alias("id"), normalised(text).alias("norm"))
    return (keyed.groupBy(F.md5(F.col("norm").cast("binary")).alias("h"), "norm")
            .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))


def exact_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", columns: list[str] | None = None) -> DataFrame:
    """All rows and the ``columns`` (default: all) of ``docs`` with ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256`` (the four replace columns of the same name).

    The largest id of a group stays.  Null text counts as empty; a null id
    is smaller than any other, and a group of null ids only has a null
    ``keep_id`` and keeps its rows.  Rows that repeat both id and text
    count in ``group_size`` and share one verdict (``drop_copies`` keeps
    one of them).  An empty table gives no rows.
    """
    added = ["keep_id", "group_size", "kept", "text_sha256"]
    docs = docs.select([c for c in docs.columns if c not in added])
    spark = docs.sparkSession
    found = groups_of_texts(docs, text, id_col)
    # the texts end here: only hashes and verdicts are kept of the groups
    slim = stored(spark, found.select("h", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size"), "groups")
    per_hash = slim.groupBy("h").agg(F.count(F.lit(1)).alias("n_texts"), *[F.max(c).alias(c) for c in ("text_sha256", "keep_id", "group_size")])
    one = per_hash.where("n_texts = 1").drop("n_texts")
    least = max(2, docs.count() // HOT)
    hot, cold = one.where(F.col("group_size") >= least), one.where(F.col("group_size") < least)
    many = stored(spark, per_hash.where("n_texts > 1").select("h"), "collisions")

    names = [c for c in columns or docs.columns if c not in added]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                       F.md5(normalised(text).cast("binary")).alias("h"), F.col(f"`{text}`").alias("text"), F.col(f"`{id_col}`").alias("id"))
    out = ["row", "id", "text_sha256", "keep_id", "group_size"]
    all_rows = rows.join(F.broadcast(hot), "h").select(*out).unionByName(
        rows.join(F.broadcast(hot.select("h")), "h", "left_anti").join(cold, "h").select(*out))
    if many.limit(1).count():
        exact = found.join(many, "h", "left_semi").select("h", "norm", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size")
        all_rows = all_rows.unionByName(rows.withColumn("norm", normalised()).join(exact, ["h", "norm"]).select(*out))
    return all_rows.select(
        "row.*", "keep_id", "group_size",
        F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the largest
    id (of rows that repeat it, one)."""
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"), row_key(id_col, text)[1])
    found = stored(spark, exact_dedup(slim, "text", "id", ["id", "th"]).where("group_size > 1"), "copies")
    # rows that repeat the largest id in another case differ in th; the largest stays
    top = found.where("kept").groupBy("text_sha256").agg(F.max("th").alias("top"))
    late = found.where("kept").join(top, "text_sha256").where("th <> top")
    losers = found.where("not kept").select("id", "th").unionByName(late.select("id", "th"))
    return once(without(docs, losers, id_col, text), id_col, text)


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs, columns=["doc_id"]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, coalesce(d.doc_id = g.keep_id, g.keep_id IS NULL) AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
