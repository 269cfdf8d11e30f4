"""Shards of near-equal bytes, tokens and rows by vector bin packing.

The items are groups of equal texts with a vector (bytes, tokens, rows).
Each goes to the shard where the dot product of its vector with the shard's
residual capacity is highest, largest items first.

Packing is greedy, hence sequential; it is made parallel without giving up
balance.  Groups of at least 1/``BIG`` of a shard's capacity in any
dimension (their number is bounded by that, not by the data) are packed
first, in one task.  All others are dealt by hash into blocks; each block
packs its groups against its own share of what capacity the large groups
left, so every block alone is near equal, and its error is a fraction of
one small group.  A group larger than a whole shard could never be balanced:
such groups (fewer than three per shard) are split by the hash of the id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, partitions_for, stored, table, whole_text

SHARDS = 16
#: A group is packed globally from 1/BIG of a shard's capacity on.
BIG = 1000
#: Groups a block, and rows a slice of a shard, hold about this many.
BLOCK = 50_000
DIMS = ["bytes", "tokens", "n_rows"]
#: Weights of the dimensions in the dot product: bytes come first, the law
#: that the query states; tokens and rows follow as far as they agree.
WEIGHTS = np.array([100.0, 1.0, 1.0])


def n_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def pack(items: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each item (rows of ``items``, taken largest first) and
    the residual capacities (shards x dimensions) after all."""
    scale = np.maximum(capacity.mean(axis=0), 1e-9) / np.sqrt(WEIGHTS)
    left, vectors = capacity / scale, items / scale
    shard = np.zeros(len(items), np.int32)
    order = np.argsort(-vectors.max(axis=1, initial=0), kind="stable")
    for i in order:
        v = vectors[i]
        s = int(np.argmax(left @ v))
        shard[i] = s
        left[s] -= v
    return shard, left * scale


def shard_documents(docs: DataFrame, shards: int = SHARDS, text: str = "text", id_col: str = "doc_id",
                    columns: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` with ``size`` (UTF-8 bytes plus one), ``shard``
    and ``slot`` (from 0, gapless within the shard); they replace columns
    of the same name.  ``columns`` names those of ``docs`` to return
    (default: all); leaving out the text spares its way through the shuffle.

    Rows of equal text share a shard unless their group alone exceeds a
    shard's fair share of bytes, tokens or rows.  Null text counts as empty
    (size 1); null ids and repeated rows are rows like any other, each with
    its own slot.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    names = [c for c in columns or docs.columns if c not in ("size", "shard", "slot")]
    body = whole_text(F.col(f"`{text}`"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.sha2(body.cast("binary"), 256).alias("key"), n_tokens(body).cast("long").alias("tokens"),
        F.xxhash64(F.col(f"`{id_col}`")).alias("id_hash"))
    rows = stored(spark, rows, "sized")
    total = rows.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    n = total[2]
    whole = np.array([[total[0] or 0, total[1] or 0, n]], float)
    fair = np.maximum(whole[0] / shards, 1e-9)

    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows"))
    share = F.greatest(*[F.col(d) / float(f) for d, f in zip(DIMS, fair, strict=True)])
    groups = stored(spark, groups.withColumn("share", share), "groups")
    # at most 3 x shards groups exceed a shard, and 3 x BIG x shards are large
    giant = groups.where("share > 1").select("key", (F.ceil(F.col("share")) * 4).cast("int").alias("parts"))
    rows = rows.join(F.broadcast(giant), "key", "left").withColumn(
        "part", F.when(F.col("parts").isNotNull(), F.pmod("id_hash", "parts")).otherwise(F.lit(0)).cast("int"))
    split = (rows.where("parts is not null").groupBy("key", "part")
             .agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows")))
    large = groups.where(f"share > 1/{BIG}D and share <= 1").select("key", F.lit(0).alias("part"), *DIMS).unionByName(split.select("key", "part", *DIMS))
    capacity = np.repeat(whole / shards, shards, axis=0)

    def pack_large(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([pd.DataFrame(columns=["key", "part", *DIMS]), *found])
        got = got.sort_values([*DIMS, "key", "part"], ascending=False).reset_index(drop=True)
        got["shard"], _ = pack(got[DIMS].to_numpy(float), capacity.copy())
        yield got

    placed = stored(spark, large.coalesce(1).mapInPandas(pack_large, "key string, part int, bytes long, tokens long, n_rows long, shard int"), "large-groups")
    left = capacity.copy()
    for r in placed.groupBy("shard").agg(*[F.sum(d).alias(d) for d in DIMS]).collect():
        left[r["shard"]] -= [float(r[d]) for d in DIMS]
    left = np.maximum(left, 0)
    portion = left / np.maximum(left.sum(axis=0), 1e-9)

    def pack_block(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values([*DIMS, "key"], ascending=False).reset_index(drop=True)
        items = block[DIMS].to_numpy(float)
        block["shard"], _ = pack(items, portion * items.sum(axis=0))
        return block[["key", "shard"]].assign(part=0)

    small = groups.where(f"share <= 1/{BIG}D")
    blocks = partitions_for(spark, groups.count(), BLOCK) if n > BLOCK else 1
    dealt = (small.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).groupBy("block")
             .applyInPandas(pack_block, "key string, shard int, part int"))
    most = F.broadcast(placed.select("key", "part", "shard"))
    found = rows.join(most, ["key", "part"]).unionByName(
        rows.join(F.broadcast(placed.select("key").distinct()), "key", "left_anti").join(dealt, ["key", "part"]))
    slices = max(1, -(-n // (shards * BLOCK)))
    whole_rows = stored(spark, found.select("row", "size", "shard", F.pmod("id_hash", F.lit(slices)).alias("slice"), "id_hash", "key"), "sharded")
    counts = whole_rows.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "slice", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "slice").orderBy("id_hash", "key")
    return (whole_rows.withColumn("nth", F.row_number().over(within) - 1)
            .join(broadcast_if_small(offsets, shards * slices), ["shard", "slice"])
            .select("row.*", "size", "shard", (F.col("first") + F.col("nth")).cast("long").alias("slot")))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(whole_text().cast("binary")).alias("text_crc32"))
    return (shard_documents(docs, columns=["doc_id", "text_crc32"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))
