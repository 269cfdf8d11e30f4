"""SimHash near-duplicates by multi-index hashing, with exact components.

Fingerprints are split in segments.  Two that differ in at most d bits
differ in at most d // segments bits in one of them, so each fingerprint
enumerates the small Hamming ball around each of its segments, fetches the
fingerprints whose segment is in the ball, and verifies the full distance.
Only distinct fingerprints take part: copies never multiply pairs.

Components come from contraction: every node points to its least neighbour
(in a pseudo-random order, so chains shrink fast), edges are redrawn between
those, and so on until no edge is left.  Each round is a few joins over
stored tables; nothing of it passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import once, row_key, slices, stored, table, texts, without

SHINGLE = 3
BITS = 64
#: Contract: fingerprints link at this many differing bits or fewer.
DISTANCE = 3
SEGMENTS = 2
SEED = 42
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 17


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, 0 without words.

    Words end at ASCII white space; A-Z are lower-cased; shorter texts are
    one shingle.  A bit is set if more than half of the hashes have it.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    hash64 = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    for at in range(0, n, CHUNK):
        got = np.array([hash64(joined[a:b], SEED) for a, b in zip(first[at:at + CHUNK], last[at:at + CHUNK], strict=True)], "<u8")
        ones += np.unpackbits(got.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, columns: list[str] | None = None) -> DataFrame:
    """The ``columns`` of ``docs`` (default: all) and ``fp``, the fingerprint as a signed long."""
    names = [c for c in columns or docs.columns if c != "fp"]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in texts(b, "__text")], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps, pa.int64())], names=[*b.schema.names[:-1], "fp"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], StructField("fp", LongType())]))


def segments_of(fp: str, segments: int) -> list:
    """Columns with the value of each segment; widths differ by one bit at most."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [(F.shiftrightunsigned(F.col(fp), a).bitwiseAND(F.lit((1 << (b - a)) - 1 if b - a < 63 else -1)), b - a)
            for a, b in zip(edges, edges[1:], strict=False)]


def balls(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` set bits among ``width``, as signed longs."""
    masks = (sum(1 << b for b in at) for r in range(radius + 1) for at in combinations(range(width), r))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """All pairs ``a < b`` of the distinct longs in ``fps.fp`` that differ
    in at most ``distance`` bits, each once."""
    radius = distance // segments
    seg = segments_of("fp", segments)
    held = fps.select(F.col("fp").alias("b"), F.posexplode(F.array(*[s for s, _ in seg])).alias("s", "key"))
    def ball(i: int):  # noqa: ANN202
        value, width = seg[i]
        masks = F.array(*[F.lit(m).cast("long") for m in balls(width, radius)])
        return F.transform(masks, lambda m: F.struct(F.lit(i).alias("s"), value.bitwiseXOR(m).alias("key")))

    probes = F.flatten(F.array(*[ball(i) for i in range(segments)]))
    tried = fps.select(F.col("fp").alias("a"), F.explode(probes).alias("p")).select("a", "p.s", "p.key")
    found = tried.join(held, ["s", "key"]).where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    # found in the first segment whose ball holds it, so once
    earlier = [(F.bit_count(x.bitwiseXOR(y)) <= radius) for (x, _), (y, _) in zip(segments_of("a", segments), segments_of("b", segments), strict=True)]
    once = reduce(lambda c, i: c & ((F.col("s") <= i) | ~earlier[i]), range(segments - 1), F.lit(True))
    return found.where(once).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for all nodes of the undirected ``edges`` (a, b):
    equal roots mean connected."""
    spark = edges.sparkSession
    rank = F.xxhash64  # the pseudo-random order; ties broken by the node itself
    pairs = stored(spark, edges.select(F.struct(rank("a").alias("r"), F.col("a").alias("v")).alias("a"), F.struct(rank("b").alias("r"), F.col("b").alias("v")).alias("b")), "edges")
    nodes = None
    while pairs.limit(1).count():
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(spark, both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("up")), "up")
        nodes = stored(spark, up.select(F.col("a").alias("node"), F.col("up").alias("root")) if nodes is None else
                       nodes.join(up.withColumnRenamed("a", "root"), "root", "left").select("node", F.coalesce("up", "root").alias("root")), "roots")
        moved = pairs.join(up, "a").select(F.col("up").alias("x"), F.col("b").alias("a")).join(up, "a").select("x", F.col("up").alias("y"))
        pairs = stored(spark, moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if nodes is None:
        return pairs.select(F.col("a.v").alias("node"), F.col("b.v").alias("root"))
    return nodes.select(F.col("node.v").alias("node"), F.col("root.v").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE,
                    segments: int = SEGMENTS, columns: list[str] | None = None, with_root: bool = False) -> DataFrame:
    """The ``columns`` of ``docs`` (default: all) with ``fingerprint`` (16
    hex digits) and ``component_id``, the least id reachable by links; they
    replace columns of the same name.

    Null text counts as empty and has fingerprint 0, linked like any other;
    a null id is larger than all others, and a component of null ids has a
    null ``component_id``.  Repeated rows share a component.  An empty table
    gives no rows.  ``with_root`` adds ``root``, which tells components apart
    even where ids repeat or are null.
    """
    spark = docs.sparkSession
    names = [c for c in columns or docs.columns if c not in ("fingerprint", "component_id")]
    docs = docs.select([c for c in docs.columns if c not in ("fingerprint", "component_id", "fp")])
    rows = stored(spark, with_fingerprints(docs, text, shingle, [c for c in names if c != "fp"]), "fingerprints")
    least = stored(spark, rows.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct-fingerprints")
    linked = components(links(least.select("fp"), distance, segments))
    roots = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    per_root = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = roots.join(per_root, "root").select("fp", F.col("root").alias("__root"), "component_id")
    # a fingerprint with a thousandth of the rows or more is hot; at most a thousand are
    hot = F.broadcast(rows.groupBy("fp").count().where(F.col("count") >= max(2, rows.count() // 1000)).select("fp"))
    back = rows.join(F.broadcast(of_fp.join(hot, "fp")), "fp").unionByName(rows.join(hot, "fp", "left_anti").join(of_fp, "fp"))
    return back.select(*[c for c in names if c != "fp"], F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
                       *([F.col("__root").alias("root")] if with_root else []))


def one_per_component(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component, that of its least id (a null
    id only if there is no other; of rows with that id, the least by the
    hash of the text)."""
    slim = docs.select(*row_key(id_col, text), F.col(f"`{text}`").alias("text"))
    found = stored(docs.sparkSession, near_duplicates(slim, "text", "id", columns=["id", "th"], with_root=True), "components")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    first = found.groupBy("root").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    late = found.join(first, "root").where(~rank.eqNullSafe(F.col("first")))
    return once(without(docs, late.select("id", "th"), id_col, text), id_col, text)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, columns=["doc_id"]).select("doc_id", "fingerprint", "component_id")
