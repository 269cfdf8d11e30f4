"""Repeated byte strings by column-wise construction of the suffix order of
many documents.

All strings of LENGTH bytes that start in a smaller document are to be
found.  Inserting one symbol per *whole* document each round would take as
many rounds as the longest document has bytes, so the collection is cut
first: every window of LENGTH bytes is owned by its anchor, the least hashed
K-gram in it, and the windows that one anchor owns in a row form a segment.
Equal windows have equal anchors at equal offsets, so segments are dealt to
buckets by anchor, lined up at it, and a window only has to be compared
within its column.

In a bucket all segments are the collection.  Rounds run from the last
column to the first.  Each inserts one symbol per segment in front of its
suffix: the symbols, read in the order of the suffixes (the column's part of
the Burrows-Wheeler transform), are sorted stably, which gives the next
order, and common prefixes follow as one more than the least between the two
former places.  Runs with a common prefix of LENGTH or more hold equal
windows; the smallest document of a run keeps it.

What moves is sequential files of compressed segments and answers: a block
of documents sends each distinct segment once, with its smallest document,
and gets back the columns that a smaller document elsewhere holds.  So a
string that a third of all documents share is one row per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions_for, row_key, slices, table, texts, whole_text

#: Contract: strings of this many bytes.
LENGTH = 50
#: Bytes of an anchor, and windows that share a choice of anchor.
K = 8
SPAN = LENGTH - K + 1
#: Bytes of text in a block, of segments in a bucket, and cut at a time.
BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 32 << 20
PART = 1 << 21
#: Bytes of segments for each byte of text, roughly: sizes the buckets.
OVERLAP = 3.3
LAST_ID = (1 << 63) - 1
#: Suffixes that can match no more are dropped every so many columns, from this column on.
PRUNE_EVERY = 4
PRUNE_BELOW = 32


def pressed(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unpressed(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (block, id, text) to compressed rows of (block, ids, sizes, texts)."""
    held: dict[int, list] = {}
    total: dict[int, int] = {}

    def row(block: int) -> pa.RecordBatch:
        found = held.pop(block)
        total.pop(block)
        return pa.RecordBatch.from_arrays([
            pa.array([block], pa.int64()), pa.array([[i for i, _ in found]], pa.list_(pa.int64())), pa.array([[len(t) for _, t in found]], pa.list_(pa.int64())),
            pa.array([pressed(b"".join(t for _, t in found))], pa.binary())], names=["block", "ids", "sizes", "texts"])

    for b in slices(batches):
        for block, i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b, 2), strict=True):
            held.setdefault(block, []).append((i, raw))
            total[block] = total.get(block, 0) + len(raw)
            if total[block] > PART:
                yield row(block)
    for block in list(held):
        yield row(block)


def documents_of(found: pa.Table) -> list[tuple[int | None, bytes]]:
    """A block's documents, in an order that does not depend on the shuffle."""
    out = []
    for ids, sizes, raw in zip(*(found.column(c).to_pylist() for c in ("ids", "sizes", "texts")), strict=True):
        text, at = unpressed(raw), 0
        for i, n in zip(ids, sizes, strict=True):
            out.append((i, text[at:at + n]))
            at += n
    out.sort(key=lambda d: (d[0] is None, d[0] or 0, d[1]))
    return out


def parts(docs: list[tuple[int | None, bytes]]) -> Iterator[tuple[list[tuple[int, int]], list[bytes]]]:
    """Portions of about PART bytes: lists of (document, offset) and their
    bytes.  A portion of a longer document overlaps the next by a window."""
    where, texts, total = [], [], 0
    for d, (_, text) in enumerate(docs):
        for at in range(0, max(1, len(text) - LENGTH + 1), PART):
            piece = text[at:at + PART + LENGTH - 1]
            if where and total + len(piece) > PART + LENGTH:
                yield where, texts
                where, texts, total = [], [], 0
            where.append((d, at))
            texts.append(piece)
            total += len(piece)
    if where:
        yield where, texts


def segments(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts joined, and of each segment: first window, number of windows,
    place of the anchor, the anchor's hash, and the text it is in."""
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return joined, none, none, none, none, none
    h = np.zeros(len(data) - K + 1, np.uint32)
    for j in range(K):
        h = (h ^ data[j:j + len(h)]) * np.uint32(0x01000193)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    least = (h.astype(np.uint64) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    reach = 1
    while 2 * reach <= SPAN:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < SPAN:
        least = np.minimum(least[:len(least) - (SPAN - reach)], least[SPAN - reach:])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    # windows that reach into the next text belong to none
    text = np.searchsorted(ends, np.arange(len(anchor)), side="right")
    inside = np.arange(len(anchor)) + LENGTH <= ends[text]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    first = np.nonzero(new & inside)[0]
    stop = np.nonzero(np.append(new[1:] | ~inside[1:], True) & inside)[0] + 1
    at = anchor[first]
    return joined, first, stop - first, at, h[at].astype(np.int64), text[first]


def distinct_segments(docs: list[tuple[int | None, bytes]]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray, np.ndarray, list]:
    """A block's distinct segments (bytes to number) with anchor offset, anchor
    hash and smallest id, and for each part what is needed to mark its text."""
    known: dict[bytes, int] = {}
    left, hashes, least, cut = [], [], [], []
    for where, texts in parts(docs):
        joined, first, n, at, h, text = segments(texts)
        stop = first + n + LENGTH - 1
        before = len(known)
        number = np.fromiter((known.setdefault(joined[a:b], len(known)) for a, b in zip(first.tolist(), stop.tolist(), strict=True)), np.int64, len(first))
        ids = np.array([LAST_ID if docs[d][0] is None else docs[d][0] for d, _ in where], np.int64)[text] if len(text) else np.zeros(0, np.int64)
        fresh, index = np.unique(number, return_index=True)
        index = index[fresh >= before]
        left.append((at - first)[index])
        hashes.append(h[index])
        least.append((number, ids))
        cut.append((where, texts, first, n, number, ids))
    smallest = np.full(len(known), LAST_ID, np.int64)
    for number, ids in least:
        np.minimum.at(smallest, number, ids)
    gather = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return known, gather(left), gather(hashes), smallest, cut


def send_block(buckets: int):  # noqa: ANN201
    """A block's rows to rows of (bucket, block, segments)."""
    def run(found: pa.Table) -> pa.Table:
        block = found.column("block")[0].as_py()
        known, left, hashes, least, _ = distinct_segments(documents_of(found))
        raw, sizes = list(known), np.fromiter(map(len, known), np.int64, len(known))
        bucket = (hashes * 0x9E3779B1 & 0xFFFFFFFF) % buckets
        order = np.lexsort((hashes, bucket))
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = []
        for k in range(buckets):
            some = order[bounds[k]:bounds[k + 1]]
            if len(some):
                rows.append((k, block, pressed(b"".join([raw[i] for i in some])), sizes[some].astype(np.uint8).tobytes(), left[some].astype(np.uint8).tobytes(),
                             least[some].tobytes(), some.astype(np.int32).tobytes()))
        names = ["bucket", "block", "bytes", "sizes", "left", "least", "numbers"]
        kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 5
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)
    return run


class Minima:
    """Least of any range of an array, from minima over powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            last, step = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), self.levels[0].dtype)
        level = np.log2(np.maximum(stop - start, 1)).astype(np.int8)
        for k, values in enumerate(self.levels):
            i = np.nonzero(level == k)[0]
            if len(i):
                out[i] = np.minimum(values[start[i]], values[stop[i] - 2 ** k])
        return out


def smaller_elsewhere(text: np.ndarray, start: np.ndarray, size: np.ndarray, left: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a collection of segments (their place in ``text``, bytes, anchor
    offset and smallest id): runs (segment, first window, end) of windows
    that also occur in a segment of smaller id."""
    n = len(start)
    stop, begin, origin = size - left, -left, start + left
    births = np.argsort(-stop, kind="stable")
    born = 0
    order, lcp = np.zeros(0, np.int64), np.zeros(0, np.uint8)
    open_from = np.full(n, -1, np.int64)  # end (exclusive) of the run that is being read, from right to left
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for column in range(int(stop.max(initial=0)) - 1, int(begin.min(initial=0)) - 1, -1):
        upto = int(np.searchsorted(-stop[births], -column, side="left"))
        if upto > born:  # segments that end here join with an empty suffix
            fresh = births[born:upto]
            if len(lcp):
                lcp[0] = 0
            order, lcp, born = np.concatenate([fresh, order]), np.concatenate([np.zeros(len(fresh), np.uint8), lcp]), upto
        leave = begin[order] > column  # no symbol here
        if column < PRUNE_BELOW and column % PRUNE_EVERY == 0:
            # a common prefix grows by one a round: these cannot reach LENGTH in a window of their own any more
            leave |= np.maximum(lcp, np.append(lcp[1:], 0)) < LENGTH - (column + 1) - left[order]
        if leave.any():
            done = order[leave]
            close = done[open_from[done] >= 0]
            out.append((close, column + 1 + left[close], open_from[close]))
            open_from[close] = -1
            stay = np.nonzero(~leave)[0]
            if not len(stay):
                order, lcp = order[:0], lcp[:0]
                continue
            lcp = np.minimum.reduceat(lcp[:stay[-1] + 1], np.concatenate([[0], stay[:-1] + 1]))
            order = order[stay]
        if not len(order):
            continue
        # insert one symbol per segment: the column of the transform, sorted stably
        symbols = text[origin[order] + column]
        place = np.argsort(symbols, kind="stable")
        ordered = symbols[place]
        same = np.nonzero(ordered[1:] == ordered[:-1])[0] + 1
        fresh_lcp = np.zeros(len(order), np.uint8)
        fresh_lcp[same] = np.minimum(Minima(lcp).of(place[same - 1] + 1, place[same] + 1), 254 - LENGTH) + 1
        order, lcp = order[place], fresh_lcp
        if column > 0:
            continue
        # windows that start in this column
        runs = np.nonzero(lcp < LENGTH)[0]
        ids = least[order]
        smallest = np.repeat(np.minimum.reduceat(ids, runs), np.diff(np.append(runs, len(order))))
        hit = np.zeros(n, bool)
        hit[order[smallest < ids]] = True
        at = column + left  # as the number of the window
        begins = np.nonzero(hit & (open_from < 0))[0]
        open_from[begins] = at[begins] + 1
        ends = np.nonzero(~hit & (open_from >= 0))[0]
        out.append((ends, at[ends] + 1, open_from[ends]))
        open_from[ends] = -1
    close = np.nonzero(open_from >= 0)[0]
    out.append((close, np.zeros(len(close), np.int64), open_from[close]))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def answer_bucket(found: pa.Table) -> pa.Table:
    """A bucket's rows to (block, answers): windows held by a smaller document elsewhere."""
    cols = {c: found.column(c).to_pylist() for c in found.column_names}
    text = b"".join(map(unpressed, cols["bytes"]))
    size = np.concatenate([np.frombuffer(x, np.uint8) for x in cols["sizes"]]).astype(np.int64)
    left = np.concatenate([np.frombuffer(x, np.uint8) for x in cols["left"]]).astype(np.int64)
    least = np.concatenate([np.frombuffer(x, np.int64) for x in cols["least"]])
    numbers = np.concatenate([np.frombuffer(x, np.int32) for x in cols["numbers"]])
    row = np.repeat(np.arange(len(cols["block"])), [len(x) for x in cols["sizes"]])
    segment, a, b = smaller_elsewhere(np.frombuffer(text, np.uint8), np.cumsum(size) - size, size, left, least)
    by = np.argsort(row[segment], kind="stable")
    segment, a, b = segment[by], a[by], b[by]
    bounds = np.searchsorted(row[segment], np.arange(len(cols["block"]) + 1))
    rows = [(cols["block"][k], numbers[segment[x:y]].tobytes(), a[x:y].astype(np.uint8).tobytes(), b[x:y].astype(np.uint8).tobytes())
            for k, (x, y) in enumerate(zip(bounds, bounds[1:], strict=False)) if y > x]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["block", "numbers", "first", "stop"])


def mark(docs: list[tuple[int | None, bytes]], answers: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """For each document, which bytes go."""
    known, _, _, least, cut = distinct_segments(docs)
    gather = lambda i: np.concatenate([x[i] for x in answers]) if answers else np.zeros(0, np.int64)
    number, a, b = gather(0).astype(np.int64), gather(1).astype(np.int64), gather(2).astype(np.int64)
    order = np.argsort(number, kind="stable")
    number, a, b = number[order], a[order], b[order]
    gone = [np.zeros(len(t), bool) for _, t in docs]
    for where, texts, first, n, own, ids in cut:
        total = sum(map(len, texts))
        edge = np.zeros(total + 1, np.int32)
        local = least[own] < ids  # a smaller document of this block holds the whole segment
        np.add.at(edge, first[local], 1)
        np.add.at(edge, first[local] + n[local] + LENGTH - 1, -1)
        lo, hi = np.searchsorted(number, own), np.searchsorted(number, own, side="right")
        many = hi - lo
        pick = np.repeat(lo - np.cumsum(many) + many, many) + np.arange(many.sum())
        base = np.repeat(first, many)
        np.add.at(edge, base + a[pick], 1)
        np.add.at(edge, base + b[pick] + LENGTH - 1, -1)
        covered = np.cumsum(edge)[:-1] > 0
        at = 0
        for (d, offset), t in zip(where, texts, strict=True):
            gone[d][offset:offset + len(t)] |= covered[at:at + len(t)]
            at += len(t)
    return gone


def finish_block(with_bytes: bool):  # noqa: ANN201
    def run(found: pa.Table, answers: pa.Table) -> pa.Table:
        docs = documents_of(found)
        got = [(np.frombuffer(x, np.int32), np.frombuffer(y, np.uint8), np.frombuffer(z, np.uint8))
               for x, y, z in zip(*(answers.column(c).to_pylist() for c in ("numbers", "first", "stop")), strict=True)]
        out: dict[str, list] = {k: [] for k in ("id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for (i, text), gone in zip(docs, mark(docs, got), strict=True):
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            for k, v in zip(out, (i, len(text), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()), hashlib.sha256(kept).hexdigest(),
                                  kept if with_bytes else None), strict=True):
                out[k].append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))
    return run


def remove_repeats(docs: DataFrame, text: str = "text", id_col: str = "doc_id", with_bytes: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``id`` (long), ``n_bytes``, ``n_removed``,
    ``n_spans``, ``kept_sha256`` and, unless ``with_bytes`` is false,
    ``kept``: the bytes that remain (a cut may fall inside a character).

    A byte goes if a string of LENGTH bytes covers it that also starts in a
    row with a smaller id; rows of equal id are not smaller than each other,
    a null id is larger than all others.  Null text counts as empty; texts
    shorter than LENGTH stay whole; repeated rows get equal results.  Only
    the id and the text are used.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    key = row_key(id_col, text)
    rows = docs.select(key[0].cast("long").alias("id"), whole_text(F.col(f"`{text}`")).alias("text"), key[1])
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, round(size / BLOCK_BYTES))
    buckets = max(12, round(size * OVERLAP / BUCKET_BYTES))
    packed = rows.select(F.pmod(F.xxhash64("id", "th"), F.lit(blocks)).alias("block"), "id", "text").mapInArrow(
        pack_task, "block long, ids array<long>, sizes array<long>, texts binary")
    dealt = packed.repartition(partitions_for(spark, blocks, 1), "block")
    sent = dealt.groupBy("block").applyInArrow(send_block(buckets), "bucket long, block long, bytes binary, sizes binary, left binary, least binary, numbers binary")
    answers = (sent.repartition(partitions_for(spark, buckets, 1), "bucket").groupBy("bucket")
               .applyInArrow(answer_bucket, "block long, numbers binary, first binary, stop binary"))
    found = dealt.groupBy("block").cogroup(answers.repartition(partitions_for(spark, blocks, 1), "block").groupBy("block")).applyInArrow(
        finish_block(with_bytes), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return found if with_bytes else found.drop("kept")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, with_bytes=False).withColumnRenamed("id", "doc_id")
