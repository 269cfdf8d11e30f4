"""Fill-in-the-middle texts by memoised content-defined chunks.

Where a document is cut depends on its number of code points, which takes a
pass over its bytes, and so does the search for markers that it may hold
already.  Both are sums over chunks.  A rolling hash over the last bytes
chunks a text by its content, so passages that documents share become equal
chunks wherever they stand; a cache keyed by the chunk's bytes (an entry is
used only when the bytes are equal, never on a hash alone) keeps what a chunk
adds: its code points, whether a marker lies inside, and the bytes at its two
ends, which tell of markers across a boundary.  Summaries are combined from
left to right; running sums of the chunks' code points locate the chunk of a
cut, and only that chunk is searched.

Rows are handled where Spark reads them: no shuffle, one text at a time, and
a cache of bounded size in each Python worker, which changes no result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, table, whole_text

#: Bytes that decide a boundary, and the mean distance of boundaries as a power of two.
WINDOW, MEAN_BITS = 16, 9
#: A chunk has at most so many bytes: a text without boundaries is cut at multiples of it.
LONGEST = 1 << 13
#: Bytes of chunks that a worker remembers; when full, the cache starts anew.
CACHE_BYTES = 64 << 20

#: The marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
MARK_BYTES = tuple(m.encode() for m in MARKS)
#: The bytes of UTF-8 that start no code point.
_CONTINUED = bytes(range(0x80, 0xC0))

_MULTIPLIER = 0x9E3779B97F4A7C15
#: One odd 64-bit number for each byte value.
_BYTES = np.array([((b + 1) * _MULTIPLIER ^ (b + 1) * 0xBF58476D1CE4E5B9 >> 7) & (1 << 64) - 1 | 1 for b in range(256)], np.uint64)


def boundaries(text: bytes) -> list[int]:
    """Ends of the chunks of a text: after each window of ``WINDOW`` bytes
    whose hash has ``MEAN_BITS`` leading zeros, at ``LONGEST`` bytes from
    the last end at the latest, and at the end of the text."""
    if not text:
        return []
    h = _BYTES[np.frombuffer(text, np.uint8)]
    width, factor = 1, _MULTIPLIER
    while width < WINDOW and len(h) > width:
        # the hash of the last 2 x width bytes from those of the last width
        wide = h.copy()
        wide[width:] += h[:-width] * np.uint64(factor)
        h, width, factor = wide, 2 * width, factor * factor & (1 << 64) - 1
    ends = (np.flatnonzero(h[WINDOW - 1:] >> np.uint64(64 - MEAN_BITS) == 0) + WINDOW).tolist()
    if not ends or ends[-1] != len(text):
        ends.append(len(text))
    out, at = [], 0
    for e in ends:
        out.extend(range(at + LONGEST, e, LONGEST))
        out.append(e)
        at = e
    return out


class Chunks:
    """What chunks add to a text, remembered by their bytes."""

    def __init__(self, most: int = CACHE_BYTES) -> None:
        self.most, self.held, self.known = most, 0, {}
        self.asked = self.found = 0

    def summary(self, chunk: bytes) -> tuple[int, bool, bytes, bytes]:
        """Code points that start in the chunk, whether it holds a mark, its
        first and its last two bytes."""
        self.asked += 1
        got = self.known.get(chunk)
        if got is not None:
            self.found += 1
            return got
        marked = b"<" in chunk and any(m in chunk for m in MARK_BYTES)
        got = len(chunk.translate(None, _CONTINUED)), marked, chunk[:2], chunk[-2:]
        if self.held + len(chunk) > self.most:
            self.known, self.held = {}, 0
        self.known[chunk] = got
        self.held += len(chunk)
        return got


class Measured:
    """A text's code points and marks, put together from its chunks."""

    def __init__(self, text: bytes, chunks: Chunks) -> None:
        self.text, self.ends = text, boundaries(text)
        starts = [0, *self.ends[:-1]]
        parts = [chunks.summary(text[a:b]) for a, b in zip(starts, self.ends, strict=False)]
        self.upto = list(accumulate(p[0] for p in parts))
        self.marked = any(p[1] for p in parts)
        tail = b""
        for _, _, first, last in parts:
            self.marked = self.marked or any(m in tail + first for m in MARK_BYTES)
            tail = (tail + last)[-2:] if len(last) < 2 else last
        self.n = self.upto[-1] if parts else 0

    def byte_of(self, points: int) -> int:
        """The byte where the text's first ``points`` code points end."""
        if points >= self.n:
            return len(self.text)
        # the chunk in which code point number ``points`` (from 0) starts
        k = bisect_left(self.upto, points + 1)
        at = self.ends[k - 1] if k else 0
        chunk = np.frombuffer(self.text, np.uint8, self.ends[k] - at, at)
        starts = np.flatnonzero(chunk & 0xC0 != 0x80)
        return at + int(starts[points - (self.upto[k - 1] if k else 0)])


_chunks = Chunks()


def rebuilt(output: bytes, form: str) -> bytes:
    """The text of an output, from it and the form alone."""
    if form == "plain":
        return output
    p, s, m = (output.index(x) for x in MARK_BYTES)
    if form == "psm":
        return output[p + 3: s] + output[m + 3:] + output[s + 3: m]
    return output[p + 3: m] + output[m + 3:] + output[s + 3: p]


def write_middle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (row, text, h1, h2, plain, spm) to (row, n, form, prefix_chars,
    middle_chars, output)."""
    p, s, m = MARK_BYTES
    for b in slices(batches):
        made: list[tuple] = []
        for text, h1, h2, plain, spm in zip(*[b.column(i).to_pylist() for i in range(1, 6)], strict=True):
            got = Measured(text, _chunks)
            if plain or got.marked or not text:
                made.append((got.n, "plain", None, None, text))
                continue
            first, last = sorted((h1 % (got.n + 1), h2 % (got.n + 1)))
            i, j = got.byte_of(first), got.byte_of(last)
            prefix, middle, suffix = text[:i], text[i:j], text[j:]
            out = b"".join((s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle))
            made.append((got.n, "spm" if spm else "psm", first, last - first, out))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in made], k) for i, k in enumerate(kinds)]],
                                         names=["row", "n", "form", "prefix_chars", "middle_chars", "output"])


def drawn(id_col: Column, k: int, salt: str = "1:") -> Column:
    """The k-th group of 8 hex digits (from 1) of the id's sha256 as a number."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, text: str = "text", id_col: str = "doc_id", plain_percent: int = 10, spm_percent: int = 20,
                   salt: str = "1:", columns: list[str] | None = None) -> DataFrame:
    """All rows and the ``columns`` (default: all) of ``docs`` with ``n`` (code
    points), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``
    (the five replace columns of the same name).

    Null text counts as empty; empty texts and those that hold a mark are
    plain, as are ``plain_percent`` of all others; of the rest
    ``spm_percent`` put the suffix first.  The cuts and the form follow
    from the id alone, so repeated ids get the same draws; a null id draws
    as an empty one.  An empty table gives no rows.
    """
    added = ["n", "form", "prefix_chars", "middle_chars", "output"]
    names = [c for c in columns or docs.columns if c not in added]
    key = F.col(f"`{id_col}`")
    body = whole_text(F.col(f"`{text}`")).cast("binary")
    rows = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("row"), body.alias("text"),
                       drawn(key, 1, salt).alias("h1"), drawn(key, 2, salt).alias("h2"),
                       (drawn(key, 3, salt) % 100 >= 100 - plain_percent).alias("plain"), (drawn(key, 4, salt) % 100 < spm_percent).alias("spm"))
    schema = T.StructType([rows.schema["row"], *[T.StructField(c, k) for c, k in zip(added, (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.BinaryType()), strict=True)]])
    made = rows.mapInArrow(write_middle, schema)
    return made.select(*[F.col(f"row.`{c}`").alias(c) for c in names], *added[:4], F.col("output").cast("string").alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text of an output in Spark's own functions.  A text with a mark is
    plain, and no mark overlaps itself, so the first ones are those put in."""
    p, s, m = (F.instr(output, x) for x in MARKS)
    part = lambda a, b: F.substring(output, a + 3, b - a - 3)
    end = F.char_length(output) + 1
    return (F.when(form == "psm", F.concat(part(p, s), part(m, end), part(s, m)))
            .when(form == "spm", F.concat(part(p, m), part(m, end), part(s, p))).otherwise(output))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"])
    back = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (SELECT doc_id, t, n, CAST('0x' || s[1:8] AS BIGINT) AS h1, CAST('0x' || s[9:16] AS BIGINT) AS h2, CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
        ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END AS w FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(w) AS output_sha256, sha256(t) AS restored_sha256 FROM o
"""
