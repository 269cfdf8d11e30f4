"""Token sequences of fixed length by sum-of-squares online packing.

Each document is tokenised, closed by an end id and cut into full windows
and one remainder.  Remainders are placed one after another: with N(h)
windows filled up to level h, a piece of length s goes to the level h (0 is
a new window) for which the sum of N squared over all partially filled
levels becomes least.  N is a level array; each level keeps the windows that
stand at it.

Blocks of pieces, dealt by hash, are packed independently, so a task holds
one block; sequence numbers follow from the blocks' counts.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, slices, stored, table

WINDOW = 2048
END_ID = 1
#: Pieces a block holds about.
BLOCK = 100_000
#: Longer texts are encoded in parts of about this many characters.
PART = 1 << 20

#: A space between two other characters: no merge crosses it, nor the text before it.
_SAFE = re.compile(r"(?<=\S) (?=\S)")


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each
    byte: printable Latin-1 stands for itself, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a text under a byte-level BPE vocabulary file (JSON).

    The file defines the ids.  When its merges are numbered in their order,
    its tokens are ranks and the faster of the two installed encoders gives
    the same ids; texts that hold a special token's string, and other
    files, go to the file's own library.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.core = self.ranked(vocabulary)

    def ranked(self, vocabulary: str):  # noqa: ANN201
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        ids = model.get("vocab", {})
        ordered = [ids.get(a + b) for a, b in merges] == list(range(256, 256 + len(merges)))
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and spec.get("normalizer") is None
        if model.get("type") != "BPE" or not ordered or not plain:
            return None
        import public_tokenizers
        import tiktoken
        of = byte_symbols()
        ranks = {bytes(of[c] for c in token): i for token, i in ids.items() if token not in self.special}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.core is None or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return np.concatenate([np.array(self.core.encode_ordinary(p), "<u4") for p in parts(text)])


def parts(text: str) -> Iterator[str]:
    """A long text cut before single spaces between other characters."""
    at = 0
    while len(text) - at > 2 * PART and (m := _SAFE.search(text, at + PART)):
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def cut(vocabulary: str, window: int, end_id: int, with_ids: bool) -> Callable:
    """Rows of (id, text) to the rows of their pieces."""
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in slices(batches):
            out: list[tuple] = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = memoryview(np.append(enc.encode(text or ""), end).tobytes())
                n = len(raw) // 4
                for at in range(0, n, window):
                    piece = raw[4 * at: 4 * min(n, at + window)]
                    out.append((key, at, len(piece) // 4, zlib.crc32(piece), n, bytes(piece) if with_ids else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((b.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
    return run


def place(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Sequence (from 0) and offset of each piece, placed in the given order."""
    level = np.zeros(window + 1, np.int64)  # N(h); 0 and the full level stay 0
    open_at: list[list[int]] = [[] for _ in range(window + 1)]
    seq, off, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        best, cost = 0, (2 * int(level[s]) + 1 if s < window else 0)
        if 0 < s < window:
            # moving a window from h to h+s changes the sum of squares by this
            here = level[1: window - s + 1]
            change = 2 * (level[1 + s: window + 1] - here) + 2
            change[-1] = 1 - 2 * here[-1]
            change[here == 0] = np.iinfo(np.int64).max
            h = int(np.argmin(change))
            if change[h] <= cost:
                best = h + 1
        if best:
            seq[i], off[i] = open_at[best].pop(), best
            level[best] -= 1
        else:
            seq[i], n = n, n + 1
        if best + s < window:
            level[best + s] += 1
            open_at[best + s].append(int(seq[i]))
    return seq, off


def pack_documents(docs: DataFrame, vocabulary: str, text: str = "text", id_col: str = "doc_id", window: int = WINDOW,
                   end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: the id, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and, unless ``with_ids`` is
    false, ``ids`` (little-endian unsigned 32-bit).

    Null text counts as empty: such a document is the end id alone.  A null
    id is an id; repeated rows are packed each.  Only the id and the text
    of ``docs`` are used, so other columns cannot clash.  An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    pieces = stored(spark, slim.mapInArrow(cut(vocabulary, window, end_id, with_ids), schema), "pieces")
    blocks = max(1, round(pieces.count() / BLOCK))

    def pack_block(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["ids_crc32", "start", "length"], kind="stable").reset_index(drop=True)
        block["local"], block["offset"] = place(block["length"].to_numpy(), window)
        return block

    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("id", "start"), F.lit(blocks)))
    packed = stored(spark, dealt.groupBy("block").applyInPandas(pack_block, f"{schema}, block long, local long, offset long"), "packed")
    counts = packed.groupBy("block").agg((F.max("local") + 1).alias("n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return packed.join(broadcast_if_small(first, blocks), "block").select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("local")).alias("sequence_id"), "offset",
        *(["ids"] if with_ids else []))


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), default_vocabulary(), with_ids=False)
