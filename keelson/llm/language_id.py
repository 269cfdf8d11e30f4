"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training adds up, per language, how often each hashed n-gram (one to three
characters, lower-cased) occurs; every task sums the texts it reads and
sends one block of counts per language, and the blocks are summed by key.
The matrix of log probabilities (buckets x languages) has a size that the
parameters fix, not the corpus, and is broadcast; batches of texts are then
scored as sparse sums of its rows in numpy.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_blocks, crc_text, pieces, slices, table

#: 2**BITS buckets of n-grams.
BITS = 16
ORDERS = (1, 2, 3)
#: Added to each count.
SMOOTH = 0.1
#: Buckets in a block of counts.
BLOCK = 1 << 14
#: Characters scored at a time (a longer text is scored in parts).
CHARS = 1 << 20
UNKNOWN = "und"

_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _WORDLIKE.finditer(text))


def grams(points: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each code point; the last
    ``order - 1`` starts are left out."""
    n = max(0, len(points) - order + 1)
    h = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        h ^= points[k:k + n]
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - bits)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)


def all_grams(found: list[str], bits: int) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of the texts, in arrays of about CHARS; none
    reaches from one text into the next."""
    points = [code_points(t) for t in found]
    for k in ORDERS:
        for a, b in pieces([len(p) for p in points], CHARS):
            yield np.concatenate([grams(p, k, bits) for p in points[a:b]])


def count_task(bits: int) -> Callable:
    """Rows of (label, text) to blocks of counts per label; block -1 holds
    the number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for b in slices(batches):
            by: dict[str, list[str]] = {}
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by.setdefault(label, []).append(text or "")
            for label, found in by.items():
                rows[label] = rows.get(label, 0) + len(found)
                total = sums.setdefault(label, np.zeros(1 << bits, np.int64))
                for h in all_grams(found, bits):
                    total += np.bincount(h, minlength=1 << bits)
        out = [(label, -1, np.array([n], np.int64).tobytes()) for label, n in rows.items()]
        step = min(BLOCK, 1 << bits)
        out += [(label, at // step, total[at:at + step].tobytes()) for label, total in sums.items() for at in range(0, 1 << bits, step)]
        if out:
            yield pa.RecordBatch.from_pydict({"label": [x[0] for x in out], "block": [x[1] for x in out], "counts": [x[2] for x in out]},
                                             pa.schema([("label", pa.string()), ("block", pa.int64()), ("counts", pa.binary())]))
    return run


def train(rows: DataFrame, bits: int = BITS) -> tuple[list[str], np.ndarray]:
    """Labels (sorted) and log probabilities (2**bits + 1 rows, one column a
    label; the last row holds the priors) from rows of (label, text)."""
    spark = rows.sparkSession
    found = rows.mapInArrow(count_task(bits), "label string, block long, counts binary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = add_blocks(found, ["label", "block"], "counts", "int64", n).collect()  # labels x 2**bits counts
    labels = sorted({r["label"] for r in got})
    step = min(BLOCK, 1 << bits)
    counts, docs = np.zeros((1 << bits, len(labels))), np.zeros(len(labels))
    for r in got:
        values, at = np.frombuffer(r["counts"], np.int64), labels.index(r["label"])
        if r["block"] < 0:
            docs[at] = values[0]
        else:
            counts[r["block"] * step:r["block"] * step + len(values), at] = values
    logs = np.log(counts + SMOOTH) - np.log(counts.sum(axis=0) + SMOOTH * (1 << bits))
    prior = np.log(docs + 1) - np.log(docs.sum() + len(labels)) if labels else docs
    return labels, np.vstack([logs, prior[None, :]])


def score_texts(found: list[str], logs: np.ndarray, bits: int) -> np.ndarray:
    """Log joint probabilities, texts x labels; long texts are summed in parts."""
    out = np.repeat(logs[-1:], len(found), axis=0)
    points = [code_points(t) for t in found]
    for a, b in pieces([len(p) for p in points], CHARS):
        if b - a == 1 and len(points[a]) > CHARS:
            for at in range(0, len(points[a]), CHARS):
                for k in ORDERS:
                    part = points[a][at:at + CHARS + k - 1]
                    out[a] += logs[grams(part, k, bits)].sum(axis=0)
            continue
        joined = np.concatenate(points[a:b])
        ends = np.cumsum([len(p) for p in points[a:b]])
        starts = np.concatenate([[0], ends[:-1]])
        for k in ORDERS:
            h = grams(joined, k, bits)
            rows = logs[h]
            for e in ends[:-1]:
                rows[max(0, e - k + 1):e] = 0  # n-grams that reach into the next text
            keep = starts < len(h)
            out[a:b][keep] += np.add.reduceat(rows, starts[keep], axis=0) if keep.any() else 0
    return out


def identify(docs: DataFrame, training: DataFrame, text: str = "text", bits: int = BITS) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score``, the
    posterior of that label (they replace columns of the same name).

    ``training`` has label and text; null labels are left out.  A null text,
    or one without a letter, is ``und`` with score 0; so is every text when
    nothing was learned.  Ties go to the label that sorts first.  Repeated
    rows and other columns are left as they are; an empty table gives none.
    """
    spark = docs.sparkSession
    labels, logs = train(training.select("label", "text").where("label is not null"), bits)
    model = spark.sparkContext.broadcast((labels, logs))
    docs = docs.select([c for c in docs.columns if c not in ("lang_pred", "score")])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, logs = model.value
        for b in slices(batches):
            texts = b.column(at).to_pylist()
            known = [i for i, t in enumerate(texts) if labels and t and has_letter(t)]
            pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if known:
                joint = score_texts([texts[i] for i in known], logs, bits)
                best = joint.argmax(axis=1)
                sure = 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
                for i, k, s in zip(known, best, sure, strict=True):
                    pred[i], score[i] = labels[k], s
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=[*b.schema.names, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    return crc_text(F.col(id_col)) % 3 == 1


def training_rows(docs: DataFrame) -> DataFrame:
    """The contract's training rows: remainder not 1 and a known language."""
    return docs.where(~held_out()).select(F.col("lang").alias("label"), "text")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), training_rows(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
