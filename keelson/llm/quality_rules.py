"""Quality rules: counts per document and a hashed n-gram likelihood ratio.

Words and pairs of neighbouring words are hashed (XXH64) into ``BUCKETS``
buckets.  Two multinomials over the buckets are counted: the trusted target
(documents labelled good and not toxic) and the raw corpus (all documents).
A document's score is the mean, over its n-grams, of the logarithm of target
over raw probability, so its length does not matter.  Every document at or
above the threshold is kept; nothing is drawn at random.

The threshold is learned too: a quarter of the labelled documents, those
whose id's MD5 starts with a digit below ``HELD``, is left out of the target,
and the threshold is the one that tells their good from their bad ones best.

All of it is DataFrame functions.  The texts are read once: counts and
buckets of each document are stored (about the size of the input), and both
passes over the buckets read that.  Buckets are exploded and added up
map-side, so what is shuffled is a row for each bucket (training) or document
(scoring); the ratios are a broadcast of at most ``BUCKETS`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, stored, table, whole_text

#: A power of two: the last bits of the hash are the bucket.
BUCKETS = 1 << 16
#: Added to every bucket's count.
ADDED = 1.0
#: Labelled documents whose id's MD5 is below it choose the threshold.
HELD = "4"
#: Scores are told apart in steps of 1/STEPS between LEAST and -LEAST when the threshold is chosen.
STEPS, LEAST = 200, -3.0
#: The threshold where no labelled documents of both kinds are held out.
THRESHOLD = -0.05

#: White space between words, and the symbols that are counted.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words(text: Column) -> Column:
    core = F.btrim(text, F.lit(SPACES))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, r"[\x20\x09-\x0D]+"))


def without_any(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def from_nth(array: Column, n: int) -> Column:
    """The array from its n-th element on (empty when it is shorter)."""
    return F.slice(array, F.lit(n), F.greatest(F.size(array) - (n - 1), F.lit(0)))


def hashed_on(hashes: Column, tokens: Column, n: int) -> Column:
    """Hashes of n-word windows from those of their first n - 1 words."""
    joined = F.zip_with(hashes, from_nth(tokens, n), lambda h, w: F.xxhash64(h, w))
    return F.slice(joined, F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(0)))


def sorted_windows(tokens: Column) -> Column:
    """The text's windows of three words as (window, position), sorted: equal
    windows are neighbours.  For three words or more."""
    return F.sort_array(F.transform(F.sequence(F.lit(1), F.size(tokens) - 2), lambda i: F.struct(
        F.concat_ws(" ", F.get(tokens, i - 1), F.get(tokens, i), F.get(tokens, i + 1)).alias("w"), i.alias("i"))))


def repeated_words(windows: Column) -> Column:
    """How many words lie in a window that the text holds twice or more."""
    equal = F.zip_with(windows, from_nth(windows, 2), lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])))
    at = F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull())))
    return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))


def measured(rows: DataFrame, text: str) -> DataFrame:
    """Adds the ``COUNTS``, all long, and ``buckets``: those of the text's
    words and pairs of words."""
    # each step is a projection of its own: its result is used several times
    names = rows.columns
    rows = rows.withColumn("tokens", words(F.col(text)))
    rows = rows.withColumns({"one": F.transform("tokens", lambda w: F.xxhash64(w)),
                             "lines": F.filter(F.split(F.col(text), "\n", -1), lambda x: x.rlike(WORD))})
    rows = rows.withColumn("two", hashed_on(F.col("one"), F.col("tokens"), 2))
    # equal windows have equal hashes: only texts where hashes repeat compare windows
    rows = rows.withColumn("three", hashed_on(F.col("two"), F.col("tokens"), 3))
    rows = rows.withColumn("windows", F.when(F.size("three") > F.size(F.array_distinct("three")), sorted_windows(F.col("tokens"))))
    return rows.select(
        *[c for c in names if c != text],
        F.size("tokens").cast("long").alias("n_words"),
        F.char_length(F.array_join("tokens", "")).cast("long").alias("word_chars"),
        (F.octet_length(text) - F.octet_length(without_any(F.col(text), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeated_words(F.col("windows")), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.transform(F.concat("one", "two"), lambda h: h.bitwiseAND(BUCKETS - 1).cast("int")).alias("buckets"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def verdicts(labels: DataFrame, id_col: str) -> DataFrame:
    """One row per labelled id: ``good`` (all its labels say quality 1 and not
    toxic), ``bad`` (none says quality 1) and ``held``."""
    key = F.col(f"`{id_col}`")
    found = (labels.select(key.alias("id"), F.col("quality").alias("q"), F.coalesce("toxic", F.lit(0)).alias("t"))
             .where("id is not null and q is not null").groupBy("id")
             .agg(F.min("q").alias("least"), F.max("q").alias("most"), F.max("t").alias("toxic")))
    return found.select("id", ((F.col("least") == 1) & (F.col("toxic") == 0)).alias("good"), (F.col("most") == 0).alias("bad"),
                        (F.md5(F.col("id").cast("string").cast("binary")) < HELD).alias("held"))


def log_ratios(grams: DataFrame) -> DataFrame:
    """``bucket`` and ``ratio`` of the buckets that occur; ``grams`` has
    ``bucket`` and ``trusted``."""
    spark = grams.sparkSession
    counts = stored(spark, grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col("trusted")).alias("target")), "gram-counts")
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    if not total["target"]:          # nothing is trusted: no evidence for or against
        return counts.select("bucket", F.lit(0.0).alias("ratio"))
    share = lambda c: (F.col(c) + ADDED) / (total[c] + ADDED * BUCKETS)
    return counts.select("bucket", F.log(share("target") / share("raw")).alias("ratio"))


def best_threshold(scores: DataFrame) -> float:
    """The score that tells good from bad best: most of (share of good at or
    above it + share of bad below it).  Where a range of scores does so
    equally, it is divided as good to bad: the more there are of a kind, the
    less its others go beyond those seen.  ``scores`` has ``score``,
    ``good`` and ``bad``; at most 2 * STEPS * -LEAST + 1 counts reach the
    driver."""
    clipped = F.least(F.greatest(F.col("score"), F.lit(LEAST)), F.lit(-LEAST))
    bins = (scores.where("good or bad").groupBy(F.floor(clipped * STEPS).cast("int").alias("step"))
            .agg(F.count_if("good").alias("good"), F.count_if("bad").alias("bad")).orderBy("step").collect())
    good, bad = sum(b["good"] for b in bins), sum(b["bad"] for b in bins)
    if not good or not bad:
        return THRESHOLD
    gain, best = [], 0
    for b in bins:                   # gain of a threshold at the lower end of each step
        gain.append(best)
        best += b["bad"] * good - b["good"] * bad
    at = [i for i, g in enumerate(gain) if g == max(gain)]
    first, last = at[0], at[-1]
    # the plateau reaches down to the end of the step before the first of them
    low = bins[first - 1]["step"] + 1 if first else bins[first]["step"]
    return (low * bad + bins[last]["step"] * good) / (good + bad) / STEPS


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", threshold: float | None = None,
          columns: list[str] | None = None) -> DataFrame:
    """All rows and the ``columns`` (default: all) of ``docs`` with the
    ``COUNTS``, ``score``, ``base_failed`` and ``kept`` (they replace columns
    of the same name).

    ``threshold`` fixes the least score of a kept document; by default it is
    learned from the held-out labels.  Null text counts as empty: no words,
    score 0, ``base_failed``.  Labels with a null id or quality are left
    out; an id labelled both ways counts as neither.  Without trusted
    documents every score is 0 and the base rules alone decide.  Null and
    repeated ids are rows like any other.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    added = [*COUNTS, "score", "base_failed", "kept"]
    names = [c for c in columns or docs.columns if c not in added]
    said = stored(spark, verdicts(labels, id_col), "verdicts")
    trusted = said.where("good and not held").select(F.col("id").alias("known"), F.lit(True).alias("trusted"))
    key, body = F.col(f"`{id_col}`"), whole_text(F.col(f"`{text}`"))

    # the row number tells rows apart; it is stored with them
    rows = docs.select(F.monotonically_increasing_id().alias("at"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("row"),
                       key.alias("id"), body.alias("body"))
    found = stored(spark, measured(rows, "body"), "measured")
    slim = found.select("id", "buckets").join(broadcast_if_small(trusted, trusted.count()), F.col("id") == F.col("known"), "left")
    grams = slim.select(F.coalesce("trusted", F.lit(False)).alias("trusted"), F.explode("buckets").alias("bucket"))
    means = (found.select("at", F.explode("buckets").alias("bucket")).join(F.broadcast(log_ratios(grams)), "bucket")
             .groupBy("at").agg(F.avg("ratio").alias("score")))
    scored = (found.drop("buckets").join(means, "at", "left").drop("at").withColumn("score", F.coalesce("score", F.lit(0.0)))
              .withColumn("base_failed", base_failed()))
    scored = stored(spark, scored, "scores")
    if threshold is None:
        threshold = best_threshold(scored.where("not base_failed").join(said.where("held"), "id"))
    return (scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(threshold)))
            .select(*[F.col(f"row.`{c}`").alias(c) for c in names], *added))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, table(spark, sf_dir, "labels"), columns=["doc_id"])
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")

