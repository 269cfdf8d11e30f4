"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are hashed, K consecutive word hashes give a k-gram hash, and of every
SPAN consecutive k-grams the least hash is a fingerprint.  With
K + SPAN - 1 = WINDOW words, any shared run of WINDOW words has a
fingerprint in common, so joining the fingerprints of documents and items
misses none.  Each hit fixes a diagonal (document position minus item
position); along it the words themselves are compared, and runs of at least
WINDOW equal words are the hits.  Items shorter than WINDOW are windows as a
whole; winnowing does not guarantee those, so their word sequences are
joined one by one, length by length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, broadcast_if_small, in_struct, row_key, stored, table, whole_text, without

#: Contract: a window is this many words, and a document is contaminated from 1/SHARE of its words on.
WINDOW = 13
SHARE = 20
K = 5
SPAN = WINDOW - K + 1

#: Fixed value: all characters that are not part of a word, after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def run_hashes(hashes: Column, n: Column, length: int) -> Column:
    """Hash of every run of ``length`` word hashes; empty if there is none."""
    return F.when(n >= length, F.transform(F.sequence(F.lit(0), n - length), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(length)]))) \
        .otherwise(F.array().cast("array<bigint>"))


def winnowed(grams: Column) -> Column:
    """The distinct least hashes of every SPAN consecutive k-grams."""
    least = F.transform(F.sequence(F.lit(0), F.size(grams) - SPAN), lambda i: F.least(*[F.get(grams, i + k) for k in range(SPAN)]))
    return F.when(F.size(grams) >= SPAN, F.array_distinct(least)).otherwise(F.array().cast("array<bigint>"))


def hashed(rows: DataFrame) -> DataFrame:
    """Adds ``words`` (from ``text``), ``n``, ``hashes``, ``grams``."""
    rows = rows.withColumn("words", words_of(F.col("text"))).withColumn("n", F.size("words"))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return rows.withColumn("grams", run_hashes(F.col("hashes"), F.col("n"), K))


def benchmark_items(items: DataFrame, text: str, id_col: str) -> DataFrame:
    """One row per distinct word sequence: ``iid``, ``words``, ``n``, ``hashes``, ``grams``, ``ids``."""
    rows = hashed(items.select(F.col(f"`{id_col}`").cast("string").alias("item"), whole_text(F.col(f"`{text}`")).alias("text"))).where("n > 0")
    return rows.groupBy("words", "n", "hashes", "grams").agg(F.collect_set("item").alias("ids")).withColumn("iid", F.monotonically_increasing_id())


def long_hits(docs: DataFrame, prints: DataFrame, items: DataFrame) -> DataFrame:
    """Hits (id, th, iid, first, last) of items with WINDOW words or more."""
    spark = docs.sparkSession
    long_items = items.where(F.col("n") >= WINDOW)
    chosen = long_items.withColumn("chosen", winnowed(F.col("grams")))
    places = stored(spark, chosen.select("iid", "chosen", F.posexplode("grams").alias("q", "h")).where(F.array_contains("chosen", F.col("h"))).select("h", "iid", "q"), "item-prints")
    n_places = places.count()
    known = broadcast_if_small(places.select("h").distinct(), n_places)
    candidates = stored(spark, prints.select("id", "th", F.explode("chosen").alias("h")).join(known, "h")
                        .groupBy("id", "th").agg(F.collect_set("h").alias("hs")), "candidates")
    total = candidates.agg(F.coalesce(F.sum(F.size("hs") + 2), F.lit(0))).first()[0]
    found = docs.join(broadcast_if_small(candidates, total), docs["id"].eqNullSafe(candidates["id"]) & (docs["th"] == candidates["th"])) \
        .select(docs["id"], docs["th"], "text", "hs")
    found = hashed(found)
    found = found.withColumn("at", F.filter(F.transform("grams", lambda h, p: F.struct(p.alias("p"), h.alias("h"))), lambda g: F.array_contains("hs", g["h"])))
    texts = stored(spark, found.select("id", "th", "words", "n", "at"), "candidate-texts")
    diagonals = (texts.select("id", "th", F.explode("at").alias("at")).select("id", "th", "at.p", "at.h")
                 .join(broadcast_if_small(places, n_places), "h").select("id", "th", "iid", (F.col("p") - F.col("q")).alias("delta")).distinct())
    a, b = diagonals.alias("a"), texts.select("id", "th", "words", "n").alias("b")
    lined = (a.join(b, F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.th") == F.col("b.th")))
             .join(long_items.select("iid", F.col("words").alias("item"), F.col("n").alias("m")), "iid")
             .select("a.id", "a.th", "iid", "delta", "item", F.greatest(F.lit(0), -F.col("delta")).alias("lo"),
                     (F.least(F.col("m"), F.col("n") - F.col("delta")) - 1).alias("hi"), "words"))
    # the positions on either side of the overlap count as differing
    differ = F.concat(F.array(F.col("lo") - 1), F.filter(F.sequence("lo", "hi"), lambda j: F.get("words", j + F.col("delta")) != F.get("item", j)), F.array(F.col("hi") + 1))
    lined = lined.where("hi >= lo").withColumn("differ", differ)
    runs = F.transform(F.sequence(F.lit(1), F.size("differ") - 1),
                       lambda x: F.struct((F.get("differ", x - 1) + 1 + F.col("delta")).alias("first"), (F.get("differ", x) - 1 + F.col("delta")).alias("last")))
    return (lined.select("id", "th", "iid", F.explode(F.filter(runs, lambda r: r["last"] - r["first"] + 1 >= WINDOW)).alias("r"))
            .select("id", "th", "iid", "r.first", "r.last"))


def short_hits(docs: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    """Hits of items with fewer than WINDOW words, of the given lengths."""
    short = items.where(F.col("n") < WINDOW)
    whole = None
    for length in lengths:
        some = short.where(F.col("n") == length).select("iid", "n", run_hashes(F.col("hashes"), F.col("n"), length)[0].alias("h"), F.col("words").alias("item"))
        whole = some if whole is None else whole.unionByName(some)
    whole = stored(docs.sparkSession, whole, "short-items")
    n = whole.count()
    side = broadcast_if_small(whole.select("iid", "n", "h"), n)
    rows = hashed(docs).withColumn("runs", F.concat(*[run_hashes(F.col("hashes"), F.col("n"), length) for length in lengths]))
    pairs = rows.select("id", "th", F.explode(F.array_distinct("runs")).alias("h")).join(side, "h").select("id", "th", "iid").distinct()
    pairs = stored(docs.sparkSession, pairs, "short-pairs")
    p = broadcast_if_small(pairs, pairs.count())
    found = hashed(docs.join(p, docs["id"].eqNullSafe(p["id"]) & (docs["th"] == p["th"])).select(docs["id"], docs["th"], "text", "iid"))
    found = found.withColumnRenamed("n", "dn").join(broadcast_if_small(whole.drop("h"), n), "iid").where("dn >= n")
    at = F.filter(F.sequence(F.lit(0), F.col("dn") - F.col("n")), lambda i: F.slice("words", i + 1, F.col("n")) == F.col("item"))
    return found.select("id", "th", "iid", "n", F.explode(at).alias("first")).select("id", "th", "iid", "first", (F.col("first") + F.col("n") - 1).alias("last"))


def covered(spans: Column) -> Column:
    """Positions covered by an array of (first, last), each counted once."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end"))
    return F.aggregate(F.array_sort(spans), start, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(acc["end"], s["first"] - 1))).alias("n"),
        F.greatest(acc["end"], s["last"]).alias("end")))["n"]


def verdicts(docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text",
             item_id: str = "item_id") -> DataFrame:
    """One row per row of ``docs``: its key (id, th) with ``n_words``,
    ``n_hit``, ``item_ids`` (strings, sorted), ``spans`` (hits, first and
    last word) and ``contaminated``.

    Null texts have no words and are clean; an item without words never
    hits.  Items of equal words count under each of their ids, null ids
    under none.  Repeated rows get the same result each.  Without items
    every document is clean; an empty table gives no rows.
    """
    spark = docs.sparkSession
    slim = docs.select(*row_key(id_col, text), whole_text(F.col(f"`{text}`")).alias("text"))
    known = stored(spark, benchmark_items(items, item_text, item_id), "items")
    prints = stored(spark, hashed(slim).select("id", "th", F.col("n").cast("long").alias("n_words"), winnowed(F.col("grams")).alias("chosen")), "prints")
    hits = long_hits(slim, prints, known)
    lengths = sorted(r["n"] for r in known.where(F.col("n") < WINDOW).select("n").distinct().collect())  # at most WINDOW - 1
    if lengths:
        hits = hits.unionByName(short_hits(slim, known, lengths))
    hits = hits.join(known.select("iid", "ids"), "iid", "left")
    per_doc = (hits.groupBy("id", "th").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans"),
                                            F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("item_ids")))
    p = stored(spark, per_doc.withColumn("n_hit", covered(F.col("spans")).cast("long")), "hits").alias("p")
    joined = prints.alias("d").join(p, F.col("d.id").eqNullSafe(F.col("p.id")) & (F.col("d.th") == F.col("p.th")), "left")
    n_hit = F.coalesce("p.n_hit", F.lit(0).cast("long"))
    return joined.select("d.id", "d.th", "d.n_words", n_hit.alias("n_hit"), F.coalesce("p.item_ids", F.array().cast("array<string>")).alias("item_ids"),
                         F.coalesce("p.spans", F.array().cast("array<struct<first:int,last:int>>")).alias("spans"),
                         ((n_hit > 0) & (n_hit * SHARE >= F.col("d.n_words"))).alias("contaminated"))


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """All rows of ``docs`` with the columns of ``verdicts`` (they replace
    columns of the same name, but for id and th, which are left out)."""
    added = ["n_words", "n_hit", "item_ids", "spans", "contaminated"]
    plain = docs.select([F.col(f"`{c}`") for c in docs.columns if c not in added])
    found = verdicts(docs, items, text, id_col).distinct().alias("v")
    rows = in_struct(plain, id_col, text).alias("d")
    return rows.join(found, F.col("d.id").eqNullSafe(F.col("v.id")) & (F.col("d.th") == F.col("v.th"))).select("d.row.*", *[f"v.{c}" for c in added])


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the contaminated rows; nothing else is changed."""
    bad = verdicts(docs, items, text, id_col).where("contaminated")
    return without(docs, bad, id_col, text)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = verdicts(docs, table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
i AS (SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS win FROM i),
lens AS (SELECT DISTINCT k FROM iw),
dp AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, lens WHERE len(w) >= k),
dw AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS win FROM dp),
hits AS (SELECT dw.doc_id, dw.k, dw.s, iw.item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(pos.n_hit, 0) AS n_hit, coalesce(its.n_items, 0) AS n_items,
  sha256(coalesce(its.items, '')) AS items_sha256, coalesce(pos.n_hit, 0) > 0 AND 20 * coalesce(pos.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN pos ON pos.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""
