"""Quality rules against a plain version: counts, buckets, ratios, threshold."""
import collections
import math
import re

import pytest
import xxhash

from keelson.llm import quality_rules as R
from keelson.llm import queries as Q
from keelson.llm.common import table

from .conftest import SF, bag

TEXTS = [None, "", " \t\n\x0b\x0c\r ", "one", "a b", "a b c", "a b c a b c", "x x x x", "l1\nl1\n\nl1 \n \n l1", "# $ <é> 日本 | *%&", "é b c", "a b c d a b c e b c d",
         "w " * 60, "word " * 40_000, " ".join(f"n{i}" for i in range(80)), " ".join(f"n{i % 50}" for i in range(80)), "tail\n", "\n\nx\r\nx\r\nx"]


def counts(text):
    t = text or ""
    k = re.findall(r"[^\x20\x09-\x0D]+", t)
    at = collections.defaultdict(list)
    for i in range(len(k) - 2):
        at[tuple(k[i:i + 3])].append(i)
    repeated = {i + o for v in at.values() if len(v) > 1 for i in v for o in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(k), sum(map(len, k)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated)


def buckets(text):
    k = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    one = [xxhash.xxh64_intdigest(w, 42) for w in k]
    # a number is hashed as its 8 bytes, and the result seeds the hash of the word
    two = [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(one, k[1:])]
    return [h % R.BUCKETS for h in one + two]


def ratios(docs, trusted):
    raw, target = collections.Counter(), collections.Counter()
    for i, t in docs:
        raw.update(buckets(t))
        if i in trusted:
            target.update(buckets(t))
    nr, nt = raw.total() + R.BUCKETS, target.total() + R.BUCKETS
    return {b: math.log((target[b] + 1) / nt / ((raw[b] + 1) / nr)) for b in raw}


def test_counts_and_buckets(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "at int, body string").na.fill("", ["body"])
    for r in R.measured(docs, "body").collect():
        t = TEXTS[r["at"]]
        assert tuple(r[c] for c in R.COUNTS) == counts(t), repr(t)[:50]
        assert r["buckets"] == buckets(t)


@pytest.mark.parametrize(("good", "bad", "want"), [
    ([0.1, 0.2], [-0.5], (-0.5, 0.1)), ([0.1] * 9, [-0.5], (-0.1, 0.1)), ([0.1, -1.0], [-0.5, -2.0], (-2.0, 0.1)), ([0.1], [], None), ([], [], None), ([9.0], [-9.0], (-3.0, 3.0))])
def test_threshold(spark, good, bad, want):
    rows = [(s, True, False) for s in good] + [(s, False, True) for s in bad] + [(0.0, False, False)]
    got = R.best_threshold(spark.createDataFrame(rows, "score double, good boolean, bad boolean"))
    assert got == R.THRESHOLD if want is None else want[0] < got <= want[1]


def test_edge_cases(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(7, 1, 0), (8, 1, 0), (1, 0, 0), (1, 1, 0), (2, 0, 1), (None, 1, 0), (3, None, 0), (9, 1, None)], "doc_id long, quality int, toxic int")
    got = R.judge(edge_docs, labels, threshold=-1.0)
    added = [*R.COUNTS, "score", "base_failed", "kept"]
    assert got.columns == [*[c for c in edge_docs.columns if c not in added], *added]
    assert bag(got, "doc_id", "text", "norm") == bag(edge_docs, "doc_id", "text", "norm")
    for r in got.collect():
        assert tuple(r[c] for c in R.COUNTS) == counts(r["text"])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= -1.0)
    assert R.judge(empty_docs, labels).count() == 0
    none = R.judge(edge_docs, labels.limit(0))
    assert {r["score"] for r in none.collect()} == {0.0} and all(r["kept"] != r["base_failed"] for r in none.collect())


def test_a_shuffled_join_of_labels_gives_the_same(spark, monkeypatch):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    cols = ["doc_id", "kept", "base_failed"]
    want = bag(R.judge(docs, labels), *cols)
    monkeypatch.setattr(R, "broadcast_if_small", lambda df, rows: df)
    assert bag(R.judge(docs, labels), *cols) == want


def test_query_equals_plain_version(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    labels = table(spark, SF, "labels")
    found = {r["id"]: r for r in R.verdicts(labels, "doc_id").collect()}
    for r in labels.collect():
        assert (found[r["doc_id"]]["good"], found[r["doc_id"]]["bad"]) == (r["quality"] == 1 and r["toxic"] == 0, r["quality"] == 0)
    table_of = ratios(docs, {i for i, r in found.items() if r["good"] and not r["held"]})
    mean = lambda t: sum(table_of[b] for b in buckets(t)) / len(buckets(t)) if buckets(t) else 0.0
    scores = {i: mean(t) for i, t in docs}
    judged = {r["doc_id"]: r for r in R.judge(table(spark, SF, "documents"), labels).collect()}
    assert all(abs(judged[i]["score"] - s) < 1e-9 for i, s in scores.items())
    held = [(scores[i], found[i]["good"], found[i]["bad"]) for i, _ in docs if i in found and found[i]["held"] and not judged[i]["base_failed"]]
    gain = lambda x: sum(s >= x for s, g, _ in held if g) / max(1, sum(g for _, g, _ in held)) + sum(s < x for s, _, b in held if b) / max(1, sum(b for *_, b in held))
    used = max(s for s in scores.values() if s < 0) if not held else R.best_threshold(spark.createDataFrame(held, "score double, good boolean, bad boolean"))
    assert gain(used) == max(gain(k / R.STEPS) for k in range(-600, 601))
    for r in Q.QUERIES["op12_quality_rules"](spark, SF).collect():
        i = r["doc_id"]
        t = dict(docs)[i]
        failed = counts(t)[0] < 50 or 100 * counts(t)[4] > 50 * counts(t)[0]
        assert tuple(r[c] for c in R.COUNTS) == counts(t)
        assert r["base_failed"] == failed and r["kept"] == (not failed and scores[i] >= used)


def test_low_quality_is_told_from_good(spark):
    """Held-out labels of a larger table: nearly all good documents stay, the bad go."""
    sf = SF.replace("0.001", "0.01")
    got = R.judge(table(spark, sf, "documents"), table(spark, sf, "labels"), columns=["doc_id"]).where("not base_failed")
    said = R.verdicts(table(spark, sf, "labels"), "doc_id").where("held")
    rows = got.join(said, got["doc_id"] == said["id"]).collect()
    good, bad = [r["kept"] for r in rows if r["good"]], [r["kept"] for r in rows if r["bad"]]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.2 * len(bad) and len(bad) > 2
