"""Exact, near and substring duplicates and decontamination against brute force."""
import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from keelson.llm import decontaminate, exact_dedup, simhash, suffix_dedup
from keelson.llm import queries as Q

from .conftest import CLASHING, LONG, ROWS, SF, bag

KNOWN = [(i, t or "") for i, t, _ in ROWS]
low = lambda t: t.encode().lower().decode()


def test_exact_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = bag(Q.QUERIES["op3_exact_dedup"](spark, SF), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    want = con.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({Q.SQL['op3_exact_dedup']})").fetchall()
    assert got == collections.Counter(want)


def test_exact_edge_cases(edge_docs, empty_docs):
    got = exact_dedup.exact_dedup(edge_docs)
    assert set(CLASHING) <= set(got.columns)
    groups = collections.defaultdict(list)
    for i, t in KNOWN:
        groups[low(t)].append(i)
    want = collections.Counter()
    for i, t in KNOWN:
        ids = [x for x in groups[low(t)] if x is not None]
        keep = max(ids) if ids else None
        want[i, keep, len(groups[low(t)]), keep is None or i == keep, hashlib.sha256(low(t).encode()).hexdigest()] += 1
    assert bag(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want
    assert exact_dedup.exact_dedup(empty_docs).count() == 0
    kept = exact_dedup.drop_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(low(r["text"] or "") for r in kept.collect()) == sorted(groups)
    assert exact_dedup.drop_copies(empty_docs).count() == 0


def test_equal_hashes_of_different_texts(spark, monkeypatch):
    """Should a hash collide, texts still decide."""
    monkeypatch.setattr(F, "md5", lambda c: F.lit("same"))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")
    got = exact_dedup.exact_dedup(docs)
    assert bag(got, "doc_id", "keep_id", "group_size", "kept") == {(1, 3, 2, False): 1, (2, 2, 1, True): 1, (3, 3, 2, True): 1}


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> j & 1 for h in hashes) > len(hashes)) << j for j in range(64)) if hashes else 0


def brute_components(fps):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


def check_simhash(got, rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = brute_components(set(fps))
    least = {}
    for (i, _), f in zip(rows, fps, strict=True):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = collections.Counter((i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(rows, fps, strict=True))
    assert bag(got, "doc_id", "fingerprint", "component_id") == want


def test_simhash_query(spark, documents):
    check_simhash(Q.QUERIES["op7_simhash"](spark, SF), list(documents.items()))


def test_simhash_edge_cases(edge_docs, empty_docs):
    got = simhash.near_duplicates(edge_docs)
    assert {"row", "words", "source"} <= set(got.columns)
    check_simhash(got, KNOWN)
    assert simhash.near_duplicates(empty_docs).count() == 0
    once = simhash.one_per_component(edge_docs)
    assert once.columns == edge_docs.columns
    fps = {brute_fingerprint(t) for _, t in KNOWN}
    assert once.count() == len(set(brute_components(fps).values()))
    assert simhash.one_per_component(empty_docs).count() == 0


@pytest.mark.parametrize(("distance", "segments"), [(3, 2), (2, 1), (3, 4), (5, 3)])
def test_links_lose_no_pair(spark, distance, segments):
    rnd = random.Random(distance)
    fps = {rnd.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for _ in range(6):
            fps.add(f ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 7))))
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    got = bag(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), distance, segments), "a", "b")
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
    assert set(got) == want and set(got.values()) <= {1}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1060)] + [(2000, 2001)]
    got = dict(bag(simhash.components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    root = dict(got.keys())
    assert len({root[i] for i in range(61)}) == 1 and len({root[i] for i in range(1000, 1060)}) == 1
    assert len(set(root.values())) == 3


def brute_removed(rows):
    first = {}
    big = 1 << 62
    for i, t in rows:
        for a in range(len(t) - 49):
            first[t[a:a + 50]] = min(first.get(t[a:a + 50], big), big if i is None else i)
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for a in range(len(t) - 49):
            if first[t[a:a + 50]] < (big if i is None else i):
                gone[a:a + 50] = True
        yield i, len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()), np.frombuffer(t, np.uint8)[~gone].tobytes()


def test_suffix_query(spark, documents):
    got = bag(Q.QUERIES["op4_suffix_dedup"](spark, SF), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = collections.Counter((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute_removed([(i, t.encode()) for i, t in documents.items()]))
    assert got == want


def test_suffix_edge_cases(edge_docs, empty_docs):
    rows = [(i, t.encode()) for i, t in KNOWN]
    got = [(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(edge_docs).collect()]
    short = [(i, t if t != LONG.encode() else t) for i, t in rows]
    assert collections.Counter(got) == collections.Counter(brute_removed(short))
    assert suffix_dedup.remove_repeats(empty_docs).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_suffix_small_blocks(spark, monkeypatch, seed):
    """Blocks, buckets and parts far smaller than the texts."""
    rnd = random.Random(seed)
    alphabet = rnd.choice(["ab", "abcdefgh"])
    shared = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(20, 160))) for _ in range(4)]
    rows = [(rnd.choice([None, *range(20)]), "".join(rnd.choice(shared) if rnd.random() < .5 else "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
             for _ in range(rnd.randint(0, 6)))) for _ in range(40)]
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 2000)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    out = [(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got.collect()]
    assert collections.Counter(out) == collections.Counter(brute_removed([(i, t.encode()) for i, t in rows]))


def brute_contamination(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t or ""))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - 12)) if w else ():
            windows[tuple(w[k:k + 13])].add(i)
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if x := windows.get(tuple(w[k:k + n])):
                    found |= x
                    hit |= set(range(k, k + n))
        ids = sorted(str(x) for x in found if x is not None)
        yield d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_decontamination_query(spark, documents):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = bag(Q.QUERIES["op6_decontamination"](spark, SF), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == collections.Counter(brute_contamination(documents.items(), items))


@pytest.mark.parametrize("short", [True, False])
def test_decontamination_random(spark, short):
    """Few words, so runs overlap and diagonals abound; short and repeated items, null texts and ids."""
    rnd = random.Random(short)
    text = lambda n: " ".join(rnd.choice("ab" if rnd.random() < .7 else "cde") for _ in range(n))
    items = [(k, text(rnd.randint(13, 40))) for k in range(12)] + [(40, None), (41, "..."), (None, text(20)), (42, "é é, Ä")]
    items += [(50, items[0][1]), (51, text(20) + " " + items[1][1])]
    if short:
        items += [(60 + k, text(k)) for k in (1, 3, 7, 12)]
    docs = [(k, text(rnd.randint(0, 60)) + " " + (rnd.choice(items)[1] or "").upper() + "! " + text(rnd.randint(0, 30))) for k in range(60)]
    docs += [(100, None), (None, items[0][1]), (7, docs[7][1]), (7, items[2][1])]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.verdicts(d, b).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").alias("n"), F.sha2(F.array_join("item_ids", ","), 256).alias("s"), "contaminated")
    assert bag(got, *got.columns) == collections.Counter(brute_contamination(docs, items))


def test_decontamination_edge_cases(spark, edge_docs, empty_docs):
    items = spark.createDataFrame([(1, "same text of two rows")], "item_id long, text string")
    got = decontaminate.contamination(edge_docs, items)
    assert {"words", "row", "h"} <= set(got.columns) and got.count() == len(ROWS)
    kept = decontaminate.clean_documents(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, t in KNOWN if low(t) != "same text of two rows")
    assert decontaminate.clean_documents(edge_docs, items.limit(0)).count() == len(ROWS)
    assert decontaminate.clean_documents(empty_docs, items).count() == 0
    assert decontaminate.contamination(empty_docs, items).count() == 0


def test_large_sides_join_by_shuffle(spark, documents, monkeypatch):
    """Beyond the broadcast bound the same rows come out."""
    from keelson.llm import common
    monkeypatch.setattr(common.broadcast_if_small, "__defaults__", (0,))
    test_decontamination_query(spark, documents)
    test_simhash_query(spark, documents)
