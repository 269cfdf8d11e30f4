"""Language-model scores, language ID, token packing and sharding."""
import collections
import functools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.llm import language_id, lm_mixing, packing, sharding
from keelson.llm import queries as Q

from .conftest import LONG, ROWS, SF, bag

KNOWN = [(i, t or "") for i, t, _ in ROWS]
crc = lambda i: zlib.crc32(str(i).encode())


def words(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()) + [None]


def coded(t):
    """The bytes that the model codes: each word and a space, then the end."""
    return b"".join(w + b" " for w in words(t)[:-1]) + lm_mixing.END


def check_base(rows, got):
    counts = collections.Counter(w for i, t in rows if crc("" if i is None else i) % 7 != 2 for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter((i, crc("" if i is None else i) % 7 == 2, len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
                                round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for i, t in rows)
    have = collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    assert have == want


def test_lm_query(spark, documents):
    got = Q.QUERIES["op2_lm_scoring"](spark, SF).collect()
    check_base(list(documents.items()), got)
    held = [r for r in got if r["held_out"]]
    bits = -sum(r["score"] for r in held) / math.log10(2) / sum(len(b" ".join(words(documents[r["doc_id"]])[:-1])) + 1 for r in held)
    assert 0.5 < bits < 3.5  # far below the eight bits of a byte


def test_lm_beats_its_base_on_held_out_text(spark):
    """By a twentieth of a bit a byte and more, with ten times the text to learn from."""
    got = lm_mixing.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), ~lm_mixing.held_out()).where("not training")
    score, base, n = got.agg(F.sum("score"), F.sum("base_score"), F.sum("n_bytes")).first()
    assert (base - score) / n / math.log10(2) < -0.05


def test_lm_edge_cases(spark, edge_docs, empty_docs):
    got = lm_mixing.score_documents(edge_docs, ~lm_mixing.held_out())
    rows = got.select(F.col("id").alias("doc_id"), (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    check_base(KNOWN, rows)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    assert lm_mixing.score_documents(empty_docs, F.lit(True)).count() == 0
    # nothing learned: every bit of every group costs one
    blind = collections.Counter((r["id"], round(-r["score"] / math.log10(2))) for r in lm_mixing.score_documents(edge_docs, F.lit(False)).collect())
    groups = lambda t: sum(int(lm_mixing._COUNT[x]) for x in coded(t))
    assert blind == collections.Counter((i, 4 * groups(t)) for i, t in KNOWN)


def test_lm_held_out_rows_teach_nothing(spark):
    base = [(i, f"word{i % 7} and some {i % 3} text") for i in range(60)]
    alike = [(i, t if crc(i) % 7 != 2 else "utterly different zzz") for i, t in base]
    score = lambda rows: {r["id"]: (r["base_score"], r["score"]) for r in lm_mixing.score_documents(
        spark.createDataFrame(rows, "doc_id long, text string"), ~lm_mixing.held_out()).collect()}
    a, b = score(base), score(alike)
    assert all(a[i] == pytest.approx(b[i]) for i, _ in base if crc(i) % 7 != 2)


def model_of(learned, scored):
    """A block that learns from some texts and scores these and others, its
    model and the training counts of its words."""
    block = lm_mixing.Block([t.encode() for t in [*learned, *scored]])
    training = np.arange(len(learned) + len(scored)) < len(learned)
    model = lm_mixing.Model(block, lm_mixing.cell_bits(block.cells, block.cell_counts(training)), training)
    return block, model, np.bincount(block.ids[np.repeat(training, block.sizes)], minlength=len(block.words))


def test_lm_is_a_probability():
    """Over all next bytes the probabilities add up to one, but for codes that
    are not used: white space inside words and long codes of frequent bytes."""
    learned = ["the cat sat on the mat", "the dog sat", "été"] * 5
    last = [bytes([x]) for x in range(256) if not bytes([x]).isspace()]
    for prefix in (b"", b"the", b"the c", b"zz"):
        words_ = [prefix + x for x in last]
        block = lm_mixing.Block([*[t.encode() for t in learned], *words_, prefix])
        training = np.arange(len(block.sizes)) < len(learned)
        model = lm_mixing.Model(block, lm_mixing.cell_bits(block.cells, block.cell_counts(training)), training)
        ends, at, total = np.cumsum(block.sizes), len(prefix), 0
        for i, w in enumerate([*words_, prefix], len(learned)):
            cost = model.costs([block.groups(ends[i] - block.sizes[i], ends[i])[0]])[0]
            text = (w + b" \n" if w else b"\n")
            a = sum(int(lm_mixing._COUNT[x]) for x in text[:at])
            total += 2 ** -cost[a:a + int(lm_mixing._COUNT[text[at]])].sum()
        assert 0.97 < total < 1 + 1e-4


def test_lm_scores_do_not_depend_on_the_batch(monkeypatch):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["the", "cat", "sat", "mat", "xyzzy"]) for _ in range(n)) for n in (0, 1, 3, 40, 900, 5)]
    _, model, counts = model_of(texts[:3], texts)
    together = model.scores(counts)
    assert np.allclose(together[:3], together[3:6], rtol=1e-5)
    monkeypatch.setattr(lm_mixing, "CHUNK", 1)
    assert np.allclose(together, model.scores(counts), rtol=1e-5)


def test_lm_very_long_words():
    """Their probability is too small for a floating number; its logarithm is not."""
    block, model, counts = model_of(["a b c"], ["x" * 70_000, "x" * 70_001 + " a"])
    got = model.scores(counts)
    assert np.isfinite(got).all() and got[2] < got[1] < -1000


def plain_scores(learned, scored):
    """The model spelled out: contexts as they are, bit by bit."""
    m = lm_mixing

    def steps(t):
        previous = b"\n"
        for w in [*t.lower().split(), None]:
            body, before_word = (b"\n", previous) if w is None else (w + b" ", previous)
            out = []
            for j, b in enumerate(body):
                whole = before_word + b" " if j == 0 else b" " + body[:j]
                went = ()
                for g in range(int(m._COUNT[b])):
                    value = int(m._VALUE[b][g])
                    out.append((tuple((k, whole if k == m.WORD else whole[-k:], went) for k in m.CONTEXTS), value))
                    went += (value,)
            yield previous, w, out
            previous = w
    counts, single, double = collections.defaultdict(lambda: [0] * 16), collections.Counter(), collections.Counter()
    for t in learned:
        for previous, w, parts in steps(t):
            single[w] += 1
            double[previous, w] += 1
            for slots, value in parts:
                for s in slots:
                    counts[s][value] += 1
    low = lambda n: max(x for x in m._SEEN if x <= n)
    k = len(m.CONTEXTS)

    @functools.cache
    def inputs(slots, value, bit, less):
        seen = []
        for s in slots:
            c, size = counts.get(s, [0] * 16), 16 >> bit
            at = value // size * size
            halves = sum(c[at:at + size // 2]), sum(c[at + size // 2:at + size])
            one = value >> (3 - bit) & 1
            seen.append((max(low(halves[one]) - less, 0), low(halves[1 - one])))
        gate = sum(sum(seen[-1]) >= x for x in m.KNOWN), sum(sum(seen[m.NEAR]) >= x for x in m.KNOWN_NEAR)
        return gate, np.array([math.log((a + m.SMOOTH) / (b + m.SMOOTH)) for a, b in seen])

    samples = collections.defaultdict(list)
    for t in learned:
        for _, _, parts in steps(t):
            for slots, value in parts:
                for bit in range(4):
                    gate, x = inputs(slots, value, bit, 1)
                    samples[gate].append(x)
    first = collections.defaultdict(lambda: np.full(k, m.WEIGHT))
    for gate, rows in samples.items():
        x, w = np.array(rows), np.full(k, m.WEIGHT)
        for _ in range(m.STEPS):
            miss = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))
            w = w + np.clip(np.linalg.solve(np.eye(k) * m.RIDGE + (x * (miss * (1 - miss))[:, None]).T @ x, miss @ x - m.RIDGE * (w - m.WEIGHT)), -0.5, 0.5)
        first[gate] = w

    result = []
    for t in scored:
        again = np.zeros((4, 1 + len(m.AGAIN)))
        again[:, 0] = 1
        todo, costs, run = [p for _, _, parts in steps(t) for p in parts], [], 0
        while todo:
            width = m.RUNS[min(run, len(m.RUNS) - 1)]
            rate, moves = m.RATE * (m.RUNS[0] / width) ** m.SLOWER, np.zeros_like(again)
            for slots, value in todo[:width]:
                cost = 0.0
                for bit in range(4):
                    gate, x = inputs(slots, value, bit, 0)
                    y = np.clip([first[gate] @ x, *[x[i] for i in m.AGAIN]], -30, 30)
                    p = 1 / (1 + math.exp(-again[bit] @ y))
                    cost -= math.log2(p)
                    moves[bit] += (1 - p) * y
                costs.append(cost)
            again, todo, run = again + rate * moves, todo[width:], run + 1
        total, at = 0.0, 0
        for previous, w, parts in steps(t):
            mix = 2 ** -sum(costs[at:at + len(parts)])
            at += len(parts)
            n = single[None if previous == b"\n" else previous]
            prior = m.PRIOR * math.sqrt(n + 1)
            total += math.log10((low(double[previous, w]) + prior * mix) / (n + prior))
        result.append(total)
    return result


def test_lm_scores_equal_the_plain_model(spark, documents):
    """Real texts, odd bytes and repeats."""
    rows = [(i, (t or "")[:600]) for i, t in sorted(documents.items())][:40] + [(900, "Zażółć\x00 gęślą\tJAŹŃ q"), (901, ""), (902, None), (907, "the the the " * 60)]
    texts = [(t or "").encode() for _, t in rows]
    learned = [t for (i, _), t in zip(rows, texts) if i % 3]
    want = dict(zip([i for i, _ in rows], plain_scores(learned, texts)))
    got = lm_mixing.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") % 3 != 0).collect()
    for r in got:
        assert r["score"] == pytest.approx(want[r["id"]], rel=1e-4), r["id"]


def test_language_query(spark):
    got = Q.QUERIES["op8_language_id"](spark, SF)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (crc(r["doc_id"]) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == r["lang"] for r in rows if r["held_out"] and r["lang"]]
    assert sum(held) / len(held) > 0.97


def test_language_matches_plain_bayes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").select("doc_id", "text", "lang")
    rows = docs.collect()
    total = {}
    n = collections.Counter()
    for r in rows:
        if crc(r["doc_id"]) % 3 != 1 and r["lang"]:
            n[r["lang"]] += 1
            for k in language_id.ORDERS:
                h = language_id.grams(language_id.code_points(r["text"]), k, language_id.BITS)
                total[r["lang"]] = total.get(r["lang"], 0) + np.bincount(h, minlength=1 << language_id.BITS)
    labels = sorted(n)
    log = {x: np.log(total[x] + language_id.SMOOTH) - np.log(total[x].sum() + language_id.SMOOTH * (1 << language_id.BITS)) for x in labels}
    for r in language_id.identify(docs, language_id.training_rows(docs)).collect():
        joint = [math.log((n[x] + 1) / (sum(n.values()) + len(labels))) + sum(
            log[x][language_id.grams(language_id.code_points(r["text"]), k, language_id.BITS)].sum() for k in language_id.ORDERS) for x in labels]
        assert r["lang_pred"] == labels[int(np.argmax(joint))]


def test_language_edge_cases(spark, edge_docs, empty_docs):
    training = language_id.training_rows(edge_docs)
    got = language_id.identify(edge_docs, training)
    assert set(got.columns) == set(edge_docs.columns)
    for r in got.collect():
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")), r["text"]
        assert r["score"] == 0 if r["lang_pred"] == "und" else 0 < r["score"] <= 1
    assert language_id.identify(empty_docs, training).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(edge_docs, training.limit(0)).collect()} == {"und"}


def check_packing(rows, got, window=packing.WINDOW):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    want = collections.Counter()
    for i, t in rows:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [packing.END_ID]
        for at in range(0, len(ids), window):
            part = np.array(ids[at:at + window], "<u4")
            want[i, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    of = collections.defaultdict(list)
    for r in got:
        of[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(of) == list(range(len(of)))
    for places in of.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= window
    return 1 - sum(r["length"] for r in got) / window / max(1, len(of))


def test_packing_query(spark, documents):
    padding = check_packing(list(documents.items()), Q.QUERIES["op10_packing"](spark, SF).collect())
    assert padding < 0.15


def test_packing_edge_cases(edge_docs, empty_docs):
    got = packing.pack_documents(edge_docs, packing.default_vocabulary()).collect()
    check_packing(KNOWN, got)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in got)
    assert packing.pack_documents(empty_docs, packing.default_vocabulary()).count() == 0


def test_packing_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 40)
    check_packing(list(documents.items()), packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet"), packing.default_vocabulary()).collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", " ", "  ", "\n", "\t", " \n", "'s", "1", "é", "　", "!", "<|endoftext|>", "ab", "\U0001f600", " "]), max_size=14))
def test_encoder_equals_its_library(found):
    text, e = "".join(found), packing.encoder(packing.default_vocabulary())
    assert e.encode(text).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_in_parts(monkeypatch):
    monkeypatch.setattr(packing, "PART", 50)
    rnd = random.Random(2)
    text = "".join(rnd.choice(["word", " ", " ", "  ", "\n", "Été", "12", "!?"]) for _ in range(3000))
    e = packing.encoder(packing.default_vocabulary())
    assert len(list(packing.parts(text))) > 20
    assert e.encode(text).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_placement_follows_the_sum_of_squares():
    """Each choice is the least of all, by trying them."""
    rnd = random.Random(0)
    lengths, window = [rnd.randint(1, 20) for _ in range(300)], 20
    seq, off = packing.place(np.array(lengths), window)
    fill = collections.Counter()
    for n, s, o in zip(lengths, seq.tolist(), off.tolist(), strict=True):
        level = collections.Counter(f for f in fill.values() if f < window)

        def after(h, n=n, level=level):
            new = level.copy()
            if h:
                new[h] -= 1
            if h + n < window:
                new[h + n] += 1
            return sum(v * v for v in new.values())
        assert fill[s] == o and after(o) == min(after(h) for h in [0, *[h for h, c in level.items() if c and h and h + n <= window]])
        fill[s] += n


def check_shards(rows, got, shards=sharding.SHARDS):
    assert collections.Counter((r["doc_id"], r["size"]) for r in got) == collections.Counter((i, len(t.encode()) + 1) for i, t in rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(0 <= s < shards for s in slots) and all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_query(spark, documents):
    got = Q.QUERIES["op9_sharding"](spark, SF).collect()
    check_shards(list(documents.items()), got)
    assert all(r["text_crc32"] == zlib.crc32(documents[r["doc_id"]].encode()) and r["law"] == "bytes" and r["grown_shard"] is None for r in got)
    shards = collections.defaultdict(set)
    for r in got:
        shards[documents[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in shards.values())


def test_sharding_balance_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 300)
    rnd = random.Random(3)
    rows = [(i, "x " * min(20000, int(rnd.paretovariate(1.1) * 40))) for i in range(6000)] + [(10_000 + i, "the same text " * 8) for i in range(900)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), columns=["doc_id"]).collect()
    check_shards(rows, got)
    sizes = collections.Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) / min(sizes.values()) < 1.06


def test_sharding_edge_cases(spark, edge_docs, empty_docs):
    got = sharding.shard_documents(edge_docs)
    assert {"row", "key", "part", "host"} <= set(got.columns)
    check_shards(KNOWN, got.collect())
    assert sharding.shard_documents(empty_docs).count() == 0
    half = spark.createDataFrame([(i, LONG[:1000] if i % 3 == 0 else f"text {i}") for i in range(3000)], "doc_id long, text string")
    out = sharding.shard_documents(half)  # one group holds most bytes: it alone is split
    check_shards([(r["doc_id"], r["text"]) for r in half.collect()], out.select("doc_id", "size", "shard", "slot").collect())
    sizes = [r[1] for r in out.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * min(sizes)


def test_oracles_of_the_sql_queries(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    cols = ["page_id", "host", "path", "rule", "verdict"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({Q.SQL['op5_url_filter']})").fetchall()
    assert bag(Q.QUERIES["op5_url_filter"](spark, SF), *cols) == collections.Counter(want)


def test_sharding_balances_tokens_and_rows_too(spark):
    """Many very short documents beside few very long ones: bytes come first,
    tokens and rows stay near."""
    rnd = random.Random(8)
    rows = [(i, f"w{i} " * rnd.randint(1, 4)) for i in range(8000)] + [(10_000 + i, f"long{i} words " * rnd.randint(1500, 3000)) for i in range(160)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), columns=["doc_id"]).collect()
    check_shards(rows, got)
    text = dict(rows)
    size, tokens, count = collections.Counter(), collections.Counter(), collections.Counter()
    for r in got:
        size[r["shard"]] += r["size"]
        tokens[r["shard"]] += len(text[r["doc_id"]].split())
        count[r["shard"]] += 1
    spread = [max(c.values()) / min(c.values()) for c in (size, tokens, count)]
    assert len(size) == 16 and spread[0] < 1.02 and spread[1] < 1.1 and spread[2] < 1.25, spread
