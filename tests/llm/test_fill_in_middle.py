"""Fill-in-the-middle texts against a plain version, chunk by chunk and whole."""
import hashlib
import random

import pytest

from keelson.llm import fill_in_middle as M
from keelson.llm import queries as Q

from .conftest import SF, bag

MARKED = ["a <P> b", "<S>", "x<M>", "<P", "<P <S <M", "<" * 50, "<<P>>", "ab<" + "P>" * 3]
TEXTS = ["", "a", "é", "日本語テキスト", "😀" * 400, "<P" * 5000 + ">", "abc " * 30_000, "x" * 20_000 + "<M>" + "y" * 20_000, *MARKED]


def plain_version(doc_id, text):
    t = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k: 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
    if not t or any(m in t for m in M.MARKS) or h3 % 100 >= 90:
        return len(t), "plain", None, None, t
    if h4 % 100 < 20:
        return len(t), "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    return len(t), "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"


def samples(seed, k=200):
    rnd = random.Random(seed)
    alphabet = "ab é日😀<PSM>\n"
    passages = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 900))) for _ in range(6)]
    return ["".join(rnd.choice(passages) for _ in range(rnd.randint(0, 8))) for _ in range(k)] + TEXTS


@pytest.mark.parametrize("seed", [0, 1])
def test_chunks_add_up(seed):
    cache = M.Chunks()
    rnd = random.Random(seed)
    for t in samples(seed):
        raw = t.encode()
        got = M.Measured(raw, cache)
        assert got.ends == sorted(set(got.ends)) and (not raw or got.ends[-1] == len(raw))
        assert all(b - a <= M.LONGEST for a, b in zip([0, *got.ends], got.ends))
        assert got.n == len(t) and got.marked == any(m in t for m in M.MARKS)
        for k in [0, 1, len(t) // 2, len(t), *(rnd.randint(0, len(t)) for _ in range(5))]:
            assert got.byte_of(k) == len(t[:k].encode())
    assert cache.found > cache.asked / 5     # passages are shared


def test_boundaries_follow_the_content():
    rnd = random.Random(3)
    shared = bytes(rnd.randrange(32, 127) for _ in range(40_000))
    one, two = M.boundaries(b"head" * 100 + shared), M.boundaries(b"another beginning" + shared)
    at = lambda ends, skip: {e - skip for e in ends if e > skip + M.LONGEST}
    assert at(one, 400) == at(two, 17) and len(at(one, 400)) > 30


def test_a_full_cache_changes_nothing():
    small, large = M.Chunks(most=3000), M.Chunks()
    for t in samples(5, 60):
        a, b = M.Measured(t.encode(), small), M.Measured(t.encode(), large)
        assert (a.n, a.marked, a.upto) == (b.n, b.marked, b.upto) and small.held <= 3000 + M.LONGEST


def test_edge_cases(spark, edge_docs, empty_docs):
    rows = [(i, t) for i, t in enumerate(samples(7, 40))] + [(None, "no id"), (None, None), (5, None), (5, "again"), (5, "again"), (-12, "negative id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = M.fill_in_middle(docs)
    want = sorted([(i, *plain_version(i, t)) for i, t in rows], key=repr)
    cols = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert sorted([tuple(r[c] for c in cols) for r in got.collect()], key=repr) == want
    back = got.select("text", M.restored(got["output"], got["form"]).alias("back"))
    assert all((r["text"] or "") == r["back"] for r in back.collect())
    for r in got.collect():
        assert M.rebuilt(r["output"].encode(), r["form"]).decode() == (r["text"] or "")
    edge = M.fill_in_middle(edge_docs)
    assert edge.columns == [*edge_docs.columns, *cols[1:]]
    assert bag(edge, "doc_id", "text") == bag(edge_docs, "doc_id", "text") and bag(edge, "norm", "row") == bag(edge_docs, "norm", "row")
    assert M.fill_in_middle(empty_docs).count() == 0


def test_shares_are_parameters(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "'some text' as text")
    none = bag(M.fill_in_middle(docs, plain_percent=0, spm_percent=0), "form")
    assert none == {("psm",): 2000}
    half = bag(M.fill_in_middle(docs, plain_percent=50, spm_percent=100, salt="2:"), "form")
    assert set(half) == {("plain",), ("spm",)} and 850 < half["plain",] < 1150


def test_query_equals_plain_version(spark, documents):
    got = {r["doc_id"]: r for r in Q.QUERIES["op11_fill_in_middle"](spark, SF).collect()}
    assert len(got) == len(documents)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    for i, t in documents.items():
        n, form, a, b, out = plain_version(i, t)
        r = got[i]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output_sha256"], r["restored_sha256"]) == (n, form, a, b, sha(out), sha(t))
