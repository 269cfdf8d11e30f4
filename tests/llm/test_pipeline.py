"""The pipeline against a plain version of each stage, on whole tables."""
import collections

import __spark_entry__ as entry
import corpus_pipeline
from keelson.llm import queries as Q
from keelson.llm.common import stored

from .conftest import SF
from .test_dedup import brute_components, brute_contamination, brute_fingerprint, low
from .test_models import check_packing


def keep(rows, items):
    """Ids that each filtering stage keeps of distinct (id, text) rows."""
    rows = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    yield {i for i, _ in rows}
    last = {}
    for i, t in rows:
        last[low(t)] = max(i, last.get(low(t), i))
    rows = [(i, t) for i, t in rows if last[low(t)] == i]
    yield {i for i, _ in rows}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    root = brute_components(set(fps.values()))
    least = {}
    for i, _ in rows:
        least[root[fps[i]]] = min(i, least.get(root[fps[i]], i))
    rows = [(i, t) for i, t in rows if least[root[fps[i]]] == i]
    yield {i for i, _ in rows}
    bad = {r[0] for r in brute_contamination(rows, items) if r[-1]}
    yield {i for i, _ in rows if i not in bad}


def test_stages(spark, documents):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = docs
    for (_, stage), want in zip(corpus_pipeline.STAGES[:-1], keep(list(documents.items()), items), strict=True):
        docs = stored(spark, stage(spark, docs, SF), "stage")
        assert docs.columns == whole.columns and docs.dtypes == whole.dtypes
        got = docs.collect()
        assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(want)
        assert all(documents[r["doc_id"]] == r["text"] for r in got)
    ids = [(i, documents[i]) for i in want]
    check_packing(ids, corpus_pipeline.run(spark, SF).collect())


def test_stages_on_edge_cases(spark, edge_docs, empty_docs):
    for docs in (edge_docs, empty_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(spark, stage(spark, docs, SF), "stage")
            assert docs.columns == edge_docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).where("start = 0").count() == docs.count()


def test_registered():
    assert {n for n in entry.queries() if n.startswith("op")} == set(Q.QUERIES) and len(Q.QUERIES) == 13
    assert "pipeline" in entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "decontamination", "packing"]
