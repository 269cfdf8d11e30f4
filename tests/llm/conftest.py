import collections
import os

import pytest

SF = "/root/testdata/sf0.001"

#: Names that the operators use inside or return; as extra columns they must not matter.
CLASHING = ["id", "th", "row", "h", "norm", "key", "size", "shard", "slot", "part", "fp", "root", "words", "text_sha256", "keep_id", "kept",
            "component_id", "fingerprint", "lang_pred", "score", "n_hit", "block", "start", "length", "__id", "__th", "host", "path", "rule", "verdict", "n_chars2"]

LONG = "lorem ipsum dolor " * 20_000
ROWS = [
    (1, "Same text of Two rows", "en"), (2, "same text of two rows", "en"), (3, "", "fr"), (4, None, None), (None, "no id at all here", "en"), (None, None, None),
    (5, "   \t\n", "de"), (6, "12345 !!! ???", None), (7, LONG, "en"), (8, LONG + "x", "en"), (9, "repeated row", "es"), (9, "repeated row", "es"), (9, "other text same id", "es"),
    (10, "été où ça naïve", "fr"), (11, "\u0000odd\u0001 bytes", "en"), (12, "a", "en"), (13, "a b", "en"), (14, "a b c", "en"), (15, "same text of two rows", "en"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, lang, None, None, *["x"] * len(CLASHING)) for i, t, lang in ROWS], schema)


@pytest.fixture(scope="session")
def empty_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    df = spark.read.parquet(os.path.join(SF, "documents.parquet"))
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def bag(df, *cols):
    return collections.Counter(tuple(r[c] for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect())
