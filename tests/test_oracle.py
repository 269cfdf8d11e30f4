"""Every registered query against its DuckDB oracle (row multiset equality
after sorting columns by name), at sf0.001."""
import collections
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from keelson.plans.queries import QUERIES as CORE

import os

from conftest import SF_SMALL

SF = os.environ.get("KEELSON_ORACLE_SF", SF_SMALL)     # e.g. /root/testdata/sf0.01

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _duck_type(t):
    t = str(t)
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
            "DATE": "date", "TIMESTAMP": "timestamp_ntz"}.get(t, t)


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def test_every_query_has_an_oracle():
    missing = set(CORE) - set(E.oracle_sql())
    assert not missing, missing


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = collections.Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    oracle_types = {d[0]: _duck_type(d[1]) for d in rel.description}
    assert spark_types == oracle_types
    idx = {c: i for i, c in enumerate(ocols)}
    exp = collections.Counter(tuple(_norm(r[idx[c]]) for c in cols) for r in rel.fetchall())
    assert got == exp
