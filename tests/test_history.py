"""Point-in-time lookups, incremental type-2 history, refusing ledgers and
tables that are replaced while read."""
import collections
import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from keelson.operators import dims, facts
from keelson.operators import ledger as L
from keelson.session import scratch_path
from keelson.sinks import versioned


def bag(df, *cols):
    return collections.Counter(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


# ------------------------------------------------------ versions valid ----

def valid_version(versions, key, t):
    fits = [v for v in versions if key is not None and t is not None and v[0] == key and v[1] <= t and (v[2] is None or t < v[2])]
    return max(fits, key=lambda v: (v[1], v[2] is None, v[2] or 0))[3] if fits else None


def test_lookup_version_edges(spark):
    versions = [(1, 10, 20, "a"), (1, 20, 20, "empty"), (1, 20, 35, "b"), (1, 50, None, "after a gap"), (2, -5, None, "negative"), (None, 0, None, "no key"), (3, 7, None, "c")]
    times = [None, -6, -5, 9, 10, 19, 20, 34, 35, 49, 50, 10_000]
    rows = [(i, k, t) for i, (k, t) in enumerate(itertools.product([1, 2, 3, 4, None], times))]
    rows += rows[:5]
    fact = spark.createDataFrame(rows, "id int, key int, t long").withColumn("__v", F.lit("clash")).withColumn("label", F.lit("own")).drop("label")
    v = spark.createDataFrame(versions, "k int, valid_from long, valid_to long, label string")
    want = collections.Counter((i, k, t, valid_version(versions, k, t)) for i, k, t in rows)
    for width in (1, 7, 1000):
        got = facts.lookup_version(fact, v, "key", "t", "k", ["label"], width=width)
        assert got.columns == ["id", "key", "t", "__v", "label"] and bag(got, "id", "key", "t", "label") == want
    assert facts.lookup_version(fact.limit(0), v, "key", "t", "k", ["label"]).count() == 0
    none = facts.lookup_version(fact, v.limit(0), "key", "t", "k", ["label"])
    assert none.count() == len(rows) and none.where("label is not null").count() == 0


def test_lookup_version_plan_has_no_range_join(spark):
    import __spark_entry__ as E
    p = E.queries()["fact_as_of_version"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p and "Cartesian" not in p


# -------------------------------------------------- history, by loads ----

def test_merged_history_equals_the_rebuild_in_any_order(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(12), rnd.randrange(25), i, rnd.choice(["a", "b", None]), rnd.random() < 0.15) for i in range(160)]
    schema = "k int, ts long, lsn int, status string, del boolean"
    cols = ["k", "status", "lsn", "valid_from", "valid_to", "is_current"]
    v = spark.createDataFrame(rows, schema)
    want = bag(dims.scd2(v, ["k"], "ts", ["status"], tie=["lsn"], deleted=F.col("del")), *cols)
    loads = [rows[0:60], rows[60:100], rows[100:]]
    for order in ((2, 0, 1), (1, 2, 0)):
        root = scratch_path(spark, "history")
        for i in order:
            # each load repeats a part of another one
            dims.scd2_merge(spark, root, spark.createDataFrame(loads[i] + loads[order[0]][:10], schema), ["k"], "ts", ["status"], ["lsn"], F.col("del"), buckets=4)
        assert bag(dims.scd2_read(spark, root, "ts"), *cols) == want


def test_only_touched_buckets_move(spark):
    root = scratch_path(spark, "history")
    rows = [(k, 1, 0, "a") for k in range(40)]
    make = lambda r: spark.createDataFrame(r, "k int, ts long, lsn int, status string")
    assert dims.scd2_merge(spark, root, make(rows), ["k"], "ts", ["status"], ["lsn"], buckets=8) == list(range(8))
    before = versioned.pointer(spark, root)
    touched = dims.scd2_merge(spark, root, make([(3, 5, 1, "b")]), ["k"], "ts", ["status"], ["lsn"], buckets=99)
    after = versioned.pointer(spark, root)
    assert len(touched) == 1 and after["buckets"] == "8"
    assert {b for b in before if before[b] != after[b]} == {str(touched[0])}
    assert dims.scd2_merge(spark, root, make([]), ["k"], "ts", ["status"], ["lsn"]) == [] and versioned.pointer(spark, root) == after


# ---------------------------------------------------- refusing ledger ----

def plain_ledger(rows):
    balance, out = collections.Counter(), collections.Counter()
    for account, i, x in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        x = round(x * 100) if x is not None else 0
        ok = x >= 0 or balance[account] + x >= 0
        balance[account] += x if ok else 0
        out[account, i, ok, Decimal(balance[account]) / 100] += 1
    return out


def ledger_rows(seed, hot=1200):
    rnd = random.Random(seed)
    names = ["hot"] * hot + [rnd.choice(["a", "b", "c", "d", None]) for _ in range(300)]
    return [(n, i, rnd.choice([None, 0.0, 0.01, 5.25, 20.0, -3.1, -0.01, -12.5, -40.0])) for i, n in enumerate(names)]


@pytest.mark.parametrize("most", [L.MOST_PIECES, 2])
def test_settle_equals_one_pass(spark, monkeypatch, most):
    """A hot account over many slices; with two pieces at most, by the streaming way."""
    monkeypatch.setattr(L, "MOST_PIECES", most)
    rows = ledger_rows(1)
    df = spark.createDataFrame(rows, "acc string, i int, x double").withColumn("row", F.lit("clash")).withColumn("slice", F.lit("clash"))
    got = L.settle(df, "acc", ["i"], F.col("x"), num_partitions=9)
    assert got.columns == ["acc", "i", "x", "row", "slice", "accepted", "balance"]
    assert bag(got, "acc", "i", "accepted", "balance") == plain_ledger(rows)
    assert L.settle(df.limit(0), "acc", ["i"], F.col("x")).count() == 0


def test_stretches_compose():
    rnd = random.Random(3)
    for _ in range(50):
        amounts = [rnd.randint(-30, 25) for _ in range(40)]
        f = L.Stretch()
        for x in amounts:
            f.apply(x)
        for start in [0, 1, 7, 30, 100, 10_000, *(rnd.randint(0, 200) for _ in range(20))]:
            b = start
            for x in amounts:
                b += x if x >= 0 or b + x >= 0 else 0
            assert f.after(start) == b


# ------------------------------------------------------ atomic replace ----

def test_a_write_that_dies_leaves_the_old_table(spark):
    root = scratch_path(spark, "table")
    with pytest.raises(ValueError, match="no table"):
        versioned.read(spark, root)
    versioned.replace(spark.range(10), root)
    dying = spark.range(1000, numPartitions=4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("dies"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="dies"):
        versioned.replace(dying, root)
    assert versioned.read(spark, root).count() == 10
    reader = versioned.read(spark, root)          # resolved before the next switch
    versioned.replace(spark.range(3), root)
    assert reader.count() == 10 and versioned.read(spark, root).count() == 3
    assert len(versioned.expire(spark, root)) == 2 and versioned.read(spark, root).count() == 3


def test_tables_under_one_pointer_change_together(spark, monkeypatch):
    root = scratch_path(spark, "both")
    versioned.replace_all({"silver": spark.range(5), "quarantine": spark.range(2)}, root)
    monkeypatch.setattr(versioned, "write_pointer", lambda *a: (_ for _ in ()).throw(OSError("killed before the switch")))
    with pytest.raises(OSError, match="killed"):
        versioned.replace_all({"silver": spark.range(50), "quarantine": spark.range(20)}, root)
    assert [versioned.read(spark, root, t).count() for t in ("silver", "quarantine")] == [5, 2]
