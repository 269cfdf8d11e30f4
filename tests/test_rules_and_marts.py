"""Schema drift, cascades, period-end balances, lifecycles, mergeable
profiles, bucketed joins and the declared constraints."""
import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from keelson.operators import cdc, lifecycle
from keelson.operators import quality as Q
from keelson.operators import rollups as R
from keelson.plans import presets
from keelson.sinks import tables as sinks
from keelson.spec import TableSpec

from conftest import SF_SMALL


def bag(df, *cols):
    return collections.Counter(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_schema_drift_by_kind(spark):
    spec = TableSpec(name="t", key=("id",), after_ddl="id int, price decimal(10,2), day date, note string, flag boolean, gone int",
                     decimals={"price": (10, 2)}, temporal={"day": "days"}, keep_before=False)
    messages = ['{"payload":{"op":"c","after":{"id":1,"price":"AIA=","day":3,"note":"x","flag":true,"extra":{"a":1}}}}',
                '{"op":"u","after":{"id":"2","price":1.5,"day":"2024-01-01","note":null,"flag":1}}',
                '{"op":"u","after":{"id":3.5,"extra":[1]}}', '{"op":"d","after":null}', '{"half', "", None, "[]", '"text"']
    raw = spark.createDataFrame([(m,) for m in messages], "value string")
    got = bag(cdc.schema_drift(raw, spec), "table_name", "column_name", "issue", "observed", "n_rows")
    assert got == collections.Counter([
        ("t", "extra", "undeclared", "nested", 2), ("t", "id", "retyped", "string", 1), ("t", "id", "retyped", "number", 1), ("t", "price", "retyped", "number", 1),
        ("t", "day", "retyped", "string", 1), ("t", "flag", "retyped", "integer", 1), ("t", "gone", "vanished", None, 0)])
    assert {r["issue"] for r in cdc.schema_drift(raw.limit(0), spec).collect()} == {"vanished"}


def test_cascade_over_cycles_and_several_ways(spark):
    people = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 4), (5, 3), (6, None), (None, 1)], "id int, boss int")
    desks = spark.createDataFrame([("d1", 2, 9), ("d2", 6, 3), ("d3", 6, 6), ("d3", 5, 6)], "desk string, person int, backup int")
    tables = {"people": (people, "id"), "desks": (desks, "desk")}
    refs = [("people", "boss", "people"), ("desks", "person", "people"), ("desks", "backup", "people")]
    keys = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    got = bag(R.cascade(tables, refs, "people", keys), "table_name", "row_key", "level")
    assert got == collections.Counter([("people", "1", 0), ("people", "2", 1), ("people", "3", 2), ("people", "5", 3), ("desks", "d1", 2), ("desks", "d2", 3), ("desks", "d3", 4)])
    assert bag(R.cascade(tables, refs, "people", spark.createDataFrame([(4,)], "id int")), "row_key", "level") == {("4", 0): 1}
    assert R.cascade(tables, refs, "people", keys.limit(0)).count() == 0
    with pytest.raises(ValueError, match="did not end"):
        R.cascade(tables, refs, "people", keys, max_rounds=2)


@pytest.mark.parametrize("period", ["MONTH", "WEEK", "QUARTER"])
def test_period_ends_are_carried_forward(spark, period):
    rnd = random.Random(4)
    day = lambda n: datetime.date(2023, 11, 20) + datetime.timedelta(days=n)
    rows = [(rnd.choice(["a", "b", None]), day(rnd.randrange(300)), rnd.randint(-5, 9)) for _ in range(60)] + [("late", datetime.date(2025, 1, 1), 1), ("a", None, 7)]
    df = spark.createDataFrame(rows, "acc string, d date, x int")
    until = datetime.date(2024, 10, 15)

    def end(d):
        if period == "WEEK":
            return d + datetime.timedelta(days=6 - d.weekday())
        months = 1 if period == "MONTH" else 3
        m = (d.month - 1) // months * months + months
        return datetime.date(d.year + m // 12, m % 12 + 1, 1) - datetime.timedelta(days=1)
    want = collections.Counter()
    for acc in {r[0] for r in rows}:
        mine = [(d, x) for a, d, x in rows if a == acc and d is not None]
        e = end(min(d for d, _ in mine))
        while e <= end(until):
            want[acc, e, sum(x for d, x in mine if d <= e)] += 1
            e = end(e + datetime.timedelta(days=1))
    got = R.period_end_balance(df, "acc", "d", F.col("x"), F.lit(until.isoformat()), period)
    assert bag(got, "acc", "period_end", "balance") == want


def test_lifecycle_of_a_hot_entity(spark):
    legal = [(None, "new"), ("new", "open"), ("open", "open"), ("open", "done"), ("done", "new")]
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot"] * 8 + ["a", "b", None]), i, rnd.choice(["new", "open", "done", "lost", None])) for i in range(1500)]
    want, state = collections.Counter(), {}
    for k, i, s in rows:
        ok = (state.get(k), s) in legal
        state[k] = s if ok else state.get(k)
        want[k, i, ok, state[k]] += 1
    got = lifecycle.walk(spark.createDataFrame(rows, "k string, i int, s string"), "k", ["i"], "s", legal, num_partitions=7)
    assert bag(got, "k", "i", "is_legal", "state") == want
    s = {r["k"]: r for r in lifecycle.summary(got, "k", ["i"], "i").collect()}
    assert s["hot"]["first_illegal"] == min(i for (k, i, ok, _) in want if k == "hot" and not ok) and s["hot"]["final_state"] == state["hot"]
    assert lifecycle.walk(got.select("k", "i", "s").limit(0), "k", ["i"], "s", legal).count() == 0


def test_profiles_merge_within_their_error(spark):
    df = spark.range(60_000).selectExpr("date_add(date'2024-01-01', cast(id % 9 as int)) as d", "id % 20000 as n", "if(id % 4 = 0, null, cast(id as string)) as s", "id * 1.5 as x")
    days = Q.profile_by_day(df, F.col("d"), ["n", "s", "x"])
    assert days.count() == 27
    got = {r["column_name"]: r for r in Q.merge_profiles(days).collect()}
    assert (got["s"]["n_rows"], got["s"]["n_nulls"], got["s"]["q50"]) == (60_000, 15_000, None)
    for c, exact in (("n", 20_000), ("s", 45_000), ("x", 60_000)):
        assert abs(got[c]["n_distinct"] - exact) < 0.04 * exact
    assert abs(got["x"]["q50"] - 45_000) < 0.03 * 90_000 and abs(got["x"]["q90"] - 81_000) < 0.03 * 90_000
    half = {r["column_name"]: r for r in Q.merge_profiles(days.where("d < date'2024-01-05'")).collect()}
    assert half["n"]["n_rows"] == df.where("d < date'2024-01-05'").count()


def test_bucketed_join_has_no_exchange(spark):
    p = E.queries()["fact_bucketed_join"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in p and "Exchange" not in p
    assert [sinks.buckets_for(n) for n in (0, 40_000_000, 40_000_001, 10 ** 13)] == [8, 8, 16, 65_536]


def test_constraints_of_all_captured_tables():
    assert set(presets.DQ_TESTS) == set(presets.ALL_CAPTURED) and len(presets.DQ_TESTS) == 18
    for name, tests in presets.DQ_TESTS.items():
        spec = presets.ALL_CAPTURED[name]
        used = [*tests.get("unique", []), *tests.get("not_null", []), *tests.get("accepted", {}), *tests.get("relationships", {})]
        # a constraint on a column that the row image does not carry can't be checked
        assert set(used) <= set(spec.row_fields), name
        assert set(spec.key) <= set(tests["unique"])
    assert ("refunds", "payment_id", "payments") in presets.references()


def test_cascade_along_the_declared_references(spark):
    """One call: booking -> items -> tickets, payments -> refunds, cancellations."""
    rows = {"bookings": "booking_id int", "booking_items": "booking_item_id int, booking_id int", "tickets": "ticket_id int, booking_item_id int",
            "payments": "payment_id int, booking_id int", "refunds": "refund_id int, payment_id int", "booking_cancellations": "cancellation_id int, booking_id int"}
    data = {"bookings": [(1,), (2,)], "booking_items": [(10, 1), (11, 1), (12, 2)], "tickets": [(100, 10), (101, 12)], "payments": [(20, 1), (21, 2)],
            "refunds": [(200, 20), (201, 21)], "booking_cancellations": [(300, 1)]}
    tables = {n: (spark.createDataFrame(data[n], ddl), ddl.split()[0]) for n, ddl in rows.items()}
    refs = [r for r in presets.references() if r[0] in tables and r[2] in tables]
    got = bag(R.cascade(tables, refs, "bookings", tables["bookings"][0].where("booking_id = 1")), "table_name", "row_key")
    assert got == collections.Counter([("bookings", "1"), ("booking_items", "10"), ("booking_items", "11"), ("tickets", "100"), ("payments", "20"), ("refunds", "200"), ("booking_cancellations", "300")])
