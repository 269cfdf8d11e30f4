"""Edge cases of the rollup operators on literal frames."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from keelson.operators import facts
from keelson.operators import rollups as R


def test_expand_schedule_days_and_overnight(spark):
    s = spark.createDataFrame([(1, "AB", "MON,WED", 23 * 60, 60), (2, "CD", "SUN", 8 * 60, 9 * 60)],
                              "schedule_id bigint, code string, days_of_week string, dep_minute int, arr_minute int")
    # 2025-01-06 is a Monday; window = the 7 days up to it (only past days kept)
    out = {r.flight_id: r for r in R.expand_schedule(s, "2025-01-06", 6, 3).collect()}
    assert sorted(out) == ["AB1010101", "AB1010106", "CD1020105"]
    mon = out["AB1010106"]
    assert mon.scheduled_departure == dt.datetime(2025, 1, 6, 23, 0)
    assert mon.scheduled_arrival == dt.datetime(2025, 1, 7, 1, 0)          # rolls to the next day


def test_apply_delays_defaults_to_zero(spark):
    f = spark.createDataFrame([(1, dt.date(2025, 1, 6), dt.datetime(2025, 1, 6, 8), dt.datetime(2025, 1, 6, 9)),
                               (2, dt.date(2025, 1, 6), dt.datetime(2025, 1, 6, 10), dt.datetime(2025, 1, 6, 11))],
                              "schedule_id bigint, flight_date date, scheduled_departure timestamp_ntz, scheduled_arrival timestamp_ntz")
    d = spark.createDataFrame([(1, dt.date(2025, 1, 6), 45)], "schedule_id bigint, flight_date date, delay_minutes int")
    got = {r.schedule_id: (r.delay_minutes, r.actual_departure) for r in R.apply_delays(f, d, ["schedule_id", "flight_date"]).collect()}
    assert got == {1: (45, dt.datetime(2025, 1, 6, 8, 45)), 2: (0, dt.datetime(2025, 1, 6, 10))}


def test_usage_due_cap_and_zero_interval(spark):
    usage = spark.createDataFrame([(1, 0, 10_000, 0), (2, 0, 100, 100), (3, 1, 0, 900)],
                                  "unit int, model_id int, hours bigint, cycles bigint")
    sched = spark.createDataFrame([(0, "A", 600, 400), (1, "B", 0, 400)],
                                  "model_id int, maintenance_type string, interval_flight_hours int, interval_flight_cycles int")
    got = sorted((r.unit, r.maintenance_type, r.occurrence) for r in R.usage_due(usage, sched, "model_id", "hours", "cycles", max_occurrences=5).collect())
    # unit 1: 16 by hours, capped at 5; unit 2: nothing due; unit 3: hours interval 0 ignored, 2 by cycles
    assert got == [(1, "A", i) for i in range(1, 6)] + [(3, "B", 1), (3, "B", 2)]
    whole = R.usage_due(usage, sched, "model_id", "hours", "cycles").collect()   # no cap unless asked for
    assert len(whole) == 18 and {r.times_due for r in whole if r.unit == 1} == {16}


def test_header_rollup_flags_mismatch_and_missing_lines(spark):
    lines = spark.createDataFrame([(1, Decimal("10.005")), (1, Decimal("5.00")), (2, Decimal("1.00"))], "k int, amt decimal(12,3)")
    heads = spark.createDataFrame([(1, 15.01), (2, 2.0), (3, 0.0)], "k int, total double")
    got = {r.k: (r.n_items, r.items_total, r.total_matches)
           for r in R.header_rollup(lines, heads, "k", "k", F.col("amt"), F.col("total")).collect()}
    assert got == {1: (2, Decimal("15.01"), True), 2: (1, Decimal("1.00"), False), 3: (0, Decimal("0.00"), True)}


def test_pick_one_is_deterministic(spark):
    df = spark.createDataFrame([(1, 30, "c"), (1, 10, "a"), (1, 20, "b"), (2, 5, "z")], "g int, o int, v string")
    a = sorted(tuple(r) for r in R.pick_one(df, "g", ["o"], ["o", "v"]).collect())
    b = sorted(tuple(r) for r in R.pick_one(df.repartition(3).orderBy(F.rand(3)), "g", ["o"], ["o", "v"]).collect())
    assert a == b == [(1, 10, "a"), (2, 5, "z")]


def test_ledger_balance_and_orphans(spark):
    led = spark.createDataFrame([(1, "EARN", Decimal("10.00")), (1, "REDEEM", Decimal("4.00")), (2, "GIFT", Decimal("3.00"))],
                                "acct int, t string, amt decimal(12,2)")
    got = {r.acct: (r.earned, r.redeemed, r.balance, r.n_transactions)
           for r in R.ledger_balance(led, "acct", "t", F.col("amt"), ["EARN"], ["REDEEM"]).collect()}
    assert got == {1: (Decimal("10.00"), Decimal("4.00"), Decimal("6.00"), 2), 2: (Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), 1)}
    parents = spark.createDataFrame([(1,)], "id int")
    assert [r.acct for r in facts.orphans(led, parents, "acct", "id").select("acct").distinct().collect()] == [2]
