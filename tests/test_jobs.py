"""The source project's jobs on literal change messages shaped like its
captured tables (versions, a delete, NULL status, base64 decimal hours)."""
import json
from decimal import Decimal

from pyspark.sql import functions as F

from keelson.operators import cdc
from keelson.plans import jobs as J
from keelson.plans import presets as P
from keelson.session import scratch_path


def _msgs(spark, rows):
    def env(op, after, before, ts, lsn):
        return json.dumps({"payload": {"before": before, "after": after, "op": op, "ts_ms": ts,
                                       "source": {"ts_ms": ts, "snapshot": "false", "txId": lsn, "lsn": lsn}}})
    data = [(env(*r),) for r in rows]
    return spark.createDataFrame(data, "value string").withColumn("timestamp", F.current_timestamp())


def test_bookings_silver(spark):
    b = lambda i, s, ref: {"booking_id": i, "customer_id": 10 + i, "booking_reference": ref,
                           "booking_status": s, "booking_channel": "WEB", "currency": "USD"}
    raw = _msgs(spark, [
        ("r", b(1, "PENDING", "R1"), None, 100, 1),
        ("u", b(1, "CONFIRMED", "R1"), b(1, "PENDING", "R1"), 200, 2),   # latest version wins
        ("r", b(2, None, "R2"), None, 100, 3),                            # NULL status -> quarantine
        ("r", b(3, "PENDING", None), None, 100, 4),                       # missing reference
        ("r", b(4, "PENDING", "R4"), None, 100, 5),
        ("d", None, b(4, "PENDING", "R4"), 300, 6),                       # deleted
        ("r", b(5, "BOGUS", None), None, 100, 7),                         # both fail: first reason
    ])
    bronze = cdc.parse_changes(raw, P.BOOKINGS)
    silver, quarantine = J.silver(bronze, P.BOOKINGS, as_of="2026-01-01 00:00:00")
    s = {r.booking_id: r.booking_status for r in silver.collect()}
    q = {r.booking_id: (r.quarantine_reason, r.failed_rules) for r in quarantine.collect()}
    assert s == {1: "CONFIRMED"}
    assert q == {2: (P.REASON_BOOKING_STATUS, "has_valid_status"),
                 3: (P.REASON_BOOKING_REFERENCE, "has_valid_reference"),
                 5: (P.REASON_BOOKING_STATUS, "has_valid_status,has_valid_reference")}
    assert silver.columns[-2:] == ["source_ts_ms", "_silver_processed_at"]


def test_aircraft_decimal_hours_and_grounding(spark):
    a = lambda reg, hrs, g, why: {"aircraft_registration": reg, "model_id": 1, "total_flight_hours": hrs,
                                  "total_flight_cycles": 5, "is_grounded": g, "grounded_reason": why}
    raw = _msgs(spark, [("r", a("XX-A", "EDMz", False, None), None, 1, 1),   # 10616.83
                        ("r", a("XX-B", "/w==", False, None), None, 1, 2),   # -0.01 -> quarantine
                        ("r", a("XX-C", "AA==", True, None), None, 1, 3),    # grounded without reason
                        ("r", a("XX-D", None, None, None), None, 1, 4)])     # NULL grounded -> quarantine
    silver, quarantine = J.silver(cdc.parse_changes(raw, P.AIRCRAFT), P.AIRCRAFT)
    assert {r.aircraft_registration: r.total_flight_hours for r in silver.collect()} == {"XX-A": Decimal("10616.83")}
    assert {r.aircraft_registration: r.quarantine_reason for r in quarantine.collect()} == {
        "XX-B": P.REASON_HOURS, "XX-C": P.REASON_GROUNDING, "XX-D": P.REASON_GROUNDING}


def test_loyalty_ledger_keeps_every_transaction(spark):
    t = lambda i, typ, m: {"transaction_id": i, "loyalty_account_id": 1, "transaction_type": typ,
                           "miles_amount": m, "reference_type": "BOOKING"}
    raw = _msgs(spark, [("c", t(1, "EARN", 500), None, 1, 1), ("c", t(2, "REDEEM", 0), None, 2, 2),
                        ("c", t(3, "GIFT", 10), None, 3, 3)])
    silver, quarantine = J.silver(cdc.parse_changes(raw, P.LOYALTY_TRANSACTIONS), P.LOYALTY_TRANSACTIONS)
    assert [r.transaction_id for r in silver.collect()] == [1]
    assert {r.transaction_id: r.quarantine_reason for r in quarantine.collect()} == {
        2: P.REASON_MILES, 3: P.REASON_TRANSACTION_TYPE}
    assert J.build_fact_loyalty_transactions(silver).count() == 1


def test_gold_star(spark):
    tables = {
        "airports": spark.createDataFrame([("AAA", "Alpha Intl", "Alpha City", "AA", "UTC"),
                                           ("BBB", "Beta Field", "Beta Town", "AA", "UTC")],
                                          "airport_code string, airport_name string, city string, country string, timezone string"),
        "customers": spark.createDataFrame([(11, "A", "B", "a@x", "AA", None)],
                                           "customer_id int, first_name string, last_name string, email string, nationality string, date_of_birth date"),
        "fare_classes": spark.createDataFrame([(1, "Y", "Economy"), (2, "J", "Business")],
                                              "fare_class_id int, class_code string, class_name string"),
        "fare_rules": spark.createDataFrame([(1, 1, False, Decimal("2000.00"), 23), (2, 1, True, Decimal("0.00"), 40),
                                             (3, 2, False, Decimal("5000.00"), 32)],
                                            "fare_rule_id int, fare_class_id int, refundable boolean, change_fee decimal(10,2), baggage_allowance_kg int"),
        "aircraft_models": spark.createDataFrame([(1, "E190", "Embraer", 100)],
                                                 "model_id int, model_name string, manufacturer string, seat_capacity int"),
        "silver_aircraft": spark.createDataFrame([("XX-A", 1, Decimal("10.00"), 5, False, None)],
                                                 "aircraft_registration string, model_id int, total_flight_hours decimal(10,2), total_flight_cycles int, is_grounded boolean, grounded_reason string"),
        "silver_bookings": spark.createDataFrame([(1, 11, "R1", "CONFIRMED", "WEB", "USD", 5), (2, 99, "R2", "PENDING", "WEB", "USD", 6)],
                                                 "booking_id int, customer_id int, booking_reference string, booking_status string, booking_channel string, currency string, source_ts_ms bigint"),
        "silver_flights": spark.createDataFrame([("F1", 1, "AAA", "BBB", "ARRIVED", "XX-A", 5), ("F2", 1, "BBB", "XXX", "DELAYED", "XX-Z", 6)],
                                                "flight_id string, schedule_id int, origin_airport string, destination_airport string, flight_status string, aircraft_registration string, source_ts_ms bigint"),
        "silver_loyalty_transactions": spark.createDataFrame([(1, 1, "EARN", 500, 5)],
                                                             "transaction_id int, loyalty_account_id int, transaction_type string, miles_amount int, source_ts_ms bigint"),
    }
    base = scratch_path(spark, "gold")
    written = {}

    def read(name):
        return written[name] if name in written else tables[name]

    def write(name, df):
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        written[name] = spark.read.parquet(f"{base}/{name}")

    J.run_gold(spark, read, write)
    assert written["dim_date"].count() == 730
    assert sorted((r.airport_code, r.airport_key) for r in written["dim_airport"].collect()) == [("AAA", 0), ("BBB", 1)]
    fc = {r.fare_class_id: (r.refundable, r.fare_class_key) for r in written["dim_fare_class"].collect()}
    assert fc == {1: (False, 0), 2: (False, 1)}           # one rule per class, no fan-out
    fb = {r.booking_id: r.customer_key for r in written["fact_bookings"].collect()}
    assert fb == {1: 0, 2: None}
    ff = {r.flight_id: (r.origin_airport_key, r.destination_airport_key, r.aircraft_matched, r.aircraft_model)
          for r in written["fact_flight_operations"].collect()}
    assert ff == {"F1": (0, 1, True, "E190"), "F2": (1, None, False, None)}
    assert written["dim_aircraft"].first().model_name == "E190"
    # a later run with a lower code: first keys stay
    tables["airports"] = tables["airports"].unionByName(tables["airports"].limit(1).withColumn("airport_code", F.lit("AA0")))
    J.run_gold(spark, read, write, previous=lambda name: written.get(name))
    assert sorted((r.airport_code, r.airport_key) for r in written["dim_airport"].collect()) == [("AA0", 2), ("AAA", 0), ("BBB", 1)]


def test_cli_silver(spark, tmp_path_factory):
    from keelson.__main__ import main
    from keelson.sinks import tables as sinks
    b = lambda i, s: {"booking_id": i, "customer_id": 1, "booking_reference": "R", "booking_status": s,
                      "booking_channel": "WEB", "currency": "USD"}
    bronze = cdc.parse_changes(_msgs(spark, [("r", b(1, "PENDING"), None, 1, 1), ("r", b(2, "NOPE"), None, 1, 2)]),
                               P.BOOKINGS)
    base = scratch_path(spark, "cli")
    sinks.overwrite(bronze, f"{base}/bronze")
    # the CLI reuses the active session (getOrCreate) and must not stop it here
    import keelson.__main__ as M
    stop = type(spark).stop
    try:
        type(spark).stop = lambda self: None
        assert main(["silver", "--table", "bookings", "--bronze", f"{base}/bronze", "--out", base]) == 0
    finally:
        type(spark).stop = stop
    assert sinks.read(spark, f"{base}/silver_bookings").count() == 1
    assert sinks.read(spark, f"{base}/silver_quarantine_bookings").count() == 1


def test_versions_kept_without_log_position(spark):
    """Flights / aircraft / loyalty changes carry no log position: repeated
    deliveries still collapse, distinct versions stay."""
    def env(status, ts):
        return json.dumps({"payload": {"after": {"flight_id": "F1", "schedule_id": 1, "origin_airport": "AAA",
                                                 "destination_airport": "BBB", "flight_status": status},
                                       "source": {"ts_ms": ts, "snapshot": "false", "txId": ts}, "op": "u"}})
    raw = spark.createDataFrame([(env("SCHEDULED", 1),), (env("SCHEDULED", 1),), (env("BOARDING", 2),)],
                                "value string").withColumn("timestamp", F.current_timestamp())
    ch = cdc.dedupe_changes(cdc.parse_changes(raw, P.FLIGHTS), P.FLIGHTS)
    assert sorted(r.flight_status for r in ch.collect()) == ["BOARDING", "SCHEDULED"]
    assert cdc.current_state(ch, P.FLIGHTS).first().flight_status == "BOARDING"


def test_aircraft_history_scd2(spark):
    a = lambda hrs, g, why: {"aircraft_registration": "XX-A", "model_id": 1, "total_flight_hours": hrs,
                             "total_flight_cycles": 5, "is_grounded": g, "grounded_reason": why}
    raw = _msgs(spark, [("r", a("AA==", False, None), None, 1, 1),
                        ("u", a("AA==", False, None), None, 2, 2),           # no attribute change
                        ("u", a("AA==", True, "bird strike"), None, 3, 3),
                        ("u", a("AA==", False, None), None, 4, 4)])
    h = J.build_dim_aircraft_history(cdc.parse_changes(raw, P.AIRCRAFT), P.AIRCRAFT)
    rows = sorted((r.valid_from, r.valid_to, r.is_grounded, r.is_current) for r in h.collect())
    assert rows == [(1, 3, False, False), (3, 4, True, False), (4, None, False, True)]


def test_incremental_silver_equals_full_rebuild(spark):
    from keelson.plans import fixtures as fx
    from keelson.plans.queries import UPSERT_CUTOFF
    from keelson.streaming import ingest, runner
    sf = "/root/testdata/sf0.001"
    msgs = fx.cdc_raw(spark, sf)
    cut = F.col("timestamp") < F.lit(UPSERT_CUTOFF).cast("timestamp")
    landing, bronze_path, ck = scratch_path(spark, "l"), scratch_path(spark, "bronze"), scratch_path(spark, "ck")
    state, silver = scratch_path(spark, "state"), scratch_path(spark, "silver")

    fact = scratch_path(spark, "fact")

    def build(s, carry=()):
        return s.select("entity_id", "status", "amount_dec", "source_ts_ms", *carry)

    def ingest_and_refine(since):
        raw = ingest.file_source(spark, f"{landing}/*", "value string, timestamp timestamp, lsn bigint, copy int")
        runner.run_to_end(J.bronze_query(raw, fx.EVENTS_SPEC, bronze_path, ck))
        b = spark.read.parquet(bronze_path)
        if since:
            b = b.filter(F.col("ingest_date") >= F.lit(since).cast("date"))     # partition pruning
        touched = J.silver_incremental(spark, b, fx.EVENTS_SPEC, state, silver, buckets=8)
        J.fact_incremental(spark, silver, touched, build, fact)
        return touched

    msgs.filter(cut).write.parquet(f"{landing}/a")
    ingest_and_refine(None)
    msgs.filter(~cut).write.parquet(f"{landing}/b")
    ingest_and_refine(UPSERT_CUTOFF[:10])
    full_valid, full_q = J.silver(cdc.parse_changes(msgs, fx.EVENTS_SPEC).drop("_before", "_no_before"), fx.EVENTS_SPEC)
    got_v = J.read_silver(spark, silver, fx.EVENTS_SPEC).select("entity_id", "source_ts_ms")
    got_q = J.read_quarantine(spark, silver).select("entity_id", "source_ts_ms")
    got_f = J.read_fact(spark, fact).select("entity_id", "source_ts_ms")
    for got, full in ((got_v, full_valid.select("entity_id", "source_ts_ms")), (got_q, full_q.select("entity_id", "source_ts_ms")),
                      (got_f, full_valid.select("entity_id", "source_ts_ms"))):
        assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_cli_gold(spark):
    from keelson.__main__ import main
    from keelson.sinks import tables as sinks
    tables = scratch_path(spark, "ref")
    out = scratch_path(spark, "gold")
    frames = {
        "airports": spark.createDataFrame([("AAA", "A", "A", "AA", "UTC")], "airport_code string, airport_name string, city string, country string, timezone string"),
        "customers": spark.createDataFrame([(11, "A", "B", "a@x", "AA", None)], "customer_id int, first_name string, last_name string, email string, nationality string, date_of_birth date"),
        "fare_classes": spark.createDataFrame([(1, "Y", "Economy")], "fare_class_id int, class_code string, class_name string"),
        "fare_rules": spark.createDataFrame([(1, 1, False, Decimal("2000.00"), 23)], "fare_rule_id int, fare_class_id int, refundable boolean, change_fee decimal(10,2), baggage_allowance_kg int"),
        "aircraft_models": spark.createDataFrame([(1, "E190", "Embraer", 100)], "model_id int, model_name string, manufacturer string, seat_capacity int"),
        "silver_aircraft": spark.createDataFrame([("XX-A", 1, Decimal("1.00"), 5, False, None)], "aircraft_registration string, model_id int, total_flight_hours decimal(10,2), total_flight_cycles int, is_grounded boolean, grounded_reason string"),
        "silver_bookings": spark.createDataFrame([(1, 11, "R1", "CONFIRMED", "WEB", "USD", 5)], "booking_id int, customer_id int, booking_reference string, booking_status string, booking_channel string, currency string, source_ts_ms bigint"),
        "silver_flights": spark.createDataFrame([("F1", 1, "AAA", "AAA", "ARRIVED", "XX-A", 5)], "flight_id string, schedule_id int, origin_airport string, destination_airport string, flight_status string, aircraft_registration string, source_ts_ms bigint"),
        "silver_loyalty_transactions": spark.createDataFrame([(1, 1, "EARN", 500, 5)], "transaction_id int, loyalty_account_id int, transaction_type string, miles_amount int, source_ts_ms bigint"),
    }
    for name, df in frames.items():
        sinks.overwrite(df, f"{tables}/{name}")
    stop = type(spark).stop
    try:
        type(spark).stop = lambda self: None
        assert main(["gold", "--tables", tables, "--out", out]) == 0
    finally:
        type(spark).stop = stop
    assert sinks.read(spark, f"{out}/fact_bookings").first().customer_key == 0
    assert sinks.read(spark, f"{out}/dim_date").count() == 730
    assert sinks.read(spark, f"{out}/fact_flight_operations").first().aircraft_matched is True


def test_dq_job_on_bookings(spark):
    silver = spark.createDataFrame([(1, 11, "R1", "CONFIRMED"), (1, 12, "R1", "BOGUS"), (2, 99, None, None)],
                                   "booking_id int, customer_id int, booking_reference string, booking_status string")
    customers = spark.createDataFrame([(11,), (12,)], "customer_id int")
    rep = {(r.test_name, r.column_name): r.failures
           for r in J.dq_job("bookings", silver, lambda name: customers).collect()}
    assert rep == {("not_null", "booking_reference"): 1, ("not_null", "booking_status"): 1,
                   ("accepted_values", "booking_status"): 1, ("unique", "booking_id"): 2,
                   ("unique", "booking_reference"): 2, ("relationships", "customer_id"): 1}


def test_other_captured_tables_parse(spark):
    import datetime as dt
    assert len(P.ALL_CAPTURED) == 18
    pay = {"payment_id": 7, "booking_id": 1, "payment_method": "CARD", "amount": "AYag",   # 1000.00
           "currency": "USD", "payment_status": "COMPLETED", "paid_at": 1704067207179575}
    acct = {"loyalty_account_id": 3, "customer_id": "11", "member_number": "M1", "current_tier_id": 1,
            "total_miles_earned": 0, "total_miles_redeemed": 0, "miles_balance": 0, "enrollment_date": 19723}
    p = cdc.parse_changes(_msgs(spark, [("c", pay, None, 1, 1)]), P.ALL_CAPTURED["payments"]).first()
    assert (p.amount, p.paid_at) == (Decimal("1000.00"), dt.datetime(2024, 1, 1, 0, 0, 7, 179575))
    a = cdc.parse_changes(_msgs(spark, [("c", acct, None, 1, 1)]), P.ALL_CAPTURED["loyalty_accounts"]).first()
    assert a.enrollment_date == dt.date(2024, 1, 1)


def test_run_silver_all_then_gold_facts(spark):
    b = lambda i, s: {"booking_id": i, "customer_id": 11, "booking_reference": f"R{i}", "booking_status": s,
                      "booking_channel": "WEB", "currency": "USD"}
    t = lambda i, typ, m: {"transaction_id": i, "loyalty_account_id": 1, "transaction_type": typ,
                           "miles_amount": m, "reference_type": "BOOKING"}
    bronze = {"bookings": cdc.parse_changes(_msgs(spark, [("r", b(1, "PENDING"), None, 1, 1),
                                                          ("r", b(2, "NOPE"), None, 1, 2)]), P.BOOKINGS),
              "loyalty_transactions": cdc.parse_changes(_msgs(spark, [("c", t(1, "EARN", 5), None, 1, 1)]),
                                                        P.LOYALTY_TRANSACTIONS)}
    out = {}
    J.run_silver_all(lambda name: bronze.get(name), lambda name, df: out.__setitem__(name, df),
                     as_of="2026-01-01 00:00:00")
    assert sorted(out) == ["silver_bookings", "silver_loyalty_transactions",
                           "silver_quarantine_bookings", "silver_quarantine_loyalty_transactions"]
    assert out["silver_bookings"].count() == 1 and out["silver_quarantine_bookings"].count() == 1
    dim = spark.createDataFrame([(0, 11)], "customer_key int, customer_id int")
    assert J.build_fact_bookings(out["silver_bookings"], dim).first().customer_key == 0
