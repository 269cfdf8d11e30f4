from pyspark.sql import functions as F

from keelson.plans import fixtures as fx
from keelson.plans.queries import UPSERT_CUTOFF
from keelson.session import scratch_path
from keelson.streaming import ingest, runner

from conftest import SF_SMALL

MSG = "value string, timestamp timestamp, lsn bigint, copy int"


def _split(spark):
    msgs = fx.cdc_raw(spark, SF_SMALL)
    cut = F.col("timestamp") < F.lit(UPSERT_CUTOFF).cast("timestamp")
    return msgs.filter(cut), msgs.filter(~cut)


def _run(spark, landing, out, ck, dedupe="change"):
    raw = ingest.file_source(spark, f"{landing}/*", MSG)
    return runner.run_to_end(runner.start_file_sink(ingest.bronze_stream(raw, fx.EVENTS_SPEC, dedupe=dedupe), out, ck))


def test_late_rows_dropped_and_counted(spark):
    early, late = _split(spark)
    landing, out, ck = scratch_path(spark, "l"), scratch_path(spark, "o"), scratch_path(spark, "c")
    late.write.parquet(f"{landing}/a")
    _run(spark, landing, out, ck)
    n_first = spark.read.parquet(out).count()
    early.write.parquet(f"{landing}/b")
    q = _run(spark, landing, out, ck)
    assert spark.read.parquet(out).count() == n_first
    assert runner.dropped_by_watermark(q) > 0


def test_restart_is_exactly_once(spark):
    early, late = _split(spark)
    landing, out, ck = scratch_path(spark, "l"), scratch_path(spark, "o"), scratch_path(spark, "c")
    early.write.parquet(f"{landing}/a")
    _run(spark, landing, out, ck)
    late.write.parquet(f"{landing}/b")
    _run(spark, landing, out, ck)
    _run(spark, landing, out, ck)          # nothing new: adds nothing
    got = spark.read.parquet(out)
    assert got.count() == got.select("entity_id", "source_lsn").distinct().count()
    expect = fx.cdc_raw(spark, SF_SMALL)
    from keelson.operators import cdc
    full = cdc.dedupe_changes(cdc.parse_envelope(expect, fx.EVENTS_SPEC), fx.EVENTS_SPEC)
    assert got.count() == full.count()


def test_first_mode_keeps_one_row_per_key(spark):
    landing, out, ck = scratch_path(spark, "l"), scratch_path(spark, "o"), scratch_path(spark, "c")
    fx.cdc_raw(spark, SF_SMALL).write.parquet(f"{landing}/a")
    _run(spark, landing, out, ck, dedupe="first_arrival")
    got = spark.read.parquet(out)
    assert got.count() == got.select("entity_id").distinct().count()


def test_sessions_match_session_window(spark):
    from keelson.operators.sequences import sessions
    from keelson.streaming import windows
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    a = sessions(ev, ["user_id"], "ts", 1800, tie=["event_id"], aggs=[F.count(F.lit(1)).alias("n")])
    b = windows.session_agg(ev, "ts", "30 minutes", ["user_id"], [F.count(F.lit(1)).alias("n")])
    cols = ["user_id", "session_start", "session_end", "n"]
    assert a.count() == b.count()
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0


def _state_rows(q):
    last = q.recentProgress[-1]
    return sum(int(s["numRowsTotal"]) for s in last["stateOperators"])


def test_state_is_bounded_by_watermark_in_change_mode(spark):
    early, late = _split(spark)
    landing, out, ck = scratch_path(spark, "l"), scratch_path(spark, "o"), scratch_path(spark, "c")
    early.write.parquet(f"{landing}/a")
    _run(spark, landing, out, ck, dedupe="change")
    late.write.parquet(f"{landing}/b")
    q = _run(spark, landing, out, ck, dedupe="change")
    ingested = spark.read.parquet(out).count()
    # entries older than the watermark were evicted: far fewer than ingested changes
    assert _state_rows(q) < ingested / 2


def test_first_mode_state_grows_with_keys(spark):
    early, late = _split(spark)
    landing, out, ck = scratch_path(spark, "l"), scratch_path(spark, "o"), scratch_path(spark, "c")
    early.write.parquet(f"{landing}/a")
    _run(spark, landing, out, ck, dedupe="first_arrival")
    late.write.parquet(f"{landing}/b")
    q = _run(spark, landing, out, ck, dedupe="first_arrival")
    keys = spark.read.parquet(out).select("entity_id").distinct().count()
    assert _state_rows(q) == keys      # one entry per key, never evicted


def test_batch_ingest_late_side_table_and_copies(spark):
    from keelson.streaming import batch_ingest as BI
    early, late = _split(spark)
    landing = scratch_path(spark, "l")
    table, late_tbl, ck = scratch_path(spark, "t"), scratch_path(spark, "late"), scratch_path(spark, "c")

    def run():
        raw = ingest.file_source(spark, f"{landing}/*", MSG)
        return runner.run_to_end(runner.start_foreach_batch(raw, BI.dedupe_batch_writer(fx.EVENTS_SPEC, table, late_tbl), ck))

    late.write.parquet(f"{landing}/a")          # later half first
    run()
    early.write.parquet(f"{landing}/b")         # earlier half arrives after the watermark passed it
    late.write.parquet(f"{landing}/c")          # the later half delivered again: all copies
    run()
    from keelson.operators import cdc
    led = cdc.dedupe_changes(cdc.parse_envelope(fx.cdc_raw(spark, SF_SMALL), fx.EVENTS_SPEC), fx.EVENTS_SPEC)
    cut = F.col("kafka_timestamp") < F.lit(UPSERT_CUTOFF).cast("timestamp")
    got = BI.read_table(spark, table)
    assert got.count() == led.filter(~cut).count()                       # copies not written twice
    assert got.count() == got.select("entity_id", "source_lsn").distinct().count()
    lt = BI.read_late(spark, late_tbl)
    early_ids = led.filter(cut).select("entity_id", "source_lsn")
    assert early_ids.exceptAll(lt.select("entity_id", "source_lsn")).count() == 0   # late rows kept aside
    assert lt.filter(cut).count() == early_ids.count()
    run()                                                               # nothing new: nothing added
    assert BI.read_table(spark, table).count() == got.count()


def test_closed_window_ignores_late_events(spark):
    from keelson.streaming import windows
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "event_type")
    cut = F.col("ts") < F.lit(UPSERT_CUTOFF).cast("timestamp_ntz")
    landing, out, ck = scratch_path(spark, "l"), scratch_path(spark, "o"), scratch_path(spark, "c")

    def run():
        src = ingest.file_source(spark, f"{landing}/*", "event_id bigint, ts timestamp_ntz, event_type string")
        agg = windows.window_agg(src.withColumn("et", F.col("ts").cast("timestamp")), "et", "1 hour",
                                 [F.count(F.lit(1)).alias("n")], watermark="10 minutes")
        return runner.run_to_end(runner.start_file_sink(agg, out, ck))

    ev.filter(cut).write.parquet(f"{landing}/a")
    run()
    first = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    ev.filter(cut).write.parquet(f"{landing}/b")      # the same hours again: all late now
    q = run()
    again = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert again == first and runner.dropped_by_watermark(q) > 0


def test_one_query_per_table(spark):
    from keelson.plans import jobs as J
    from keelson.plans.streams import ORDERS_SPEC, order_envelopes
    landing = scratch_path(spark, "l")
    fx.cdc_raw(spark, SF_SMALL).write.parquet(f"{landing}/events")
    order_envelopes(spark.read.parquet(f"{SF_SMALL}/orders.parquet")).write.parquet(f"{landing}/orders")
    sources = {"events_cdc": ingest.file_source(spark, f"{landing}/events", MSG),
               "orders_cdc": ingest.file_source(spark, f"{landing}/orders", "value string, timestamp timestamp")}
    base, ck = scratch_path(spark, "bronze"), scratch_path(spark, "ck")
    qs = J.start_bronze_queries(sources, {"events_cdc": fx.EVENTS_SPEC, "orders_cdc": ORDERS_SPEC}, base, ck)
    for q in qs.values():
        runner.run_to_end(q)
    assert spark.read.parquet(f"{base}/bronze_orders_cdc").count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert spark.read.parquet(f"{base}/bronze_events_cdc").count() > 0


def test_processing_time_trigger_picks_up_new_files(spark):
    import time
    early, late = _split(spark)
    landing, out, ck = scratch_path(spark, "l"), scratch_path(spark, "o"), scratch_path(spark, "c")
    early.write.parquet(f"{landing}/a")
    raw = ingest.file_source(spark, f"{landing}/*", MSG)
    q = runner.start_file_sink(ingest.bronze_stream(raw, fx.EVENTS_SPEC), out, ck,
                               trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        n1 = spark.read.parquet(out).count()
        late.write.parquet(f"{landing}/b")          # lands while the query runs
        deadline = time.time() + 120
        while time.time() < deadline:
            q.processAllAvailable()
            if spark.read.parquet(out).count() > n1:
                break
            time.sleep(1)
        assert q.isActive and q.exception() is None
    finally:
        q.stop()
    got = spark.read.parquet(out)
    assert got.count() > n1 and got.count() == got.select("entity_id", "source_lsn").distinct().count()


def test_streaming_sliding_windows_match_batch(spark):
    from keelson.streaming import windows
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts")
    landing, out, ck = scratch_path(spark, "l"), scratch_path(spark, "o"), scratch_path(spark, "c")
    ev.write.parquet(f"{landing}/a")
    src = ingest.file_source(spark, f"{landing}/*", "event_id bigint, ts timestamp_ntz")
    agg = windows.window_agg(src.withColumn("et", F.col("ts").cast("timestamp")), "et", "1 hour",
                             [F.count(F.lit(1)).alias("n")], slide="30 minutes", watermark="10 minutes")
    runner.run_to_end(runner.start_file_sink(agg, out, ck))
    got = spark.read.parquet(out).select(F.col("window_start").cast("timestamp_ntz").alias("s"), "n")
    wm = ev.agg(F.max("ts")).first()[0]
    import datetime as dt
    batch = (windows.window_agg(ev, "ts", "1 hour", [F.count(F.lit(1)).alias("n")], slide="30 minutes")
             .filter(F.col("window_end") <= F.lit(wm - dt.timedelta(minutes=10)))
             .select(F.col("window_start").alias("s"), "n"))
    assert got.count() > 0 and got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_sessions_ignore_null_times_like_session_window(spark):
    from keelson.operators.sequences import sessions
    from keelson.streaming import windows
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev = ev.withColumn("ts", F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.col("ts")))
    a = sessions(ev, ["user_id"], "ts", 1800, tie=["event_id"], aggs=[F.count(F.lit(1)).alias("n")])
    b = windows.session_agg(ev, "ts", "30 minutes", ["user_id"], [F.count(F.lit(1)).alias("n")])
    cols = ["user_id", "session_start", "session_end", "n"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0 and b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_batch_ingest_keeps_deletes_when_asked(spark):
    from keelson.streaming import batch_ingest as BI
    landing = scratch_path(spark, "l")
    table, late_tbl, ck = scratch_path(spark, "t"), scratch_path(spark, "late"), scratch_path(spark, "c")
    fx.cdc_raw(spark, SF_SMALL).write.parquet(f"{landing}/a")
    raw = ingest.file_source(spark, f"{landing}/*", MSG)
    runner.run_to_end(runner.start_foreach_batch(raw, BI.dedupe_batch_writer(fx.EVENTS_SPEC, table, late_tbl,
                                                                             keep_deletes=True), ck))
    got = BI.read_table(spark, table)
    assert got.filter(F.col("cdc_operation") == "d").count() > 0
    assert got.count() == got.select("entity_id", "source_lsn").distinct().count()
