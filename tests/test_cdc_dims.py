from pyspark.sql import Window
from pyspark.sql import functions as F

from keelson.operators import cdc, dims
from keelson.plans import fixtures as fx

from conftest import SF_SMALL


def test_malformed_and_deletes(spark):
    raw = spark.createDataFrame([
        ('{"payload":{"after":{"entity_id":1,"status":"view"},"source":{"ts_ms":5,"lsn":1},"op":"u"}}',),
        ('{"payload":{"before":{"entity_id":2},"after":null,"source":{"ts_ms":6,"lsn":2},"op":"d"}}',),
        ('{"payload":{"after":{"entity_id":3', ),
        ('not json',)], "value string").withColumn("timestamp", F.current_timestamp())
    assert [r.entity_id for r in cdc.parse_envelope(raw, fx.EVENTS_SPEC).collect()] == [1]
    ch = {r.entity_id: r.cdc_operation for r in cdc.parse_changes(raw, fx.EVENTS_SPEC).collect()}
    assert ch == {1: "u", 2: "d"}
    stats = {r.cdc_operation: (r.n_messages, r.n_parsed) for r in cdc.parse_stats(raw, fx.EVENTS_SPEC).collect()}
    assert stats == {"u": (1, 1), "d": (1, 1), None: (2, 0)}


def test_current_state_forms_agree(spark):
    led = cdc.dedupe_changes(cdc.parse_envelope(fx.cdc_raw(spark, SF_SMALL), fx.EVENTS_SPEC), fx.EVENTS_SPEC)
    a = cdc.current_state(led, fx.EVENTS_SPEC).select("entity_id", "source_lsn")
    b = cdc.current_state_window(led, fx.EVENTS_SPEC).select("entity_id", "source_lsn")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == led.select("entity_id").distinct().count()


def test_one_current_row_per_key_under_shuffled_input(spark):
    led = cdc.dedupe_changes(cdc.parse_envelope(fx.cdc_raw(spark, SF_SMALL), fx.EVENTS_SPEC), fx.EVENTS_SPEC)
    a = cdc.current_state(led, fx.EVENTS_SPEC)
    b = cdc.current_state(led.repartition(5).orderBy(F.rand(7)), fx.EVENTS_SPEC)
    assert a.exceptAll(b).count() == 0


def test_dense_key_independent_of_partitions(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey")
    ref = c.select("c_custkey", (F.row_number().over(Window.orderBy("c_custkey")) - 1).cast("bigint").alias("k"))
    for n in (1, 3, 8):
        got = dims.dense_key(c.repartition(5), ["c_custkey"], "k", num_partitions=n)
        assert got.exceptAll(ref).count() == 0 and got.count() == ref.count()


def test_assign_keys_keeps_old_keys(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey")
    first = dims.dense_key(c.filter("c_custkey % 2 = 0"), ["c_custkey"], "k")
    second = dims.assign_keys(c, first, ["c_custkey"], "k")
    assert second.join(first, ["c_custkey", "k"]).count() == first.count()
    assert second.select("k").distinct().count() == c.count()
    assert second.agg(F.max("k")).first()[0] == c.count() - 1


def test_calendar(spark):
    d = {r.date.isoformat(): r for r in dims.calendar(spark, "2025-01-01", "2026-12-31").collect()}
    assert len(d) == 730
    r = d["2025-01-05"]
    assert (r.date_key, r.day_of_week, r.quarter, r.month_name, r.day_name) == (20250105, 1, 1, "January", "Sunday")


def test_enrich_cannot_fan_out(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "rk int, v string")
    got = sorted((r.k, r.v) for r in dims.enrich(left, right, "k", "rk", ["v"]).collect())
    assert got == [(1, "a"), (2, None)]


def test_ordered_scan_hot_key_matches_window(spark):
    from keelson.operators.sequences import ordered_scan
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    # one key holds a third of all rows
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = ev.select("event_id", F.lag("event_type").over(w).alias("lag_event_type"),
                    F.lead("ts").over(w).alias("lead_ts"),
                    F.round(F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)), 4).alias("rs"))
    for n in (1, 3, 8, 32):
        got = ordered_scan(ev, ["user_id"], ["ts", "event_id"], lag=["event_type"], lead=["ts"],
                           running_sum={"rs": F.col("value")}, num_partitions=n)
        got = got.select("event_id", "lag_event_type", "lead_ts", F.round("rs", 4).alias("rs"))
        assert got.count() == ref.count()
        assert got.exceptAll(ref).count() == 0


def test_scd2_forms_agree(spark):
    led = cdc.dedupe_changes(cdc.parse_envelope(fx.cdc_raw(spark, SF_SMALL), fx.EVENTS_SPEC), fx.EVENTS_SPEC)
    v = led.select("entity_id", "status", "source_ts_ms", "source_lsn")
    a = dims.scd2(v, ["entity_id"], "source_ts_ms", ["status"], tie=["source_lsn"], skew_safe=True)
    b = dims.scd2(v, ["entity_id"], "source_ts_ms", ["status"], tie=["source_lsn"], skew_safe=False)
    cols = ["entity_id", "status", "source_lsn", "valid_from", "valid_to", "is_current"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    assert a.count() == b.count()


def test_binary_kafka_value_parses(spark):
    raw = spark.createDataFrame(
        [(bytearray(b'{"payload":{"after":{"entity_id":5,"status":"view"},"source":{"ts_ms":1,"lsn":9},"op":"u"}}'),)],
        "value binary").withColumn("timestamp", F.current_timestamp())
    r = cdc.parse_envelope(raw, fx.EVENTS_SPEC).first()
    assert (r.entity_id, r.status, r.source_lsn) == (5, "view", 9)


def test_jdbc_options_partitioned(monkeypatch):
    import pytest

    from keelson.sources.tables import jdbc_options
    monkeypatch.setenv("JDBC_USER", "u")
    monkeypatch.delenv("JDBC_PASSWORD", raising=False)
    o = jdbc_options("jdbc:x://h/db", "customers", partition_column="customer_id", lower=1, upper=300,
                     num_partitions=4)
    assert o["user"] == "u" and "password" not in o
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("customer_id", "1", "300", "4")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db", "t", partition_column="id")


def test_range_lookup_fallback_equals_broadcast(spark):
    from keelson.operators.joins import range_lookup
    from keelson.plans import fixtures as fx2
    vals = spark.createDataFrame([(i, v) for i, v in enumerate([-5, 0, 1, 24999, 25000, 74999, 75000, 150000, 10 ** 7])],
                                 "id int, miles bigint")
    tiers = fx2.tiers_df(spark)
    a = range_lookup(vals, "miles", tiers, "min_miles")
    b = range_lookup(vals, "miles", tiers, "min_miles", max_rows=0)   # force the as-of path
    got_a = sorted((r.id, r.tier_name) for r in a.collect())
    got_b = sorted((r.id, r.tier_name) for r in b.collect())
    assert got_a == got_b
    assert dict(got_a) == {0: None, 1: "Bronze", 2: "Bronze", 3: "Bronze", 4: "Silver", 5: "Silver", 6: "Gold",
                           7: "Platinum", 8: "Platinum"}


def test_hot_key_detection_and_auto_scan(spark):
    from keelson.operators.sequences import has_hot_key, keyed_scan
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id")))
    assert not has_hot_key(ev, ["user_id"], 8)
    assert has_hot_key(hot, ["user_id"], 8)
    a = keyed_scan(hot, ["user_id"], ["ts", "event_id"], lag=["event_type"], skew_safe="auto")
    b = keyed_scan(hot, ["user_id"], ["ts", "event_id"], lag=["event_type"], skew_safe=False)
    cols = ["event_id", "lag_event_type"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0


def test_ordered_scan_null_key_spanning_slices(spark):
    from keelson.operators.sequences import ordered_scan, window_scan
    df = spark.range(0, 400).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.lit(1)).cast("int").alias("k"),
                                    F.col("id").alias("t"), (F.col("id") % 7).alias("v"))
    a = ordered_scan(df, ["k"], ["t"], lag=["v"], lead=["v"], running_sum={"s": F.col("v")}, num_partitions=8)
    b = window_scan(df, ["k"], ["t"], lag=["v"], lead=["v"], running_sum={"s": F.col("v")})
    cols = ["k", "t", "lag_v", "lead_v", "s"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0 and a.count() == 400


def test_bare_records_and_tombstones(spark):
    raw = spark.createDataFrame([
        ('{"payload":{"after":{"entity_id":1,"status":"view"},"source":{"ts_ms":5,"lsn":1},"op":"u"}}',),
        ('{"after":{"entity_id":2,"status":"click"},"source":{"ts_ms":6,"lsn":2},"op":"c"}',),   # schemas off
        (None,),                                                                               # tombstone
    ], "value string").withColumn("timestamp", F.current_timestamp())
    got = sorted((r.entity_id, r.status) for r in cdc.parse_envelope(raw, fx.EVENTS_SPEC).collect())
    assert got == [(1, "view"), (2, "click")]
    stats = {r.cdc_operation: (r.n_messages, r.n_parsed) for r in cdc.parse_stats(raw, fx.EVENTS_SPEC).collect()}
    assert stats == {"u": (1, 1), "c": (1, 1), None: (1, 0)}


def test_hashed_key_is_stable(spark):
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey")
    a = dims.hashed_key(c, ["c_custkey"], "k")
    b = dims.hashed_key(c.repartition(7), ["c_custkey"], "k")
    assert a.exceptAll(b).count() == 0 and a.select("k").distinct().count() == c.count()


def test_ordered_scan_null_measures_across_slices(spark):
    from keelson.operators.sequences import ordered_scan, window_scan
    # key 1 spans all slices; its measure is NULL on every other row
    df = spark.range(0, 200).select(F.lit(1).alias("k"), F.col("id").alias("t"),
                                    F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id")).alias("v"))
    a = ordered_scan(df, ["k"], ["t"], running_sum={"s": F.col("v")}, num_partitions=8).select("t", "s")
    b = window_scan(df, ["k"], ["t"], running_sum={"s": F.col("v")}).select("t", "s")
    assert a.exceptAll(b).count() == 0 and a.count() == 200
