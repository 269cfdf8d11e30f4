"""Deletes, repeats, dead letters and lookups when data arrives in several
files and batches."""
import pytest
from pyspark.sql import functions as F

from keelson.operators import cdc, dims, facts
from keelson.plans import fixtures as fx
from keelson.session import scratch_path
from keelson.sinks import versioned
from keelson.streaming import ingest, routing, runner

from conftest import SF_SMALL

MSG = "value string, timestamp timestamp, lsn bigint, copy int"


def test_parsed_and_dead_letters_are_all_messages(spark):
    raw = fx.cdc_raw(spark, SF_SMALL)
    odd = spark.createDataFrame(
        [('{"op":"c","after":{"entity_id":1,"amount_dec":"%%%"},"source":{"lsn":1}}',), ('{"op":"c","after":{"status":"x"}}',), ("{",), (None,)],
        "value string").select("value", F.current_timestamp().alias("timestamp"), F.lit(0).cast("bigint").alias("lsn"), F.lit(0).alias("copy"))
    whole = raw.unionByName(odd)
    dead = cdc.dead_letters(whole, fx.EVENTS_SPEC)
    assert cdc.parse_changes(whole, fx.EVENTS_SPEC).count() + dead.count() == whole.count()
    reasons = {r["reason"]: r["count"] for r in cdc.dead_letters(odd, fx.EVENTS_SPEC).groupBy("reason").count().collect()}
    assert reasons == {"undecodable decimal": 1, "no key": 1, "unparsable": 2}


@pytest.mark.parametrize("splits", [1, 2, 8])
def test_first_event_per_key_whatever_the_splits(spark, splits):
    """Later positions come first, in some files and batches; the table is
    the same, and a batch that moves no first event writes no bucket."""
    msgs = fx.cdc_raw(spark, SF_SMALL)
    landing, out, ck = (scratch_path(spark, n) for n in ("landing", "first", "first-ckpt"))

    def run():
        raw = ingest.file_source(spark, f"{landing}/*", MSG, options={"maxFilesPerTrigger": "3"})
        stream = routing.first_per_key(raw, fx.EVENTS_SPEC)
        runner.run_to_end(runner.start_foreach_batch(stream, routing.keyed_writer(fx.EVENTS_SPEC, out, 4), ck, output_mode="update", state_partitions=2))
        return {r["entity_id"]: r["source_lsn"] for r in versioned.read_buckets(spark, out).collect()}

    want = {r["entity_id"]: r["lsn"] for r in cdc.parse_envelope(msgs, fx.EVENTS_SPEC).groupBy("entity_id").agg(F.min("source_lsn").alias("lsn")).collect()}
    half = F.col("lsn") > 500
    msgs.filter(half).repartition(splits).write.parquet(f"{landing}/a")
    run()
    msgs.filter(~half).orderBy(F.col("lsn").desc()).repartition(splits).write.parquet(f"{landing}/b")
    assert run() == want
    rows = versioned.read_buckets(spark, out).count()
    assert rows == len(want)


@pytest.mark.parametrize("parents_late", [True, False])
def test_early_facts_end_up_the_same_in_both_orders(spark, parents_late):
    """Some purchases are quarantined on the stream; each purchase ends on one side."""
    from keelson.plans import streams
    base = scratch_path(spark, "checked")
    ok, bad = streams.early_facts(spark, SF_SMALL, parents_late, base)
    ev = fx.read(spark, SF_SMALL, "events")
    members = {r["user_id"] for r in ev.where("event_type = 'signup'").select("user_id").collect()}
    buys = {r["event_id"]: r["user_id"] for r in ev.where("event_type = 'purchase'").collect()}
    got_ok, got_bad = [r["event_id"] for r in ok.collect()], [r["event_id"] for r in bad.where("event_id >= 0").collect()]
    assert sorted(got_ok) == sorted(e for e, u in buys.items() if u in members)
    assert sorted(got_bad) == sorted(e for e, u in buys.items() if u not in members)
    redriven = spark.read.parquet(f"{base}/load=redrive-1").count()
    on_stream = spark.read.parquet(base).where("_has_parent and load like 'batch-%'").count()
    assert redriven > 0 and on_stream > 0 and redriven + on_stream == len(got_ok)


def test_scd2_closes_at_a_delete_and_starts_anew(spark):
    v = spark.createDataFrame([(1, "a", 1, "c"), (1, "a", 2, "u"), (1, None, 3, "d"), (1, "a", 5, "c"), (2, "x", 1, "c"), (2, None, 4, "d"), (3, None, 1, "c"), (3, "b", 2, "u")],
                              "k int, s string, ts bigint, op string")
    for skew_safe in (True, False):
        h = dims.scd2(v, ["k"], "ts", ["s"], deleted=F.col("op") == "d", skew_safe=skew_safe)
        got = sorted((r.k, r.s or "", r.valid_from, r.valid_to or 0, r.is_current) for r in h.collect())
        assert got == [(1, "a", 1, 3, False), (1, "a", 5, 0, True), (2, "x", 1, 4, False), (3, "", 1, 2, False), (3, "b", 2, 0, True)]


def test_ledger_delete_takes_back_earlier_rows(spark):
    rows = [(1, 1, "c"), (1, 2, "u"), (1, 3, "d"), (1, 4, "c"), (2, 1, "c"), (3, 1, "d")]
    changes = spark.createDataFrame(rows, "entity_id bigint, source_lsn bigint, cdc_operation string")
    got = sorted((r.entity_id, r.source_lsn) for r in cdc.ledger_rows(changes, fx.EVENTS_SPEC).collect())
    assert got == [(1, 4), (2, 1)]


def test_lookup_check_fails_on_a_repeated_dimension_key(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    good = spark.createDataFrame([(1, 10, "a"), (3, 30, "b"), (None, 40, "c")], "k int, s int, n string")
    got = sorted((r.c or 0, r.s or 0, r.n or "") for r in facts.lookup_key(fact, good, "c", "k", "s", carry=["n"], check=True).collect())
    assert got == [(0, 0, ""), (1, 10, "a"), (2, 0, "")]
    bad = good.unionByName(spark.createDataFrame([(1, 11, "z")], "k int, s int, n string"))
    with pytest.raises(Exception, match="not unique"):
        facts.lookup_key(fact, bad, "c", "k", "s", check=True).collect()


def test_router_over_two_batches(spark):
    base, ck, landing = (scratch_path(spark, n) for n in ("routed", "routed-ckpt", "landing"))
    msgs = fx.cdc_raw(spark, SF_SMALL).select("value", "timestamp", F.lit("t").alias("topic"))
    router = routing.topic_router({"t": fx.EVENTS_SPEC}, routing.batch_partition_writer(base),
                                  reader=routing.batch_partition_reader(spark, base), delay_seconds=10 ** 9)

    def run():
        raw = ingest.file_source(spark, f"{landing}/*", "value string, timestamp timestamp, topic string")
        runner.run_to_end(runner.start_foreach_batch(raw, router, ck))

    msgs.write.parquet(f"{landing}/a")
    run()
    msgs.unionByName(msgs.limit(7).withColumn("topic", F.lit(None).cast("string"))).write.parquet(f"{landing}/b")
    run()
    whole = cdc.dedupe_changes(cdc.parse_changes(fx.cdc_raw(spark, SF_SMALL), fx.EVENTS_SPEC), fx.EVENTS_SPEC)
    got = spark.read.parquet(f"{base}/{fx.EVENTS_SPEC.name}")
    assert got.count() == whole.count() and got.where("cdc_operation = 'd'").count() == whole.where("cdc_operation = 'd'").count() > 0
    assert spark.read.parquet(f"{base}/_unknown_topics").count() == 7
