"""Streaming queries over the test tables.  Each runs a Structured
Streaming query to completion (``availableNow``) into a fresh folder under
the shared checkpoint directory and returns the sink read back as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.plans import fixtures as fx
from keelson.plans.queries import UPSERT_CUTOFF, query
from keelson.session import ensure_utc, scratch_path
from keelson.spec import TableSpec
from keelson.streaming import ingest, routing, runner, windows

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
MSG_SCHEMA = "value string, timestamp timestamp, lsn bigint, copy int"


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events file as a stream."""
    return ingest.file_source(spark, sf, EVENTS_SCHEMA, options={"pathGlobFilter": "events.parquet"})


def _bronze_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("kafka_ts", F.col("kafka_timestamp").cast("timestamp_ntz")).drop("kafka_timestamp")


def _run_ingest(spark, sf, dedupe: str) -> DataFrame:
    ensure_utc(spark)
    raw = fx.envelopes(_events_stream(spark, sf))
    out, ck = scratch_path(spark, "bronze"), scratch_path(spark, "bronze-ckpt")
    stream = ingest.bronze_stream(raw, fx.EVENTS_SPEC, dedupe=dedupe)
    runner.run_to_end(runner.start_file_sink(stream, out, ck, state_partitions=_cores(spark)))
    return spark.read.parquet(out)


@query("stream_bronze_ingest")
def q_stream_bronze_ingest(spark, sf):
    return _bronze_columns(_run_ingest(spark, sf, "change"))


@query("stream_dedupe_change")
def q_stream_dedupe_change(spark, sf):
    return _run_ingest(spark, sf, "change").select("entity_id", "source_lsn", "cdc_operation")


@query("stream_dedupe_first")
def q_stream_dedupe_first(spark, sf):
    """First event per key for ever (the captured jobs' behaviour): decided
    by the log position, not by the order in which rows arrive."""
    ensure_utc(spark)
    from keelson.sinks import versioned
    out, ck = scratch_path(spark, "first"), scratch_path(spark, "first-ckpt")
    stream = routing.first_per_key(fx.envelopes(_events_stream(spark, sf)), fx.EVENTS_SPEC)
    runner.run_to_end(runner.start_foreach_batch(stream, routing.keyed_writer(fx.EVENTS_SPEC, out, 8), ck, output_mode="update",
                                                 state_partitions=_cores(spark)))
    return versioned.read_buckets(spark, out).select("entity_id", "source_lsn", "status")


@query("stream_window_counts")
def q_stream_window_counts(spark, sf):
    """Hourly counts per event type, append mode: a window is emitted once
    the watermark (max event time - 10 minutes) passes its end."""
    ensure_utc(spark)
    ev = _events_stream(spark, sf).withColumn("event_time", F.col("ts").cast("timestamp"))
    agg = windows.window_agg(ev, "event_time", "1 hour",
                             [F.count(F.lit(1)).alias("n_events"),
                              F.sum(F.col("value").cast("decimal(12,2)")).cast("decimal(18,2)").alias("total_value")],
                             by=["event_type"], watermark="10 minutes")
    out, ck = scratch_path(spark, "windows"), scratch_path(spark, "windows-ckpt")
    runner.run_to_end(runner.start_file_sink(agg, out, ck, state_partitions=_cores(spark)))
    return (spark.read.parquet(out)
            .withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
            .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


@query("window_sliding_counts")
def q_window_sliding_counts(spark, sf):
    """Batch form: 1 hour windows sliding by 30 minutes."""
    ev = fx.read(spark, sf, "events")
    return windows.window_agg(ev, "ts", "1 hour", [F.count(F.lit(1)).alias("n_events")], slide="30 minutes")


@query("session_counts")
def q_session_counts(spark, sf):
    """Batch form: per-user sessions closed by 30 minutes of inactivity
    (skew-safe ordered scans; ``windows.session_agg`` is the streaming form
    and gives the same rows, see tests)."""
    from keelson.operators.sequences import sessions
    ev = fx.read(spark, sf, "events")
    return sessions(ev, ["user_id"], "ts", 30 * 60, tie=["event_id"], aggs=[F.count(F.lit(1)).alias("n_events")])


def _two_deliveries(spark, sf, first_late: bool):
    """Stream the change log in two deliveries into one checkpointed query:
    run 1 sees delivery A, run 2 restarts from the checkpoint after delivery
    B has landed.  Deliveries split the log at a time cutoff."""
    ensure_utc(spark)
    msgs = fx.cdc_raw(spark, sf)
    cut = F.col("timestamp") < F.lit(UPSERT_CUTOFF).cast("timestamp")
    early, late = msgs.filter(cut), msgs.filter(~cut)
    a, b = (late, early) if first_late else (early, late)
    landing = scratch_path(spark, "landing")
    a.write.parquet(f"{landing}/a")
    out, ck = scratch_path(spark, "sink"), scratch_path(spark, "sink-ckpt")

    def run():
        raw = ingest.file_source(spark, f"{landing}/*", MSG_SCHEMA)
        return runner.run_to_end(runner.start_file_sink(
            ingest.bronze_stream(raw, fx.EVENTS_SPEC, dedupe="change"), out, ck, state_partitions=_cores(spark)))

    q1 = run()
    b.write.parquet(f"{landing}/b")
    q2 = run()
    return spark.read.parquet(out), q1, q2


@query("stream_late_rows")
def q_stream_late_rows(spark, sf):
    """The later half of the log arrives first; the earlier half, landing
    after the watermark has moved past it, is dropped as late (counted in
    the query progress as numRowsDroppedByWatermark)."""
    df, _, _ = _two_deliveries(spark, sf, first_late=True)
    return _bronze_columns(df)


@query("stream_restart")
def q_stream_restart(spark, sf):
    """Stop after the first delivery, restart from the checkpoint after the
    second: every change lands exactly once."""
    df, _, _ = _two_deliveries(spark, sf, first_late=False)
    return _bronze_columns(df)


ORDERS_SPEC = TableSpec(name="orders_cdc", key=("o_orderkey",),
                        after_ddl="o_orderkey bigint, o_orderstatus string, o_totalprice double",
                        source_system="sales", keep_before=False)


def order_envelopes(orders: DataFrame) -> DataFrame:
    """orders as a snapshot change log (op r, log position = order key)."""
    from keelson.functions.exprs import epoch_ms
    after = F.struct("o_orderkey", "o_orderstatus", "o_totalprice")
    source = F.struct(epoch_ms("o_orderdate").alias("ts_ms"), F.lit("true").alias("snapshot"),
                      F.lit("sales").alias("db"), F.lit("orders").alias("table"),
                      F.lit(None).cast("bigint").alias("txId"), F.col("o_orderkey").alias("lsn"))
    payload = F.struct(after.alias("after"), source.alias("source"), F.lit("r").alias("op"),
                       epoch_ms("o_orderdate").alias("ts_ms"))
    return orders.select(F.to_json(F.struct(payload.alias("payload"))).alias("value"),
                         F.col("o_orderdate").cast("timestamp").alias("timestamp"))


@query("stream_multi_table")
def q_stream_multi_table(spark, sf):
    """Two captured tables on one stream, routed by topic in foreachBatch
    and written per table and batch (idempotent on replay), over two
    overlapping deliveries, with deletes and a topic without a spec."""
    ensure_utc(spark)
    ev = fx.read(spark, sf, "events")
    orders = fx.read(spark, sf, "orders")
    ev_msgs = fx.envelopes(ev).select("value", "timestamp", F.lit("shop.events").alias("topic"))
    ord_msgs = order_envelopes(orders).withColumn("topic", F.lit("sales.orders"))
    stray = ev_msgs.filter(F.col("value").contains('"op":"c"')).withColumn("topic", F.lit("shop.unheard"))
    landing, base, ck = scratch_path(spark, "multi-landing"), scratch_path(spark, "multi"), scratch_path(spark, "multi-ckpt")
    router = routing.topic_router({"shop.events": fx.EVENTS_SPEC, "sales.orders": ORDERS_SPEC}, routing.batch_partition_writer(base),
                                  reader=routing.batch_partition_reader(spark, base))

    def run():
        raw = ingest.file_source(spark, f"{landing}/*", "value string, timestamp timestamp, topic string")
        runner.run_to_end(runner.start_foreach_batch(raw, router, ck))

    # two deliveries that overlap: the second repeats all changes of the first
    cut = F.col("timestamp") < F.lit(UPSERT_CUTOFF).cast("timestamp")
    ev_msgs.filter(cut).unionByName(ord_msgs).unionByName(stray).write.parquet(f"{landing}/a")
    run()
    ev_msgs.unionByName(ord_msgs).write.parquet(f"{landing}/b")
    run()
    ev = spark.read.parquet(f"{base}/{fx.EVENTS_SPEC.name}")
    od = spark.read.parquet(f"{base}/{ORDERS_SPEC.name}")
    un = spark.read.parquet(f"{base}/_unknown_topics")
    return (ev.select(F.lit("events").alias("table_name"), F.col("entity_id").alias("entity_key"), "source_lsn", "cdc_operation")
            .unionByName(od.select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("entity_key"), "source_lsn", "cdc_operation"))
            .unionByName(un.select(F.col("topic").alias("table_name"), F.lit(None).cast("bigint").alias("entity_key"),
                                   F.lit(None).cast("bigint").alias("source_lsn"), F.lit(None).cast("string").alias("cdc_operation"))))


@query("stream_late_side_table")
def q_stream_late_side_table(spark, sf):
    """foreachBatch ingest: the later half of the log arrives first, then the
    earlier half; the earlier half is behind the watermark and lands, once
    per change, in the late-rows side table."""
    from keelson.streaming import batch_ingest as BI
    ensure_utc(spark)
    msgs = fx.cdc_raw(spark, sf)
    cut = F.col("timestamp") < F.lit(UPSERT_CUTOFF).cast("timestamp")
    landing = scratch_path(spark, "landing")
    table, late, ck = scratch_path(spark, "table"), scratch_path(spark, "late"), scratch_path(spark, "ckpt")

    def run():
        raw = ingest.file_source(spark, f"{landing}/*", MSG_SCHEMA)
        runner.run_to_end(runner.start_foreach_batch(raw, BI.dedupe_batch_writer(fx.EVENTS_SPEC, table, late), ck))

    msgs.filter(~cut).write.parquet(f"{landing}/a")
    run()
    msgs.filter(cut).write.parquet(f"{landing}/b")
    run()
    return _bronze_columns(BI.read_late(spark, late).drop("batch_id", "event_date"))


CHILD = "event_id bigint, user_id bigint, ts timestamp"
PARENT = "member_id bigint, joined timestamp"


def early_facts(spark, sf, parents_late: bool, base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Purchases wait for their user's first signup.  Purchases and signups
    come in two deliveries, the signups of odd users with the first or only
    with the second one; what was quarantined is re-driven at the end.
    Returns the accepted and the quarantined purchases."""
    from pyspark.sql import types as T

    from keelson.streaming import references as R
    ensure_utc(spark)
    ev = fx.read(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    buys = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    joins = ev.filter(F.col("event_type") == "signup").groupBy(F.col("user_id").alias("member_id")).agg(F.min("ts").alias("joined"))
    # far-off rows that match nothing: they move both watermarks past all others
    flush = ev.agg(F.timestamp_add("DAY", F.lit(400), F.max("ts")).alias("ts"))
    cut = F.col("ts") < F.lit(UPSERT_CUTOFF).cast("timestamp")
    odd = F.col("member_id") % 2 == 1
    first_joins, later_joins = (joins.filter(~odd), joins.filter(odd)) if parents_late else (joins.filter(odd), joins.filter(~odd))
    landing, ck = scratch_path(spark, "early"), scratch_path(spark, "early-ckpt")
    base = base or scratch_path(spark, "checked")
    schema = T.StructType.fromDDL(CHILD)

    def deliver(name: str, b: DataFrame, j: DataFrame) -> None:
        b.write.parquet(f"{landing}/buys/{name}")
        j.write.parquet(f"{landing}/joins/{name}")
        waiting = R.await_parents(ingest.file_source(spark, f"{landing}/buys/*", CHILD), ingest.file_source(spark, f"{landing}/joins/*", PARENT),
                                  "user_id", "member_id", "ts", "joined", wait="2 days", remember="400 days")
        runner.run_to_end(runner.start_foreach_batch(waiting, R.split_writer(base), ck, state_partitions=_cores(spark)))

    deliver("a", buys.filter(cut), first_joins)
    deliver("b", buys.filter(~cut), later_joins)
    deliver("end", flush.select(F.lit(-1).cast("bigint").alias("event_id"), F.lit(-1).cast("bigint").alias("user_id"), "ts"),
            flush.select(F.lit(-2).cast("bigint").alias("member_id"), F.col("ts").alias("joined")))
    R.redrive(spark, base, schema, "event_id", "user_id", joins, "member_id", run="1")
    return R.accepted(spark, base, schema), R.quarantined(spark, base, schema, "event_id")


@query("stream_early_facts")
def q_stream_early_facts(spark, sf):
    """Every purchase once: accepted when its user ever signed up."""
    ok, bad = early_facts(spark, sf, parents_late=True)
    return (ok.withColumn("has_parent", F.lit(True)).unionByName(bad.withColumn("has_parent", F.lit(False)))
            .filter(F.col("event_id") >= 0).select("event_id", "user_id", "has_parent"))
