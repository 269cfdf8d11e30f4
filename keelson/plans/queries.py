"""The named queries: library operators bound to the test tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns match the SQL oracle of the same name in ``plans.oracle``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.exprs import epoch_ms
from keelson.operators import cdc, dims, facts, ledger as ledger_op, lifecycle, rollups as R
from keelson.operators import quality as Q
from keelson.plans import fixtures as fx
from keelson.spec import TableSpec

AS_OF_PROCESSED = "2024-02-01 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _ntz(df: DataFrame, col: str = "kafka_timestamp", out: str = "kafka_ts") -> DataFrame:
    return df.withColumn(out, F.col(col).cast("timestamp_ntz")).drop(col) if col in df.columns else df


@fx.memo
def bronze(spark, sf) -> DataFrame:
    """Parsed change log in the captured form (deletes and bad messages out)."""
    return cdc.parse_envelope(fx.cdc_raw(spark, sf), fx.EVENTS_SPEC)


@fx.memo
def ledger(spark, sf) -> DataFrame:
    """Bronze with repeated deliveries removed (one row per change)."""
    return cdc.dedupe_changes(bronze(spark, sf), fx.EVENTS_SPEC)


@fx.memo
def all_changes(spark, sf) -> DataFrame:
    """Every parsed change, deletes included, one row per change."""
    return cdc.dedupe_changes(raw_changes(spark, sf), fx.EVENTS_SPEC)


@fx.memo
def raw_changes(spark, sf) -> DataFrame:
    """Every parsed change as delivered (repeats included).  Current-state
    aggregates read this directly: a repeated delivery is an identical row,
    so ``max_by`` collapses it without a separate dedupe shuffle."""
    return cdc.parse_changes(fx.cdc_raw(spark, sf), fx.EVENTS_SPEC)


STATE_COLS = ["entity_id", "status", "amount", "amount_dec", "note", "cdc_operation",
              "source_ts_ms", "source_lsn"]


@query("cdc_parse_envelope")
def q_cdc_parse_envelope(spark, sf):
    return _ntz(bronze(spark, sf))


@query("cdc_current_state")
def q_cdc_current_state(spark, sf):
    return cdc.current_state_window(bronze(spark, sf), fx.EVENTS_SPEC).select(*STATE_COLS)


@query("cdc_current_state_agg")
def q_cdc_current_state_agg(spark, sf):
    return cdc.current_state(bronze(spark, sf), fx.EVENTS_SPEC).select(*STATE_COLS)


@fx.memo
def checked_current(spark, sf) -> DataFrame:
    return Q.check(cdc.current_state(bronze(spark, sf), fx.EVENTS_SPEC), fx.EVENTS_SPEC.rules)


@query("quality_split_valid")
def q_quality_split_valid(spark, sf):
    valid, _ = Q.split(checked_current(spark, sf))
    return valid.select("entity_id", "status", "amount", "amount_dec", "note", "source_ts_ms",
                        F.lit(AS_OF_PROCESSED).cast("timestamp_ntz").alias("_silver_processed_at"))


@query("quality_split_quarantine")
def q_quality_split_quarantine(spark, sf):
    _, quarantine = Q.split(checked_current(spark, sf))
    return quarantine.select("entity_id", "status", "amount", "note", "source_ts_ms", "source_lsn",
                             "has_valid_status", "has_valid_amount", "has_note",
                             "quarantine_reason", "failed_rules")


CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


def dim_customer(spark, sf) -> DataFrame:
    return dims.dense_key(fx.read(spark, sf, "customer").select(*CUSTOMER_COLS), ["c_custkey"], "customer_key")


@query("fact_lookup")
def q_fact_lookup(spark, sf):
    orders = fx.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                 "o_totalprice", "o_orderdate")
    fact = facts.lookup_key(orders, dim_customer(spark, sf), "o_custkey", "c_custkey", "customer_key", check=True)
    return fact.select("o_orderkey", "customer_key", "o_orderstatus", "o_totalprice", "o_orderdate")


# ---------------------------------------------------------------- CDC ----

@query("cdc_parse_stats")
def q_cdc_parse_stats(spark, sf):
    return cdc.parse_stats(fx.cdc_raw(spark, sf), fx.EVENTS_SPEC)


@query("cdc_sample")
def q_cdc_sample(spark, sf):
    b = bronze(spark, sf).select("source_lsn", "entity_id", "cdc_operation", "status", "note")
    return cdc.sample(b, 5, ["source_lsn"], {"note": 6})


@query("cdc_decode_decimal")
def q_cdc_decode_decimal(spark, sf):
    return ledger(spark, sf).select("source_lsn", "amount", "amount_dec")


@query("cdc_current_state_deletes")
def q_cdc_current_state_deletes(spark, sf):
    return cdc.current_state_with_deletes(raw_changes(spark, sf), fx.EVENTS_SPEC).select(*STATE_COLS)


@query("cdc_dead_letters")
def q_cdc_dead_letters(spark, sf):
    d = cdc.dead_letters(fx.cdc_raw(spark, sf), fx.EVENTS_SPEC)
    return d.select("reason", F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_ts")).groupBy("reason", "kafka_ts").agg(F.count(F.lit(1)).alias("n_messages"))


@query("ledger_delete_state")
def q_ledger_delete_state(spark, sf):
    """Ledger rows that stand after deletes."""
    return cdc.ledger_rows(all_changes(spark, sf), fx.EVENTS_SPEC).select("entity_id", "source_lsn", "cdc_operation", "amount_dec")


@query("cdc_change_diff")
def q_cdc_change_diff(spark, sf):
    return (cdc.change_diff(all_changes(spark, sf), fx.EVENTS_SPEC)
            .select("source_lsn", "entity_id", "cdc_operation", "changed_columns"))


# A spec that the log has drifted away from: two fields are not declared,
# one is declared as an integer, one does not exist any more.
DRIFTED_SPEC = TableSpec(name="events_cdc", key=("entity_id",), source_system="shop", keep_before=False,
                         after_ddl="entity_id bigint, status string, amount bigint, channel string")


@query("cdc_schema_drift")
def q_cdc_schema_drift(spark, sf):
    return cdc.schema_drift(fx.cdc_raw(spark, sf), DRIFTED_SPEC)


# ------------------------------------------------------------ quality ----

@fx.memo
def checked_ledger(spark, sf) -> DataFrame:
    return Q.check(ledger(spark, sf), fx.EVENTS_SPEC.rules)


@query("quality_flags")
def q_quality_flags(spark, sf):
    return checked_ledger(spark, sf).select("source_lsn", "entity_id", "has_valid_status",
                                            "has_valid_amount", "has_note")


@query("rule_accepted_values")
def q_rule_accepted_values(spark, sf):
    r = Q.accepted_values("has_valid_status", "status", fx.EVENT_STATUSES)
    return ledger(spark, sf).select("source_lsn", r.flag().alias(r.name))


@query("rule_positive")
def q_rule_positive(spark, sf):
    r = Q.positive("has_valid_amount", "amount")
    return ledger(spark, sf).select("source_lsn", r.flag().alias(r.name))


@query("rule_required")
def q_rule_required(spark, sf):
    r = Q.required("has_note", "note")
    return ledger(spark, sf).select("source_lsn", r.flag().alias(r.name))


@query("rule_null_or_nonneg")
def q_rule_null_or_nonneg(spark, sf):
    r = Q.null_or_nonneg("has_nonneg_amount", "amount_dec")
    return all_changes(spark, sf).select("source_lsn", "cdc_operation", r.flag().alias(r.name))


@query("rule_implication")
def q_rule_implication(spark, sf):
    """A final order must carry an escalation priority (urgent / high)."""
    o = fx.read(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").alias("is_final"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderpriority")).alias("escalation"))
    r = Q.implication("has_valid_final", "is_final", "escalation")
    return o.select("o_orderkey", "is_final", r.flag().alias(r.name))


@query("rule_distinct_pair")
def q_rule_distinct_pair(spark, sf):
    """Each line ships between two different nations (customer vs supplier)."""
    li = fx.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = fx.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = fx.read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("origin_nation"))
    s = fx.read(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("destination_nation"))
    # the small tables meet first, so the lines are joined twice, not three times
    origin = o.join(c, o.o_custkey == c.c_custkey, "left").select("o_orderkey", "origin_nation")
    x = li.join(origin, li.l_orderkey == F.col("o_orderkey"), "left").join(s, li.l_suppkey == s.s_suppkey, "left")
    r = Q.distinct_pair("has_distinct_nations", "origin_nation", "destination_nation")
    return x.select("l_orderkey", "l_linenumber", r.flag().alias(r.name))


@query("ledger_quality_split")
def q_ledger_quality_split(spark, sf):
    valid, _ = Q.split(checked_ledger(spark, sf))
    return valid.select("source_lsn", "entity_id", "status", "amount", "source_ts_ms")


@query("quarantine_reason")
def q_quarantine_reason(spark, sf):
    _, quarantine = Q.split(checked_ledger(spark, sf))
    return quarantine.select("source_lsn", "quarantine_reason", "failed_rules")


@query("silver_referential_split")
def q_silver_referential_split(spark, sf):
    """Orders split by their rules and by whether their customer is in the
    dimension source (accounts in debit are missing there)."""
    o = fx.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    o, known = Q.exists_in(o, "o_custkey", fx.active_customers(spark, sf), "c_custkey", "has_customer")
    checked = Q.check(o, [Q.accepted_values("has_final_status", "o_orderstatus", ["F", "O"]), known])
    return checked.select("o_orderkey", "_valid", "quarantine_reason", "failed_rules")


@query("dim_key_stability")
def q_dim_key_stability(spark, sf):
    """Customer keys over two loads: the odd customers first, then all;
    first keys stay, new ones follow in business-key order."""
    c = fx.read(spark, sf, "customer").select("c_custkey", "c_name")
    first = dims.kept_key(c.filter(F.col("c_custkey") % 2 == 1), ["c_custkey"], "customer_key")
    return dims.kept_key(c, ["c_custkey"], "customer_key", first).select("c_custkey", "c_name", "customer_key")


@query("quality_reconcile")
def q_quality_reconcile(spark, sf):
    """valid + quarantine = input, checked on stored data: the ledger is
    materialised once (checkpoint), so the three sides are scans of it
    rather than three re-parses of the log."""
    from keelson.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    led = ledger(spark, sf).checkpoint(eager=True)
    valid, quarantine = Q.split(Q.check(led, fx.EVENTS_SPEC.rules))
    return Q.reconcile(led, valid.select(*led.columns), quarantine.select(*led.columns))


@query("stamp_processed_at")
def q_stamp_processed_at(spark, sf):
    valid, _ = Q.split(checked_ledger(spark, sf))
    return valid.select("source_lsn", F.lit(AS_OF_PROCESSED).cast("timestamp_ntz").alias("_silver_processed_at"))


@query("stage_row_counts")
def q_stage_row_counts(spark, sf):
    """Row count per pipeline stage from one pass: each stage carries an
    ``observe`` and a single action over the last stage fills them all (the
    reference counts each stage with its own job)."""
    spec = fx.EVENTS_SPEC
    raw, o_raw = Q.observe_counts(fx.cdc_raw(spark, sf), "raw_messages", {})
    b, o_b = Q.observe_counts(cdc.parse_envelope(raw, spec), "bronze_rows", {})
    led, o_led = Q.observe_counts(cdc.dedupe_changes(b, spec), "changes", {})
    cur, o_cur = Q.observe_counts(cdc.current_state(led, spec), "current_state", {})
    chk, o_chk = Q.observe_counts(Q.check(cur, spec.rules), "checked", {"valid": F.col("_valid")})
    chk.write.format("noop").mode("overwrite").save()
    rows = [("raw_messages", o_raw.get["rows"]), ("bronze_rows", o_b.get["rows"]),
            ("changes", o_led.get["rows"]), ("current_state", o_cur.get["rows"]),
            ("silver_valid", o_chk.get["valid"]), ("quarantine", o_chk.get["rows"] - o_chk.get["valid"])]
    return spark.createDataFrame(rows, "stage string, n_rows bigint")


# --------------------------------------------------------- dimensions ----

@query("dim_date")
def q_dim_date(spark, sf):
    """Calendar over the order-date span of the data."""
    bounds = fx.read(spark, sf, "orders").agg(F.min("o_orderdate").alias("start"),
                                              F.max("o_orderdate").alias("end"))
    return dims.calendar_from_bounds(bounds)


@query("dim_surrogate_key")
def q_dim_surrogate_key(spark, sf):
    return dim_customer(spark, sf)


def dim_nation(spark, sf) -> DataFrame:
    return dims.dense_key(fx.read(spark, sf, "nation"), ["n_nationkey"], "nation_key")


@query("dim_enriched")
def q_dim_enriched(spark, sf):
    """nation enriched with its region (one region row per key enforced)."""
    n = fx.read(spark, sf, "nation")
    r = fx.read(spark, sf, "region")
    e = dims.enrich(n, r, "n_regionkey", "r_regionkey", ["r_name"])
    return dims.dense_key(e, ["n_nationkey"], "nation_key").select(
        "nation_key", "n_nationkey", "n_name", "n_regionkey", "r_name")


@query("dim_renamed_key")
def q_dim_renamed_key(spark, sf):
    return dims.rename_key(fx.read(spark, sf, "region"), "r_regionkey", "region_key")


@fx.memo
def dim_supplier(spark, sf) -> DataFrame:
    s = fx.read(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = fx.read(spark, sf, "nation").select("n_nationkey", "n_name")
    return dims.enrich(s, n, "s_nationkey", "n_nationkey", ["n_name"])


@query("dim_denormalized")
def q_dim_denormalized(spark, sf):
    return dim_supplier(spark, sf).select("s_suppkey", "s_name", "s_acctbal", "s_nationkey", "n_name")


@query("dim_scd2")
def q_dim_scd2(spark, sf):
    """Status history per entity from every change; a delete closes it."""
    v = all_changes(spark, sf).select("entity_id", "status", "source_ts_ms", "source_lsn", "cdc_operation")
    h = dims.scd2(v, ["entity_id"], "source_ts_ms", ["status"], tie=["source_lsn"], deleted=F.col("cdc_operation") == "d")
    return h.select("entity_id", "status", "source_lsn", "valid_from", "valid_to", "is_current")


@query("dim_scd2_incremental")
def q_dim_scd2_incremental(spark, sf):
    """The same history from three loads out of order: the odd log positions
    of the second half, then the first half, then the rest, each merged into
    the touched buckets only."""
    from keelson.session import scratch_path
    v = all_changes(spark, sf).select("entity_id", "status", "source_ts_ms", "source_lsn", "cdc_operation")
    late = F.col("kafka_ts") >= F.lit(UPSERT_CUTOFF).cast("timestamp_ntz")
    v = v.withColumn("kafka_ts", F.timestamp_millis("source_ts_ms").cast("timestamp_ntz"))
    odd = F.col("source_lsn") % 2 == 1
    root = scratch_path(spark, "scd2")
    for load in (v.filter(late & odd), v.filter(~late), v.filter(late & ~odd)):
        dims.scd2_merge(spark, root, load, ["entity_id"], "source_ts_ms", ["status"], tie=["source_lsn"],
                        deleted=F.col("cdc_operation") == "d", buckets=8)
    h = dims.scd2_read(spark, root, "source_ts_ms")
    return h.select("entity_id", "status", "source_lsn", "valid_from", "valid_to", "is_current")


# -------------------------------------------------------------- facts ----

@query("fact_as_of_version")
def q_fact_as_of_version(spark, sf):
    """Each event's entity with the status that was valid six hours before it."""
    ev = fx.read(spark, sf, "events").select("event_id", "user_id", (epoch_ms("ts") - 6 * 3_600_000).alias("as_of_ms"))
    history = q_dim_scd2(spark, sf).select("entity_id", "status", F.col("source_lsn").alias("version_lsn"), "valid_from", "valid_to")
    return facts.lookup_version(ev, history, "user_id", "as_of_ms", "entity_id", ["status", "version_lsn"], width=7 * 86_400_000)


@query("fact_unmatched_keys")
def q_fact_unmatched_keys(spark, sf):
    # a dimension with a gap: accounts in debit are missing
    dim = dims.hashed_key(fx.active_customers(spark, sf).select("c_custkey"), ["c_custkey"], "customer_key")
    orders = fx.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return facts.unmatched_report(facts.lookup_key(orders, dim, "o_custkey", "c_custkey", "customer_key"), "customer_key")


@query("fact_role_playing")
def q_fact_role_playing(spark, sf):
    """Line fact with the nation dimension in two roles (customer nation =
    origin, supplier nation = destination) and supplier attributes."""
    li = fx.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = fx.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = fx.read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = dim_supplier(spark, sf).select("s_suppkey", F.col("s_name").alias("supplier_name"), "s_nationkey")
    dn = dim_nation(spark, sf).select("n_nationkey", "nation_key")
    # each role is resolved on the small side; the lines are joined twice
    origin = facts.lookup_key(o.join(c, o.o_custkey == c.c_custkey, "left"), dn, "c_nationkey", "n_nationkey", "nation_key",
                              out="origin_nation_key").select("o_orderkey", "origin_nation_key")
    destination = facts.lookup_key(s, dn, "s_nationkey", "n_nationkey", "nation_key", out="destination_nation_key") \
        .select("s_suppkey", "supplier_name", "destination_nation_key")
    x = (li.join(origin, li.l_orderkey == F.col("o_orderkey"), "left")
         .join(destination, li.l_suppkey == F.col("s_suppkey"), "left"))
    return x.select("l_orderkey", "l_linenumber", "origin_nation_key", "destination_nation_key",
                    "supplier_name")


@query("fact_ledger")
def q_fact_ledger(spark, sf):
    valid, _ = Q.split(checked_ledger(spark, sf))
    return valid.select(F.col("source_lsn").alias("transaction_id"), "entity_id", "status",
                        "amount_dec", "source_ts_ms")


# ------------------------------------------------------------ rollups ----

AS_OF_SCHEDULE = "1998-08-02"
AS_OF_AGE = "2002-01-01"
UPSERT_CUTOFF = "2024-01-15 00:00:00"


@query("cross_domain_lookup")
def q_cross_domain_lookup(spark, sf):
    """Customers referenced from another system by a string id: orders are
    counted per customer first, then matched on the id cast to string, in
    customer-id order."""
    refs = fx.read(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("customer_ref"), "c_name")
    per = fx.read(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    j = refs.join(per, F.col("customer_ref") == F.col("o_custkey").cast("string"), "left")
    return (j.select("customer_ref", "c_name", F.coalesce("n_orders", F.lit(0)).cast("bigint").alias("n_orders"))
            .orderBy("customer_ref"))


@query("referential_orphans")
def q_referential_orphans(spark, sf):
    o = fx.read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return facts.orphans(o, fx.active_customers(spark, sf), "o_custkey", "c_custkey")


def cancelled_orders(spark, sf) -> DataFrame:
    """Orders in status P stand for cancelled bookings."""
    return fx.read(spark, sf, "orders").filter(F.col("o_orderstatus") == "P")


@query("cascade_semi_join")
def q_cascade_semi_join(spark, sf):
    """Lines (tickets) of cancelled orders (bookings) become CANCELLED."""
    li = fx.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    flagged = R.flag_from_events(li, "l_orderkey", cancelled_orders(spark, sf), "o_orderkey",
                                 F.lit(True), "__cancelled")
    return flagged.select("l_orderkey", "l_linenumber",
                          F.when(F.col("__cancelled"), "CANCELLED").otherwise("ISSUED").alias("ticket_status"))


@query("cascade_references")
def q_cascade_references(spark, sf):
    """Everything that hangs on one region, along all references: nations,
    customers and suppliers, orders, lines (reached on two ways)."""
    t = lambda name, *cols: fx.read(spark, sf, name).select(*cols)
    line = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id")
    tables = {"nation": (t("nation", "n_nationkey", "n_regionkey"), "n_nationkey"), "customer": (t("customer", "c_custkey", "c_nationkey"), "c_custkey"),
              "supplier": (t("supplier", "s_suppkey", "s_nationkey"), "s_suppkey"), "orders": (t("orders", "o_orderkey", "o_custkey"), "o_orderkey"),
              "lineitem": (t("lineitem", line, "l_orderkey", "l_suppkey"), "line_id")}
    references = [("nation", "n_regionkey", "region"), ("customer", "c_nationkey", "nation"), ("supplier", "s_nationkey", "nation"),
                  ("orders", "o_custkey", "customer"), ("lineitem", "l_orderkey", "orders"), ("lineitem", "l_suppkey", "supplier")]
    region = fx.read(spark, sf, "region").filter("r_regionkey = 0").select("r_regionkey")
    return R.cascade(tables, references, "region", region)


@query("refund_candidates")
def q_refund_candidates(spark, sf):
    """Cancelled orders with their lines as payments; processed time only
    for processed refunds."""
    c = cancelled_orders(spark, sf).select("o_orderkey")
    li = fx.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice",
                                               "l_returnflag", "l_shipdate")
    j = c.join(li, c.o_orderkey == li.l_orderkey)
    status = F.when(F.col("l_returnflag") == "R", "PROCESSED").otherwise("PENDING")
    return j.select("o_orderkey", "l_linenumber", R.dec("l_extendedprice").alias("refund_amount"),
                    status.alias("refund_status"),
                    F.when(status == "PROCESSED", F.col("l_shipdate")).alias("processed_at"))


@query("lookup_pick_one")
def q_lookup_pick_one(spark, sf):
    """Each customer gets one supplier of its nation: the lowest key."""
    s = fx.read(spark, sf, "supplier").select("s_nationkey", "s_suppkey", "s_name")
    gate = R.pick_one(s, "s_nationkey", ["s_suppkey"], ["s_suppkey", "s_name"])
    c = fx.read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    j = c.join(gate, c.c_nationkey == gate.s_nationkey, "left")
    return j.select("c_custkey", F.col("s_suppkey").alias("gate_suppkey"), F.col("s_name").alias("gate_name"))


def line_amount() -> "F.Column":
    return (R.dec("l_extendedprice", 12, 2) * (F.lit(1) - R.dec("l_discount", 4, 2))
            * (F.lit(1) + R.dec("l_tax", 4, 2)))


@query("header_rollup")
def q_header_rollup(spark, sf):
    li = fx.read(spark, sf, "lineitem")
    o = fx.read(spark, sf, "orders")
    return R.header_rollup(li, o, "l_orderkey", "o_orderkey", line_amount(), F.col("o_totalprice")).select(
        "o_orderkey", "n_items", "items_total", "header_total", "total_matches")


def event_ledger(spark, sf) -> DataFrame:
    """events as a points ledger: purchases earn, clicks redeem."""
    return fx.read(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type", R.dec("value", 12, 2).alias("points"))


@query("ledger_balance")
def q_ledger_balance(spark, sf):
    return R.ledger_balance(event_ledger(spark, sf), "user_id", "event_type", F.col("points"),
                            ["purchase"], ["click"])


@query("ledger_running_balance")
def q_ledger_running_balance(spark, sf):
    led = event_ledger(spark, sf)
    signed = (F.when(F.col("event_type") == "purchase", F.col("points"))
              .when(F.col("event_type") == "click", -F.col("points")).otherwise(F.lit(0)))
    rb = R.running_balance(led, "user_id", ["ts", "event_id"], signed)
    return rb.select("event_id", "user_id", F.col("running_balance").cast("decimal(18,2)").alias("running_balance"),
                     (F.col("running_balance") < 0).alias("is_overdrawn"))


@query("ledger_refusals")
def q_ledger_refusals(spark, sf):
    """Redemptions (clicks) above the points available at that moment do not
    happen; earned points come from purchases."""
    signed = (F.when(F.col("event_type") == "purchase", F.col("points"))
              .when(F.col("event_type") == "click", -F.col("points")).otherwise(F.lit(0)))
    done = ledger_op.settle(event_ledger(spark, sf), "user_id", ["ts", "event_id"], signed)
    return done.select("event_id", "user_id", "event_type", "points", "accepted", F.col("balance").alias("available"))


def customer_miles(spark, sf) -> DataFrame:
    """Miles = whole hundreds of order value per customer (0 without orders)."""
    per = (fx.read(spark, sf, "orders").groupBy("o_custkey")
           .agg(F.sum(R.dec("o_totalprice")).alias("__spend")))
    c = fx.read(spark, sf, "customer").select("c_custkey")
    j = c.join(per, c.c_custkey == per.o_custkey, "left")
    return j.select("c_custkey", F.floor(F.coalesce("__spend", F.lit(0)) / 100).cast("bigint").alias("miles"))


@query("tier_assignment")
def q_tier_assignment(spark, sf):
    t = R.assign_tier(customer_miles(spark, sf), "miles", fx.tiers_df(spark))
    return t.select("c_custkey", "miles", "tier_id", "tier_name")


@query("tier_distribution")
def q_tier_distribution(spark, sf):
    t = R.assign_tier(customer_miles(spark, sf), "miles", fx.tiers_df(spark))
    return t.groupBy("tier_name").agg(F.count(F.lit(1)).alias("n_members"))


EVENT_TYPES = ["signup", "view", "click", "purchase", "error"]


@query("status_counts")
def q_status_counts(spark, sf):
    ev = fx.read(spark, sf, "events")
    return R.last_status_counts(ev, "user_id", ["ts", "event_id"], "event_type", EVENT_TYPES)


# Transitions allowed between event types (first event: signup).
ALLOWED_TRANSITIONS = [(None, "signup"), ("signup", "view"), ("view", "view"), ("view", "click"),
                       ("click", "view"), ("click", "purchase"), ("purchase", "view")]


@query("status_transitions")
def q_status_transitions(spark, sf):
    ev = fx.read(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    tr = R.transitions(ev, "user_id", ["ts", "event_id"], "event_type")
    allowed = spark.createDataFrame(ALLOWED_TRANSITIONS, "from_status string, to_status string")
    return R.transition_counts(tr, allowed)


@query("lifecycle_paths")
def q_lifecycle_paths(spark, sf):
    """Each user's events against the allowed steps: an illegal one is
    ignored, so the state goes on from the last legal event."""
    ev = fx.read(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    walked = lifecycle.walk(ev, "user_id", ["ts", "event_id"], "event_type", ALLOWED_TRANSITIONS)
    return lifecycle.summary(walked, "user_id", ["ts", "event_id"], "event_id")


def schedules(spark, sf) -> DataFrame:
    """Suppliers as recurring schedules: code by nation, operating days and
    departure / arrival minute derived from the key."""
    s = fx.read(spark, sf, "supplier")
    k = F.col("s_suppkey")
    days = (F.when(k % 3 == 0, "MON,WED,FRI").when(k % 3 == 1, "TUE,THU,SAT,SUN")
            .otherwise("MON,TUE,WED,THU,FRI,SAT,SUN"))
    dep = (k * 37) % 1440
    return s.select(k.alias("schedule_id"), F.concat(F.lit("N"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("code"),
                    days.alias("days_of_week"), dep.cast("int").alias("dep_minute"),
                    ((dep + 60 + (k * 11) % 600) % 1440).cast("int").alias("arr_minute"))


@query("schedule_expand")
def q_schedule_expand(spark, sf):
    return R.expand_schedule(schedules(spark, sf), AS_OF_SCHEDULE, 14, 3)


@query("delay_adjusted_times")
def q_delay_adjusted_times(spark, sf):
    flights = R.expand_schedule(schedules(spark, sf), AS_OF_SCHEDULE, 14, 3)
    delays = (fx.read(spark, sf, "lineitem")
              .groupBy(F.col("l_suppkey").alias("schedule_id"), F.to_date("l_shipdate").alias("flight_date"))
              .agg(F.max("l_quantity").cast("int").alias("delay_minutes")))
    return R.apply_delays(flights, delays, ["schedule_id", "flight_date"]).select(
        "flight_id", "delay_minutes", "actual_departure", "actual_arrival")


@query("usage_due_events")
def q_usage_due_events(spark, sf):
    usage = (fx.read(spark, sf, "lineitem").groupBy("l_partkey")
             .agg((F.sum("l_quantity").cast("bigint") * 10).alias("total_hours"),
                  (F.count(F.lit(1)) * 20).alias("total_cycles")))
    p = fx.read(spark, sf, "part").select("p_partkey", (F.col("p_size") % 4).alias("model_id"))
    u = usage.join(p, usage.l_partkey == p.p_partkey)
    due = R.usage_due(u, fx.maintenance_schedules_df(spark), "model_id", "total_hours", "total_cycles", max_occurrences=5)
    return due.select("p_partkey", "maintenance_type", "occurrence")


@query("flag_from_events")
def q_flag_from_events(spark, sf):
    """Customers with a critical error event (value > 400) are flagged."""
    c = fx.read(spark, sf, "customer").select("c_custkey")
    ev = fx.read(spark, sf, "events")
    return R.flag_from_events(c, "c_custkey", ev, "user_id",
                              (F.col("event_type") == "error") & (F.col("value") > 400), "is_flagged")


@query("hash_sample")
def q_hash_sample(spark, sf):
    return R.hash_sample(fx.read(spark, sf, "customer"), "c_custkey", 0.7).select("c_custkey", "c_name")


@query("entity_age")
def q_entity_age(spark, sf):
    o = fx.read(spark, sf, "orders")
    days = F.datediff(F.lit(AS_OF_AGE).cast("date"), F.to_date("o_orderdate"))
    return o.select("o_orderkey", days.alias("age_days"), F.floor(days / 365).cast("int").alias("age_years"))


@query("case_rules")
def q_case_rules(spark, sf):
    """Fare class by size and its rules: refundable, change fee, baggage."""
    p = fx.read(spark, sf, "part")
    code = F.when(F.col("p_size") > 40, "F").when(F.col("p_size") > 25, "J").otherwise("Y")
    x = p.select("p_partkey", code.alias("class_code"))
    # Fare rules per class code (F / J / other).
    return x.select(
        "p_partkey", "class_code",
        (F.col("class_code") == "F").alias("refundable"),
        F.when(F.col("class_code") == "F", 0).when(F.col("class_code") == "J", 5000).otherwise(2000)
        .cast("decimal(10,2)").alias("change_fee"),
        F.when(F.col("class_code") == "F", 40).when(F.col("class_code") == "J", 32).otherwise(23)
        .alias("baggage_allowance_kg"))


# Accepted order statuses and market segments.
ORDER_STATUSES = ["F", "O", "P"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("dq_report")
def q_dq_report(spark, sf):
    o = fx.read(spark, sf, "orders")
    c = fx.read(spark, sf, "customer")
    ro = Q.dq_report(o, "orders", not_null=["o_custkey", "o_orderdate"], unique=["o_orderkey"],
                     accepted={"o_orderstatus": ORDER_STATUSES},
                     relationships={"o_custkey": (fx.active_customers(spark, sf), "c_custkey")})
    rc = Q.dq_report(c, "customer", not_null=["c_name"], unique=["c_custkey"],
                     accepted={"c_mktsegment": SEGMENTS})
    return ro.unionByName(rc)


@query("dq_profile_merged")
def q_dq_profile_merged(spark, sf):
    """A profile stored per day and merged over all days, against the exact
    figures: distinct counts within 5 %."""
    from keelson.session import scratch_path
    ev = fx.read(spark, sf, "events").select("ts", "user_id", "event_type", "value", "props")
    path = scratch_path(spark, "profile")
    Q.profile_by_day(ev, F.to_date("ts"), ["user_id", "event_type", "value", "props"]).write.partitionBy("day").parquet(path)
    got = Q.merge_profiles(spark.read.parquet(path))
    exact = ev.agg(*[F.countDistinct(c).alias(c) for c in ("user_id", "event_type", "value", "props")]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("__c"), F.col(c).alias("__n")) for c in ("user_id", "event_type", "value", "props")])))
    j = got.join(exact, F.col("column_name") == F.col("__c"))
    return j.select("column_name", "n_rows", "n_nulls", (F.abs(F.col("n_distinct") - F.col("__n")) <= 0.05 * F.col("__n")).alias("distinct_ok"))


@query("incremental_upsert")
def q_incremental_upsert(spark, sf):
    """Current state built in two loads into a bucketed state table (changes
    before / after a cutoff; the second load rewrites only the buckets it
    touches) equals the full rebuild (``cdc_current_state_deletes``)."""
    from keelson.operators import incremental as I
    from keelson.session import scratch_path
    ch = raw_changes(spark, sf).drop("_before", "_no_before")
    cut = F.col("kafka_timestamp") < F.lit(UPSERT_CUTOFF).cast("timestamp")
    path = scratch_path(spark, "state")
    I.upsert_table(spark, path, ch.filter(cut), fx.EVENTS_SPEC, buckets=16)
    I.upsert_table(spark, path, ch.filter(~cut), fx.EVENTS_SPEC, buckets=16)
    return I.read_current(spark, path).select(*STATE_COLS)


@query("mart_daily_rollup")
def q_mart_daily_rollup(spark, sf):
    """Orders by year and month with subtotals (rollup) via the calendar."""
    o = fx.read(spark, sf, "orders")
    dd = q_dim_date(spark, sf).select("date_key", "year", "month")
    f = o.select(F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("order_date_key"),
                 R.dec("o_totalprice").alias("price"))
    j = facts.lookup_key(f, dd, "order_date_key", "date_key", "date_key", carry=["year", "month"])
    return (j.rollup("year", "month")
            .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("price").cast("decimal(18,2)").alias("total_price")))


@query("mart_month_end_balance")
def q_mart_month_end_balance(spark, sf):
    """Order value per customer, carried to every month end, summed by nation."""
    o = fx.read(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    until = F.lit("1998-12-31")
    ends = R.period_end_balance(o, "o_custkey", "o_orderdate", R.dec("o_totalprice"), until)
    c = fx.read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    j = ends.join(c, ends.o_custkey == c.c_custkey)
    return j.groupBy("c_nationkey", "period_end").agg(F.count(F.lit(1)).alias("n_accounts"), F.sum("balance").cast("decimal(18,2)").alias("balance"))


@query("fact_bucketed_join")
def q_fact_bucketed_join(spark, sf):
    """Lines with their order's customer from two tables cut by the same key:
    no shuffle on either side."""
    import uuid

    from keelson.session import scratch_path
    from keelson.sinks import tables as sinks
    li = fx.read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_suppkey")
    o = fx.read(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    n, tag = sinks.buckets_for(li.count()), uuid.uuid4().hex[:8]
    sinks.save_bucketed(li, f"lines_{tag}", scratch_path(spark, "lines"), ["orderkey"], n)
    sinks.save_bucketed(o, f"orders_{tag}", scratch_path(spark, "orders"), ["orderkey"], n)
    return spark.table(f"lines_{tag}").join(spark.table(f"orders_{tag}").hint("merge"), "orderkey", "left")


# Streaming queries register themselves on import.
from keelson.plans import streams as _streams  # noqa: E402,F401


# -------------------------------------------------------- end to end ----

@query("end_to_end_star")
def q_end_to_end_star(spark, sf):
    """ingest -> refine -> publish: the fact of current, valid entities with
    the customer surrogate key."""
    from keelson.plans import layers as P
    checked = P.refine(P.ingest(fx.cdc_raw(spark, sf), fx.EVENTS_SPEC, dedupe=False), fx.EVENTS_SPEC)
    valid, _ = Q.split(checked)
    fact = P.publish(valid, dim_customer(spark, sf), "entity_id", "c_custkey", "customer_key")
    return fact.select("entity_id", "customer_key", "status", "amount_dec", "source_ts_ms")


@query("table_atomic_replace")
def q_table_atomic_replace(spark, sf):
    """Silver and Quarantine replaced together: a reader opened before the
    second write keeps what it saw, one opened after it sees the new rows on
    both sides; the old folder goes with ``expire``."""
    from keelson.session import scratch_path
    from keelson.sinks import versioned
    root = scratch_path(spark, "atomic")
    o = fx.read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    checked = Q.check(o, [Q.accepted_values("has_final_status", "o_orderstatus", ["F", "O"])])
    versioned.replace_split(checked.filter(F.col("o_orderstatus") != "F"), root)
    before = versioned.read_split(spark, root, True).agg(F.count(F.lit(1)).alias("n")).checkpoint()
    versioned.replace_split(checked, root)
    versioned.expire(spark, root)
    side = lambda valid: (versioned.read_split(spark, root, valid).groupBy("o_orderstatus")
                          .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("side", F.lit("valid" if valid else "quarantine")))
    old = before.select(F.lit(None).cast("string").alias("o_orderstatus"), F.col("n").alias("n_rows"), F.lit("valid before").alias("side"))
    return side(True).unionByName(side(False)).unionByName(old)


@query("table_overwrite_roundtrip")
def q_table_overwrite_roundtrip(spark, sf):
    """Overwrite a table and read it back through the format: only the
    second content is visible."""
    from keelson.session import scratch_path
    from keelson.sinks import tables as sinks
    path = scratch_path(spark, "roundtrip")
    o = fx.read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    sinks.overwrite(o, path)
    sinks.overwrite(o.filter(F.col("o_orderstatus") == "F"), path)
    return sinks.read(spark, path)
