"""Test inputs derived from the given tables by Spark, so their size grows
with the tables.  Each has an SQL twin in ``oracle`` computing the expected
rows straight from the same tables.

``cdc_raw`` turns ``events`` into a change log as a capture tool would
deliver it (one JSON envelope per change, as Kafka rows):

* key ``entity_id`` = user_id, log position ``lsn`` = event_id,
  commit time ``ts_ms`` = epoch ms of ts, transaction id = event_id div 3
* op: ``c`` for signup, ``d`` for error, ``u`` otherwise
* after image (NULL for deletes): status = event_type (NULL when
  event_id % 13 = 0), amount = value (negated when event_id % 17 = 0),
  amount_dec = the same amount as a base64 decimal, note = props
* before image (NULL for creates): status unchanged when event_id % 3 = 0
  else 'view', amount = value + 1 when event_id % 5 = 0 else value
* dirt: the text is cut in half when event_id % 97 = 0; every change with
  event_id % 10 = 0 is delivered twice
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.exprs import encode_decimal_base64, epoch_ms
from keelson.operators import quality as Q
from keelson.session import ensure_utc, table_path
from keelson.spec import TableSpec

# The status list of the change-log table and the rule reasons.
EVENT_STATUSES = ["signup", "view", "click", "purchase"]

EVENTS_SPEC = TableSpec(
    name="events_cdc",
    key=("entity_id",),
    after_ddl="entity_id bigint, status string, amount double, amount_dec decimal(10,2), note string",
    source_system="shop",
    decimals={"amount_dec": (10, 2)},
    rules=(
        Q.accepted_values("has_valid_status", "status", EVENT_STATUSES),
        Q.positive("has_valid_amount", "amount"),
        Q.required("has_note", "note"),
    ),
)


def memo(fn):
    """Build a lazy DataFrame once per (session, arguments).  Only for frames
    that store nothing while they are built: the plan object is reused
    (DataFrames are immutable) and every action still reads and computes
    from the tables.  Saves the driver-side construction
    (py4j calls, analysis) when many queries share an input."""
    cache: dict = {}

    def wrapper(spark, *args):
        # the entry keeps its session alive, so an id() cannot be recycled
        k = (id(spark), args)
        hit = cache.get(k)
        if hit is None or hit[0] is not spark:
            hit = cache[k] = (spark, fn(spark, *args))
        return hit[1]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


@memo
def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def cdc_image_columns(ev: DataFrame) -> DataFrame:
    """Per event: op, after-image fields and before-image fields."""
    eid = F.col("event_id")
    status = F.when(eid % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type"))
    amount = F.when(eid % 17 == 0, -F.col("value")).otherwise(F.col("value"))
    op = (F.when(F.col("event_type") == "signup", "c")
          .when(F.col("event_type") == "error", "d").otherwise("u"))
    b_status = F.when(eid % 3 == 0, status).otherwise(F.lit("view"))
    b_amount = F.when(eid % 5 == 0, F.col("value") + 1).otherwise(F.col("value"))
    return ev.select(
        "event_id", "ts", "user_id", op.alias("op"),
        status.alias("a_status"), amount.alias("a_amount"), F.col("props").alias("a_note"),
        b_status.alias("b_status"), b_amount.alias("b_amount"))


def envelopes(ev: DataFrame) -> DataFrame:
    """events -> (value string, timestamp timestamp, lsn, copy) change messages."""
    x = cdc_image_columns(ev)
    after = F.struct(F.col("user_id").alias("entity_id"), F.col("a_status").alias("status"),
                     F.col("a_amount").alias("amount"),
                     encode_decimal_base64(F.col("a_amount"), 2).alias("amount_dec"),
                     F.col("a_note").alias("note"))
    before = F.struct(F.col("user_id").alias("entity_id"), F.col("b_status").alias("status"),
                      F.col("b_amount").alias("amount"),
                      encode_decimal_base64(F.col("b_amount"), 2).alias("amount_dec"),
                      F.col("a_note").alias("note"))
    ts_ms = epoch_ms("ts")
    source = F.struct(ts_ms.alias("ts_ms"), F.lit("false").alias("snapshot"), F.lit("shop").alias("db"),
                      F.lit("events").alias("table"), F.floor(F.col("event_id") / 3).cast("bigint").alias("txId"),
                      F.col("event_id").alias("lsn"))
    payload = F.struct(F.when(F.col("op") != "c", before).alias("before"),
                       F.when(F.col("op") != "d", after).alias("after"),
                       source.alias("source"), F.col("op").alias("op"), ts_ms.alias("ts_ms"))
    text = F.to_json(F.struct(payload.alias("payload")))
    msgs = x.select("event_id", "ts", text.alias("__t"))
    half = F.expr("substring(__t, 1, cast(length(__t) / 2 as int))")
    msgs = msgs.select("event_id", "ts",
                       F.when(F.col("event_id") % 97 == 0, half).otherwise(F.col("__t")).alias("value"))
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return msgs.select(F.col("value"), F.col("ts").cast("timestamp").alias("timestamp"),
                       F.col("event_id").alias("lsn"), F.explode(copies).alias("copy"))


@memo
def cdc_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return envelopes(read(spark, sf_dir, "events"))


# Loyalty tier thresholds (name, minimum miles).
TIERS = [("Bronze", 0), ("Silver", 25000), ("Gold", 75000), ("Platinum", 150000)]

# Maintenance check intervals (type, flight hours, flight cycles, calendar days).
MAINTENANCE_TYPES = [("A_CHECK", 600, 400, 60), ("B_CHECK", 2000, 1200, 180),
                     ("C_CHECK", 6000, 4000, 730), ("D_CHECK", 24000, 16000, 2555)]


def tiers_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i + 1, n, m) for i, (n, m) in enumerate(TIERS)], "tier_id int, tier_name string, min_miles int")


def maintenance_schedules_df(spark: SparkSession, n_models: int = 4) -> DataFrame:
    """Every model has every check type (as in the source system)."""
    rows = []
    sid = 1
    for model in range(n_models):
        for t, h, c, d in MAINTENANCE_TYPES:
            rows.append((sid, model, t, h, c, d))
            sid += 1
    return spark.createDataFrame(
        rows, "schedule_id int, model_id int, maintenance_type string, interval_flight_hours int, "
              "interval_flight_cycles int, interval_calendar_days int")


def active_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension source with a gap: accounts in debit (negative
    balance) are not in it, so fact lookups have unmatched keys."""
    return read(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
