"""The source project's jobs, composed from the library's operators.

* ``bronze_query``   change stream -> Bronze table (one per table spec)
* ``silver``         Bronze -> current state (not for ledgers) -> rules ->
                     (valid, quarantine)
* ``build_dim_*`` / ``build_fact_*``  the Gold star schema
* ``run_gold``       dimensions before facts, aircraft after its model

Every function is ``DataFrame -> DataFrame``; callers choose where tables
live and in which format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators import cdc, dims, facts
from keelson.operators import quality as Q
from keelson.plans.presets import LEDGERS
from keelson.spec import TableSpec
from keelson.streaming import ingest, runner


def bronze_query(raw_stream: DataFrame, spec: TableSpec, path: str, checkpoint: str,
                 trigger: dict | None = None, dedupe: str | None = "change", watermark: str = "10 minutes",
                 state_partitions: int | None = None, partition_by_date: bool = True,
                 keep_deletes: bool = True):
    """Start the Bronze ingest of one table (production trigger:
    ``{"processingTime": "10 seconds"}``; default ``availableNow``).
    ``state_partitions`` sizes the dedupe state store at the first start
    (the checkpoint pins it afterwards).  Bronze is partitioned by
    ``ingest_date`` (UTC date of the transport time), so incremental
    Silver runs read only the days they need.  Deletes are kept (key from
    the before image) so the current state can drop deleted keys."""
    b = ingest.bronze_stream(raw_stream, spec, watermark=watermark, dedupe=dedupe, keep_deletes=keep_deletes)
    parts = None
    if partition_by_date:
        b = b.withColumn("ingest_date", F.to_date(F.col("kafka_timestamp")))
        parts = ["ingest_date"]
    return runner.start_file_sink(b, path, checkpoint, trigger=trigger, name=f"bronze_{spec.name}",
                                  state_partitions=state_partitions, partition_by=parts)


def start_bronze_queries(sources: dict, specs: dict, base_path: str, checkpoint_base: str,
                         trigger: dict | None = None, dedupe: str | None = "change",
                         state_partitions: int | None = None) -> dict:
    """One independent Bronze query per table (each with its own sink and
    checkpoint): ``sources[name]`` is that table's change stream."""
    return {name: bronze_query(src, specs[name], f"{base_path}/bronze_{name}", f"{checkpoint_base}/{name}",
                               trigger=trigger, dedupe=dedupe, state_partitions=state_partitions)
            for name, src in sources.items()}


def silver(bronze: DataFrame, spec: TableSpec, as_of: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Silver and Quarantine of one table.  Silver = business columns +
    ``source_ts_ms`` + ``_silver_processed_at``; Quarantine = every Bronze
    column + rule flags + ``quarantine_reason`` + ``failed_rules`` +
    ``_silver_processed_at``.  ``as_of`` fixes the processing stamp."""
    return split_checked(checked_state(bronze, spec), spec, as_of)


def checked_state(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows Silver starts from, with rule flags: what stands of a ledger
    after deletes, else the current state."""
    state = cdc.ledger_rows(bronze, spec) if spec.name in LEDGERS else cdc.current_state_with_deletes(bronze, spec)
    return Q.check(state, spec.rules)


def split_checked(checked: DataFrame, spec: TableSpec, as_of: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Silver and Quarantine of checked rows."""
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    valid, quarantine = Q.split(checked)
    silver_df = valid.select(*spec.row_fields, "source_ts_ms", stamp.alias("_silver_processed_at"))
    quarantine_df = quarantine.drop("_valid").withColumn("_silver_processed_at", stamp)
    return silver_df, quarantine_df


def silver_incremental(spark: SparkSession, bronze: DataFrame, spec: TableSpec, state_path: str,
                       silver_path: str, buckets: int = 64, as_of: str | None = None,
                       fmt: str = "parquet") -> list[int]:
    """Incremental Silver: merge only the new Bronze rows (e.g. the
    ``ingest_date`` partitions since the last run) into the bucketed
    current-state table, then recompute rules for the touched key buckets
    and rewrite just those buckets of the Silver table.

    The Silver table holds every current key of a bucket with ``_status``
    = valid / quarantine / deleted (deleted keys stay as tombstones, so a
    touched bucket always has rows and is replaced whole by the dynamic
    partition overwrite).  ``read_silver`` / ``read_quarantine`` give the
    two views.  Returns the rewritten buckets."""
    from keelson.operators import incremental as I
    helpers = [c for c in ("_before", "_no_before", "ingest_date") if c in bronze.columns]
    touched = I.upsert_table(spark, state_path, bronze.drop(*helpers), spec, buckets=buckets, fmt=fmt)
    if not touched:
        return []
    state = spark.read.format(fmt).load(state_path).filter(F.col(I.BUCKET).isin(touched))
    checked = Q.check(state, spec.rules)
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    status = (F.when(F.col("cdc_operation") == "d", "deleted")
              .when(F.col("_valid"), "valid").otherwise("quarantine"))
    out = checked.withColumn("_status", status).withColumn("_silver_processed_at", stamp).drop("_valid")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(fmt).partitionBy(I.BUCKET).save(silver_path))
    return touched


def read_silver(spark: SparkSession, silver_path: str, spec: TableSpec, fmt: str = "parquet") -> DataFrame:
    t = spark.read.format(fmt).load(silver_path).filter(F.col("_status") == "valid")
    return t.select(*spec.row_fields, "source_ts_ms", "_silver_processed_at")


def read_quarantine(spark: SparkSession, silver_path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(silver_path).filter(F.col("_status") == "quarantine")


def fact_incremental(spark: SparkSession, silver_path: str, touched: list[int], build, fact_path: str,
                     fmt: str = "parquet") -> None:
    """Rebuild the fact for the touched key buckets only.  ``build(silver,
    carry)`` is one of the ``build_fact_*`` builders (dimensions bound);
    it runs on every Silver row of those buckets with ``_status`` and the
    bucket carried, so a touched bucket always has rows and the dynamic
    partition overwrite replaces it whole.  ``read_fact`` keeps the valid
    rows."""
    from keelson.operators.incremental import BUCKET
    if not touched:
        return
    s = spark.read.format(fmt).load(silver_path).filter(F.col(BUCKET).isin(touched))
    f = build(s, ("_status", BUCKET))
    (f.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(fmt).partitionBy(BUCKET).save(fact_path))


def read_fact(spark: SparkSession, fact_path: str, fmt: str = "parquet") -> DataFrame:
    from keelson.operators.incremental import BUCKET
    return spark.read.format(fmt).load(fact_path).filter(F.col("_status") == "valid").drop("_status", BUCKET)


def dq_job(table: str, df: DataFrame, read) -> DataFrame:
    """Data-quality report of one captured table against its source
    constraints (``presets.DQ_TESTS``); ``read(name)`` returns the
    reference tables the relationships point to."""
    from keelson.plans.presets import DQ_TESTS
    t = DQ_TESTS[table]
    rel = {c: (read(parent), pc) for c, (parent, pc) in t.get("relationships", {}).items()}
    return Q.dq_report(df, table, not_null=t.get("not_null", ()), unique=t.get("unique", ()),
                       accepted=t.get("accepted"), relationships=rel)


def build_dim_date(spark: SparkSession, start: str = "2025-01-01", end: str = "2026-12-31") -> DataFrame:
    return dims.calendar(spark, start, end)


def build_dim_airport(airports: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    d = dims.kept_key(airports.select("airport_code", "airport_name", "city", "country", "timezone"),
                       ["airport_code"], "airport_key", previous)
    return d.select("airport_key", "airport_code", "airport_name", "city", "country", "timezone")


def build_dim_customer(customers: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    d = dims.kept_key(customers.select("customer_id", "first_name", "last_name", "email", "nationality",
                                        "date_of_birth"), ["customer_id"], "customer_key", previous)
    return d.select("customer_key", "customer_id", "first_name", "last_name", "email", "nationality",
                    "date_of_birth")


def build_dim_fare_class(fare_classes: DataFrame, fare_rules: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Fare class with its rule; at most one rule row per class (lowest
    rule id) so the dimension stays one row per class."""
    rules = fare_rules.select("fare_class_id", "refundable", "change_fee", "baggage_allowance_kg",
                              *(["fare_rule_id"] if "fare_rule_id" in fare_rules.columns else []))
    tie = ["fare_rule_id"] if "fare_rule_id" in rules.columns else ["change_fee"]
    e = dims.enrich(fare_classes.select("fare_class_id", "class_code", "class_name"), rules,
                    "fare_class_id", "fare_class_id", ["refundable", "change_fee", "baggage_allowance_kg", *tie],
                    tie_break=tie)
    d = dims.kept_key(e, ["fare_class_id"], "fare_class_key", previous)
    return d.select("fare_class_id", "class_code", "class_name", "refundable", "change_fee",
                    "baggage_allowance_kg", "fare_class_key")


def build_dim_aircraft_model(models: DataFrame) -> DataFrame:
    return dims.rename_key(models, "model_id", "aircraft_model_key")


def build_dim_aircraft(silver_aircraft: DataFrame, dim_model: DataFrame) -> DataFrame:
    d = dims.enrich(silver_aircraft, dim_model.select("aircraft_model_key", "model_name", "manufacturer"),
                    "model_id", "aircraft_model_key", ["model_name", "manufacturer"])
    return d.select("aircraft_registration", "model_name", "manufacturer", "total_flight_hours",
                    "total_flight_cycles", "is_grounded", "grounded_reason")


def build_dim_aircraft_history(bronze_aircraft: DataFrame, spec: TableSpec) -> DataFrame:
    """Type-2 aircraft dimension from every captured version: a row per
    change of grounding / usage attributes with validity interval."""
    attrs = ["model_id", "total_flight_hours", "total_flight_cycles", "is_grounded", "grounded_reason"]
    h = dims.scd2(bronze_aircraft, list(spec.key), "source_ts_ms", attrs, tie=["source_lsn", "kafka_timestamp"],
                  deleted=F.col("cdc_operation") == "d")
    return h.select(*spec.key, *attrs, "valid_from", "valid_to", "is_current")


def build_fact_bookings(silver_bookings: DataFrame, dim_customer: DataFrame, carry: tuple = ()) -> DataFrame:
    f = facts.lookup_key(silver_bookings, dim_customer, "customer_id", "customer_id", "customer_key", check=True)
    return f.select("booking_id", "customer_key", "booking_reference", "booking_status", "booking_channel",
                    "currency", "source_ts_ms", *carry)


def build_fact_flight_operations(silver_flights: DataFrame, dim_airport: DataFrame,
                                 dim_aircraft: DataFrame, carry: tuple = ()) -> DataFrame:
    """Airport dimension in two roles; the aircraft dimension contributes its
    model and a matched flag (an aircraft registration missing from the
    dimension is visible instead of silently dropped)."""
    f = facts.lookup_key(silver_flights, dim_airport, "origin_airport", "airport_code", "airport_key",
                         out="origin_airport_key")
    f = facts.lookup_key(f, dim_airport, "destination_airport", "airport_code", "airport_key",
                         out="destination_airport_key")
    ac = dim_aircraft.select(F.col("aircraft_registration").alias("__reg"), F.col("model_name").alias("aircraft_model"),
                             F.lit(True).alias("aircraft_matched"))
    f = f.join(ac, F.col("aircraft_registration") == F.col("__reg"), "left").drop("__reg")
    return f.select("flight_id", "origin_airport_key", "destination_airport_key", "aircraft_registration",
                    "flight_status", "source_ts_ms", "aircraft_model",
                    F.coalesce("aircraft_matched", F.lit(False)).alias("aircraft_matched"), *carry)


def build_fact_loyalty_transactions(silver_loyalty: DataFrame, carry: tuple = ()) -> DataFrame:
    return silver_loyalty.select("transaction_id", "loyalty_account_id", "transaction_type", "miles_amount",
                                 "source_ts_ms", *carry)


def run_silver_all(read_bronze, write, as_of: str | None = None) -> None:
    """Silver and Quarantine of every refined table: ``read_bronze(name)``
    returns that table's Bronze (or None to skip it), ``write(name, df)``
    stores ``silver_<name>`` / ``silver_quarantine_<name>``."""
    from keelson.plans.presets import SPECS
    for name, spec in SPECS.items():
        bronze = read_bronze(name)
        if bronze is None:
            continue
        valid, quarantine = silver(bronze, spec, as_of=as_of)
        write(f"silver_{name}", valid)
        write(f"silver_quarantine_{name}", quarantine)


def run_gold(spark: SparkSession, read, write, previous=lambda name: None) -> None:
    """Dimensions first (aircraft after its model), then facts.  ``read(name)``
    returns a table, ``write(name, df)`` stores one; ``previous(name)`` is a
    dimension as the last run left it (None on the first), whose surrogate
    keys stay."""
    write("dim_date", build_dim_date(spark))
    write("dim_airport", build_dim_airport(read("airports"), previous("dim_airport")))
    write("dim_customer", build_dim_customer(read("customers"), previous("dim_customer")))
    write("dim_fare_class", build_dim_fare_class(read("fare_classes"), read("fare_rules"), previous("dim_fare_class")))
    write("dim_aircraft_model", build_dim_aircraft_model(read("aircraft_models")))
    write("dim_aircraft", build_dim_aircraft(read("silver_aircraft"), read("dim_aircraft_model")))
    write("fact_bookings", build_fact_bookings(read("silver_bookings"), read("dim_customer")))
    write("fact_flight_operations", build_fact_flight_operations(read("silver_flights"), read("dim_airport"),
                                                                 read("dim_aircraft")))
    write("fact_loyalty_transactions", build_fact_loyalty_transactions(read("silver_loyalty_transactions")))
