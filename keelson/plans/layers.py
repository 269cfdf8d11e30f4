"""ingest -> refine -> publish, as DataFrame functions with I/O at the edges.

``run_layers`` writes Bronze, Silver + Quarantine (one job, partitioned by
``_valid``), a customer dimension and the fact, in dependency order, and
returns row counts gathered with ``observe`` during the writes (no extra
counting passes)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.exprs import from_epoch_ms
from keelson.operators import cdc, dims, facts
from keelson.operators import quality as Q
from keelson.sinks import tables as sinks
from keelson.spec import TableSpec


def ingest(raw: DataFrame, spec: TableSpec, dedupe: bool = True) -> DataFrame:
    """Bronze: every parsed change (deletes kept, key from before), once
    when ``dedupe`` (for a stored table); a lazy chain that goes straight
    into ``refine`` can skip that shuffle."""
    changes = cdc.parse_changes(raw, spec)
    return cdc.dedupe_changes(changes, spec) if dedupe else changes


def refine(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """Current state (deletes removed) with null-safe rule flags.  Bronze
    may still hold repeated deliveries: ``max_by`` collapses them."""
    return Q.check(cdc.current_state_with_deletes(bronze, spec), spec.rules)


def publish(silver: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, key: str) -> DataFrame:
    return facts.lookup_key(silver, dim, fact_col, dim_col, key)


def run_layers(raw: DataFrame, spec: TableSpec, customers: DataFrame, out: str, fmt: str = "parquet") -> dict:
    spark = raw.sparkSession
    bronze, ob = Q.observe_counts(ingest(raw, spec), "bronze", {})
    sinks.overwrite(bronze.drop("_before"), f"{out}/bronze", fmt)
    checked, oc = Q.observe_counts(refine(sinks.read(spark, f"{out}/bronze", fmt), spec), "silver",
                                   {"valid": F.col("_valid")})
    valid_path, quarantine_path = sinks.write_split(checked, f"{out}/silver", fmt)
    dim = dims.dense_key(customers.select("c_custkey", "c_name"), ["c_custkey"], "customer_key")
    sinks.overwrite(dim, f"{out}/dim_customer", fmt)
    silver = sinks.read(spark, valid_path, fmt)
    fact, of = Q.observe_counts(
        publish(silver, sinks.read(spark, f"{out}/dim_customer", fmt), spec.key[0], "c_custkey", "customer_key"),
        "fact", {"unmatched": F.col("customer_key").isNull()})
    # facts partitioned by month of the change: date filters prune whole folders
    month = F.date_format(from_epoch_ms("source_ts_ms"), "yyyy-MM")
    sinks.overwrite(fact.withColumn("change_month", month), f"{out}/fact", fmt, partition_by=["change_month"],
                    sort_within=[spec.key[0]])
    return {"bronze": ob.get, "silver": oc.get, "fact": of.get}
