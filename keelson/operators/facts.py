"""Fact builders: surrogate-key lookups, role-playing dimensions, reports."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lookup_key(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, key: str,
               out: str | None = None, carry: Sequence[str] = (), check: bool = False) -> DataFrame:
    """Left join a fact to a dimension by business key, returning the
    dimension's surrogate key (NULL when unmatched) and optional attributes.

    The dimension must be unique on ``dim_col`` (our dimension builders
    guarantee it); ``check`` makes the job fail when it is not, so a lookup
    can never multiply fact rows.  No hint: Catalyst broadcasts a dimension whose estimated
    size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks
    the real size at run time; larger dimensions take a sort-merge join.
    """
    d = dim.select(F.col(dim_col).alias("__dk"), F.col(key).alias(out or key), *carry)
    if check:
        rest = [c for c in d.columns if c != "__dk"]
        one = d.groupBy("__dk").agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*rest)).alias("__r"))
        sure = F.when((F.col("__n") == 1) | F.col("__dk").isNull(), F.col("__r")).otherwise(
            F.raise_error(F.concat(F.lit(f"dimension key {dim_col} is not unique: "), F.col("__dk").cast("string"))))
        d = one.select("__dk", sure.alias("__r")).select("__dk", *[F.col(f"__r.{c}").alias(c) for c in rest])
    return fact.join(d, F.col(fact_col) == F.col("__dk"), "left").drop("__dk")


def lookup_version(fact: DataFrame, versions: DataFrame, fact_key: str, fact_time: str, key: str,
                   columns: Sequence[str], valid_from: str = "valid_from", valid_to: str = "valid_to",
                   width: int = 30 * 86_400_000) -> DataFrame:
    """Left join each fact to the version of its key that was valid at the
    fact's time: ``valid_from <= time < valid_to`` (NULL: still valid).

    ``columns`` of the version come along, NULL where none was valid (before
    the first version, in a gap after a delete, NULL key or time).  The
    versions of a key must not overlap, as a type-2 history's do not; of
    versions that begin at one time the one that ends last counts.  Times
    are numbers (epoch milliseconds).

    No range join: facts and versions are sorted together per (key, time
    slice of ``width``) and the last version before a fact is the candidate.
    What a slice begins with is the last version of all earlier slices, one
    row per slice, so a key with a large share of the facts is cut along
    time, and nothing but slices is ordered per key.
    """
    names = fact.columns
    cut = F.floor(F.col("__t") / F.lit(width)).cast("long")
    f = fact.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__fact"), F.col(fact_key).alias("__k"), F.col(fact_time).cast("long").alias("__t"))
    known = F.col("__k").isNotNull() & F.col("__t").isNotNull()
    v = versions.select(F.col(key).alias("__k"), F.col(valid_from).cast("long").alias("__t"),
                        F.struct(F.col(valid_to).cast("long").alias("__to"), *[F.col(c) for c in columns]).alias("__v"))
    facts, v = f.where(known).withColumn("__s", cut), v.where(known).withColumn("__s", cut)
    # NULL (still valid) ends last
    rank = F.struct("__t", F.col("__v.__to").isNull().alias("__open"), F.col("__v.__to").alias("__end"))
    last = v.groupBy("__k", "__s").agg(F.max_by("__v", rank).alias("__v"))
    slices = facts.select("__k", "__s").distinct().join(last, ["__k", "__s"], "full")
    before = Window.partitionBy("__k").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn("__v", F.last("__v", ignorenulls=True).over(before)).where("__v is not null")
    none = F.lit(None)
    fact_type, version_type = f.schema["__fact"].dataType, v.schema["__v"].dataType
    both = (carried.select("__k", "__s", none.cast("long").alias("__t"), F.lit(0).alias("__o"), none.cast(fact_type).alias("__fact"), "__v")
            .unionByName(v.select("__k", "__s", "__t", F.lit(1).alias("__o"), none.cast(fact_type).alias("__fact"), "__v"))
            .unionByName(facts.select("__k", "__s", "__t", F.lit(2).alias("__o"), "__fact", none.cast(version_type).alias("__v"))))
    order = [F.col("__t").asc_nulls_first(), F.col("__o"), F.col("__v.__to").asc_nulls_last()]
    upto = Window.partitionBy("__k", "__s").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("__c", F.last("__v", ignorenulls=True).over(upto)).where("__o = 2")
    valid = F.when(F.col("__c.__to").isNull() | (F.col("__t") < F.col("__c.__to")), F.col("__c"))
    out = found.select("__fact", valid.alias("__c")).unionByName(f.where(~known).select("__fact", none.cast(version_type).alias("__c")))
    return out.select("__fact.*", *[F.col(f"__c.`{c}`").alias(c) for c in columns])


def unmatched_report(fact: DataFrame, key: str) -> DataFrame:
    """One row: fact rows and rows whose lookup key is NULL."""
    return fact.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count_if(F.col(key).isNull()).alias("n_unmatched"))


def orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose key has no parent (left anti join)."""
    p = parent.select(F.col(parent_col).alias("__pk"))
    return child.join(p, F.col(child_col) == F.col("__pk"), "left_anti")
