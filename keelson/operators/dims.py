"""Dimension builders: calendar, surrogate keys, enrichment, SCD2."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.exprs import date_key
from keelson.session import ensure_checkpoint_dir, shuffle_partitions


def calendar_from_bounds(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Calendar dimension for every day between two dates of a one-row frame.

    ``sequence`` + ``explode``; the row count is the day span (bounded by
    the calendar, not by data volume)."""
    days = bounds.select(F.explode(F.sequence(F.to_date(F.col(start_col)), F.to_date(F.col(end_col)),
                                              F.expr("interval 1 day"))).alias("date"))
    return days.select(
        "date",
        date_key("date").alias("date_key"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.dayofweek("date").alias("day_of_week"),   # 1 = Sunday
        F.quarter("date").alias("quarter"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.date_format("date", "EEEE").alias("day_name"),
    )


def calendar(spark, start: str, end: str) -> DataFrame:
    return calendar_from_bounds(spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end")))


def dense_key(df: DataFrame, key_cols: Sequence[str], name: str, num_partitions: int | None = None) -> DataFrame:
    """Stable dense surrogate key ``0..n-1`` in business-key order, equal to
    ``row_number() over (order by key) - 1`` without a single-partition sort.

    1. Range-partition and sort within partitions by the business key; tag
       each row with its partition and position.  This is written once with
       ``checkpoint()`` (to the shared checkpoint folder): range bounds are
       sampled per exchange, so two branches reading their own exchanges
       could disagree; the checkpoint fixes the tags for both.
    2. Count rows per partition (one row per partition: a proven small
       broadcast), prefix-sum the counts, add each partition's offset to
       the row's position inside its partition.
    The business key must be unique; the result does not depend on the
    partition count.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or shuffle_partitions(spark)
    pos = (df.repartitionByRange(n, *key_cols).sortWithinPartitions(*key_cols)
           .withColumn("__pid", F.spark_partition_id())
           .withColumn("__pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
           .checkpoint(eager=True))
    counts = pos.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__pid",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__off"))
    return (pos.join(F.broadcast(offsets), "__pid")
            .withColumn(name, (F.col("__off") + F.col("__pos")).cast("bigint"))
            .drop("__pid", "__pos", "__off"))


def hashed_key(df: DataFrame, key_cols: Sequence[str], name: str) -> DataFrame:
    """Surrogate key as a 64-bit hash of the business key: no shuffle, stable
    across runs and partitionings (collisions possible at ~2^32 keys)."""
    return df.withColumn(name, F.xxhash64(*[F.col(c) for c in key_cols]))


def assign_keys(df: DataFrame, key_map: DataFrame, key_cols: Sequence[str], name: str) -> DataFrame:
    """Keep surrogate keys across runs: keys already in ``key_map``
    (business key + ``name``) are reused, new business keys get dense keys
    from max + 1 on, in business-key order.  Only the scalar max key of the
    map reaches the driver."""
    known = df.join(key_map.select(*key_cols, name), list(key_cols), "left")
    old = known.filter(F.col(name).isNotNull())
    top = key_map.agg(F.max(name)).first()[0]
    base = 0 if top is None else int(top) + 1
    new = dense_key(known.filter(F.col(name).isNull()).drop(name), key_cols, "__new")
    new = new.withColumn(name, (F.lit(base) + F.col("__new")).cast("bigint")).drop("__new")
    return old.unionByName(new)


def kept_key(df: DataFrame, key_cols: Sequence[str], name: str, previous: DataFrame | None = None) -> DataFrame:
    """Dense surrogate keys that do not move between runs: those of the
    ``previous`` dimension stay, new business keys follow.  The previous
    keys are checkpointed first, so the result may overwrite that table."""
    if previous is None:
        return dense_key(df, key_cols, name)
    ensure_checkpoint_dir(df.sparkSession)
    return assign_keys(df, previous.select(*key_cols, name).checkpoint(), key_cols, name)


def one_per_key(df: DataFrame, key: str, tie_break: Sequence[str]) -> DataFrame:
    """At most one row per key: the row with the smallest ``tie_break`` tuple
    (an aggregate, pre-aggregated map-side)."""
    rest = [c for c in df.columns if c != key]
    return (df.groupBy(key)
            .agg(F.min_by(F.struct(*rest), F.struct(*[F.col(c) for c in tie_break])).alias("__r"))
            .select(key, *[F.col(f"__r.{c}").alias(c) for c in rest]))


def enrich(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
           columns: Sequence[str], tie_break: Sequence[str] | None = None) -> DataFrame:
    """Left join that cannot fan out: the right side is first reduced to
    one row per key (smallest ``tie_break``), then joined.  The reduce
    shuffles the right side on its key, which the join then reuses."""
    r = right.select(right_key, *[c for c in columns if c != right_key])
    r = one_per_key(r, right_key, tie_break or [c for c in columns if c != right_key][:1] or [right_key])
    return left.join(r.withColumnRenamed(right_key, "__rk"), F.col(left_key) == F.col("__rk"), "left").drop("__rk")


def rename_key(df: DataFrame, natural: str, surrogate: str) -> DataFrame:
    return df.withColumnRenamed(natural, surrogate)


def scd2(versions: DataFrame, key: Sequence[str], ts: str, attrs: Sequence[str], tie: Sequence[str] = (),
         skew_safe: bool | str = "auto", deleted: Column | None = None) -> DataFrame:
    """Type-2 history from a stream of versions: a new row whenever the
    attribute hash changes; ``valid_from`` = first version time,
    ``valid_to`` = next change time (NULL while current), ``is_current``.
    Where ``deleted`` holds, the version ends the entity: it closes the open
    row and gives none itself; a later version starts anew.

    Both per-key scans (previous hash, next change time) go through
    ``sequences.keyed_scan``: a key with more than a partition's share of
    the versions is split over many tasks."""
    v = versions.withColumn("__gone", F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False))
    points = _run_starts(v, key, ts, attrs, tie, skew_safe)
    return (points.filter(F.col("__starts") & ~F.col("__gone")).drop("__gone", "__starts").withColumn("valid_from", F.col(ts))
            .withColumn("is_current", F.col("valid_to").isNull()))


def _run_starts(v: DataFrame, key: Sequence[str], ts: str, attrs: Sequence[str], tie: Sequence[str],
                skew_safe: bool | str) -> DataFrame:
    """Versions (with ``__gone``) and ``__starts`` (differs from the version
    before) and, for those, ``valid_to`` (time of the next that starts)."""
    from keelson.operators.sequences import keyed_scan
    order = [ts, *tie]
    image = [F.coalesce(F.col(a).cast("string"), F.lit("\u0000")) for a in attrs]
    h = F.when(F.col("__gone"), F.xxhash64(F.lit("deleted"))).otherwise(F.xxhash64(F.lit("image"), *image))
    prev = keyed_scan(v.withColumn("__h", h), key, order, lag=["__h"], skew_safe=skew_safe)
    prev = prev.withColumn("__starts", F.col("lag___h").isNull() | (F.col("lag___h") != F.col("__h"))).drop("__h", "lag___h")
    starts = keyed_scan(prev.filter("__starts"), key, order, lead=[ts], skew_safe=skew_safe).withColumnRenamed(f"lead_{ts}", "valid_to")
    rest = prev.filter(~F.col("__starts")).withColumn("valid_to", F.lit(None).cast(v.schema[ts].dataType))
    return starts.unionByName(rest.select(*starts.columns))


def scd2_merge(spark, root: str, versions: DataFrame, key: Sequence[str], ts: str, attrs: Sequence[str],
               tie: Sequence[str] = (), deleted: Column | None = None, buckets: int = 64,
               skew_safe: bool | str = "auto") -> list[int]:
    """Merge versions, in any order of arrival, into the stored type-2 history
    at ``root``; returns the key buckets written.

    A late version cuts the row it falls into: the row before it ends where
    it begins, and it ends where the old row or the next version begins.
    That needs the versions that changed nothing too (a later cut may make
    them start a row), so the table keeps every version once, with a mark on
    those that start a row.  Only keys that the load holds are derived
    anew, only buckets they touch are written, and readers switch to them at
    once (``sinks.versioned``).  A version delivered again changes nothing.
    """
    from keelson.sinks import versioned
    keep = list(dict.fromkeys([*key, ts, *tie, *attrs]))
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    load = versions.select(*keep, gone.alias("__gone")).dropDuplicates([*key, ts, *tie])

    def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
        cols = [*keep, "__gone", versioned.BUCKET]
        if old is None:
            return _run_starts(new.select(*cols), key, ts, attrs, tie, skew_safe)
        keys = new.select(*key).distinct()
        # what is stored wins over a version delivered again
        fresh = new.join(old.select(*key, ts, *tie), [*key, ts, *tie], "left_anti")
        redo = old.join(keys, list(key), "left_semi").select(*cols).unionByName(fresh.select(*cols))
        done = _run_starts(redo, key, ts, attrs, tie, skew_safe)
        return done.unionByName(old.join(keys, list(key), "left_anti").select(*done.columns))
    return versioned.merge_buckets(spark, root, load, key, merge, buckets)


def scd2_read(spark, root: str, ts: str) -> DataFrame:
    """The history that ``scd2_merge`` keeps, with the columns of ``scd2``."""
    from keelson.sinks import versioned
    points = versioned.read_buckets(spark, root)
    return (points.filter(F.col("__starts") & ~F.col("__gone")).drop("__gone", "__starts").withColumn("valid_from", F.col(ts))
            .withColumn("is_current", F.col("valid_to").isNull()))
