"""Per-key ordered scans (lag, lead, running sums) that stay balanced when
one key holds a large share of all rows.

A window ``partitionBy(key).orderBy(ts)`` sends every row of a key to one
task.  Here the rows are range-partitioned on ``(key, order...)`` instead,
so a hot key is cut into consecutive slices over many partitions:

1. ``repartitionByRange(n, key, order...)``; ``__pid`` = the slice number.
2. Local windows per ``(__pid, key)`` (a balanced hash shuffle: no group is
   larger than one range partition) give lag / lead / running sums that
   are right except at slice boundaries.
3. A summary per ``(__pid, key)`` (last row, first row, slice total) is
   reduced per key over ``__pid`` -- at most ``n`` rows for the hottest
   key -- into carries: the previous slice's last row, the next slice's
   first row and the sum of all earlier slices.
4. The carries are joined back on ``(__pid, key)`` and patched into the
   first / last row of each slice.

The range-partitioned rows are written once with ``checkpoint()`` (to the
shared checkpoint folder) before the two branches read them: range bounds
are sampled per exchange, so two exchanges could cut the slices
differently.  The order columns must make the order total (add a unique
id).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.session import ensure_checkpoint_dir, shuffle_partitions


def ordered_scan(df: DataFrame, key: Sequence[str], order: Sequence[str], *,
                 lag: Sequence[str] = (), lead: Sequence[str] = (),
                 running_sum: dict[str, Column] | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """Adds ``lag_<c>`` for ``c`` in ``lag``, ``lead_<c>`` for ``c`` in
    ``lead`` and one column per ``running_sum`` entry (inclusive running sum
    of the expression), all per ``key`` in ``order``."""
    running_sum = running_sum or {}
    if not (lag or lead or running_sum):
        return df
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or shuffle_partitions(spark)
    key, order = list(key), list(order)
    base = df
    # the type a plain window sum has, so both forms return the same schema
    kinds = {name: df.select(F.sum(expr)).schema[0].dataType for name, expr in running_sum.items()}
    for name, expr in running_sum.items():
        base = base.withColumn(f"__m_{name}", expr)
    r = (base.repartitionByRange(n, *key, *order).withColumn("__pid", F.spark_partition_id())
         .checkpoint(eager=True))

    w = Window.partitionBy("__pid", *key).orderBy(*[F.col(c) for c in order])
    loc = r.withColumn("__rn", F.row_number().over(w))
    loc = loc.withColumn("__last", F.lead(F.lit(1)).over(w).isNull())
    for c in lag:
        loc = loc.withColumn(f"__llag_{c}", F.lag(F.col(c)).over(w))
    for c in lead:
        loc = loc.withColumn(f"__llead_{c}", F.lead(F.col(c)).over(w))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for name in running_sum:
        loc = loc.withColumn(f"__lsum_{name}", F.sum(F.col(f"__m_{name}")).over(upto))
        loc = loc.withColumn(f"__lcnt_{name}", F.count(F.col(f"__m_{name}")).over(upto))

    ordering = F.struct(*[F.col(c) for c in order])
    aggs = []
    if lag:
        aggs.append(F.max_by(F.struct(*[F.col(c) for c in lag]), ordering).alias("__lastrow"))
    if lead:
        aggs.append(F.min_by(F.struct(*[F.col(c) for c in lead]), ordering).alias("__firstrow"))
    for name in running_sum:
        aggs.append(F.sum(F.col(f"__m_{name}")).alias(f"__tot_{name}"))
        aggs.append(F.count(F.col(f"__m_{name}")).alias(f"__cnt_{name}"))
    summary = r.groupBy("__pid", *key).agg(*aggs)
    wk = Window.partitionBy(*key).orderBy("__pid")
    carry = summary
    if lag:
        carry = carry.withColumn("__prevlast", F.lag("__lastrow").over(wk))
    if lead:
        carry = carry.withColumn("__nextfirst", F.lead("__firstrow").over(wk))
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    for name in running_sum:
        carry = carry.withColumn(f"__carry_{name}", F.sum(f"__tot_{name}").over(before))
        carry = carry.withColumn(f"__ccnt_{name}", F.coalesce(F.sum(f"__cnt_{name}").over(before), F.lit(0)))
    carry = carry.drop("__lastrow", "__firstrow", *[f"__tot_{n_}" for n_ in running_sum],
                       *[f"__cnt_{n_}" for n_ in running_sum])

    # NULL is a key like any other here: join on null-safe equality
    carry = carry.select(*[F.col(c).alias(f"__ck_{c}") for c in ["__pid", *key]],
                         *[c for c in carry.columns if c not in ("__pid", *key)])
    cond = [F.col(c).eqNullSafe(F.col(f"__ck_{c}")) for c in ["__pid", *key]]
    out = loc.join(carry, cond, "left").drop(*[f"__ck_{c}" for c in ["__pid", *key]])
    for c in lag:
        out = out.withColumn(f"lag_{c}", F.when(F.col("__rn") == 1, F.col("__prevlast")[c])
                             .otherwise(F.col(f"__llag_{c}")))
    for c in lead:
        out = out.withColumn(f"lead_{c}", F.when(F.col("__last"), F.col("__nextfirst")[c])
                             .otherwise(F.col(f"__llead_{c}")))
    for name in running_sum:
        # NULL only while no non-NULL value has been seen, as a window sum
        seen = F.col(f"__lcnt_{name}") + F.coalesce(F.col(f"__ccnt_{name}"), F.lit(0))
        total = F.coalesce(F.col(f"__lsum_{name}"), F.lit(0)) + F.coalesce(F.col(f"__carry_{name}"), F.lit(0))
        out = out.withColumn(name, F.when(seen > 0, total).cast(kinds[name]))
    internal = {"__pid", "__rn", "__last", "__prevlast", "__nextfirst"}
    internal |= {f"__llag_{c}" for c in lag} | {f"__llead_{c}" for c in lead}
    internal |= {f"__{p}_{n_}" for n_ in running_sum for p in ("m", "lsum", "lcnt", "carry", "ccnt")}
    return out.drop(*[c for c in out.columns if c in internal])


def sessions(df: DataFrame, key: Sequence[str], ts: str, gap_seconds: int, tie: Sequence[str] = (),
             aggs: Sequence[Column] = (), skew_safe: bool | str = "auto") -> DataFrame:
    """Gap-based sessions per key in batch, balanced under hot keys.

    Same result as ``groupBy(key, session_window(ts, gap))``: a session
    continues while the next event is less than ``gap`` after the previous
    one; ``session_end`` = last event + gap.  Two ordered scans (previous
    event time, then a running count of session starts give each row its
    session number) and one aggregate per (key, session) with map-side
    partial aggregation."""
    order = [ts, *tie]
    gap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(gap_seconds))
    df = df.filter(F.col(ts).isNotNull())      # as session_window: no time, no session
    step1 = keyed_scan(df, key, order, lag=[ts], skew_safe=skew_safe)
    starts = step1.withColumn("session_starts", F.when(F.col(f"lag_{ts}").isNull()
                                                       | (F.col(ts) >= F.col(f"lag_{ts}") + gap), 1).otherwise(0))
    numbered = keyed_scan(starts.drop(f"lag_{ts}"), key, order,
                          running_sum={"session_no": F.col("session_starts")}, skew_safe=skew_safe)
    return (numbered.groupBy(*key, "session_no")
            .agg(F.min(ts).alias("session_start"), (F.max(ts) + gap).alias("session_end"), *aggs)
            .drop("session_no"))


def window_scan(df: DataFrame, key: Sequence[str], order: Sequence[str], *,
                lag: Sequence[str] = (), lead: Sequence[str] = (),
                running_sum: dict[str, Column] | None = None) -> DataFrame:
    """The same columns as ``ordered_scan`` with plain windows per key (one
    shuffle; every row of a key in one task)."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c) for c in order])
    out = df
    for c in lag:
        out = out.withColumn(f"lag_{c}", F.lag(F.col(c)).over(w))
    for c in lead:
        out = out.withColumn(f"lead_{c}", F.lead(F.col(c)).over(w))
    for name, expr in (running_sum or {}).items():
        out = out.withColumn(name, F.sum(expr).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return out


def has_hot_key(df: DataFrame, key: Sequence[str], num_partitions: int | None = None) -> bool:
    """True when one key holds more rows than an even share of a shuffle
    partition (total / partitions).  One partially aggregated count per key;
    only two numbers reach the driver."""
    n = num_partitions or shuffle_partitions(df.sparkSession)
    top, total = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
                  .agg(F.max("__n"), F.sum("__n")).first())
    return bool(total) and top > max(total / max(n, 1), 1)


def keyed_scan(df: DataFrame, key: Sequence[str], order: Sequence[str], *,
               lag: Sequence[str] = (), lead: Sequence[str] = (),
               running_sum: dict[str, Column] | None = None, skew_safe: bool | str = "auto") -> DataFrame:
    """Per-key lag / lead / running sums.  ``skew_safe``: True = always the
    split scan, False = always plain windows, "auto" = split only when
    ``has_hot_key`` finds a key larger than a partition's share."""
    split = skew_safe is True or (skew_safe == "auto" and has_hot_key(df, key))
    fn = ordered_scan if split else window_scan
    return fn(df, key, order, lag=lag, lead=lead, running_sum=running_sum)
