"""Table computations behind the source systems' data: header totals,
ledgers and tiers, status outcomes and transitions, schedule expansion,
usage-driven maintenance, cascades, samples.  All built-in expressions and
aggregates with map-side partial aggregation; small lookup tables are
broadcast only behind a size check (``operators.joins``)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.exprs import hash_fraction_keep, in_comma_list, weekday_code
from keelson.operators.joins import checked_broadcast, range_lookup
from keelson.operators.sequences import keyed_scan


def dec(c, p: int = 18, s: int = 2) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal({p},{s})")


def header_rollup(lines: DataFrame, headers: DataFrame, line_key: str, header_key: str,
                  line_amount: Column, header_amount: Column) -> DataFrame:
    """Header total = sum of its line amounts rounded to cents, compared with
    the stored header amount.  Lines are pre-aggregated per header before
    the join, so only one row per header crosses the join shuffle."""
    per = (lines.groupBy(F.col(line_key).alias("__k"))
           .agg(F.count(F.lit(1)).alias("n_items"),
                F.sum(F.round(line_amount, 2)).cast("decimal(18,2)").alias("items_total")))
    h = headers.select(F.col(header_key), header_amount.cast("decimal(18,2)").alias("header_total"))
    return (h.join(per, F.col(header_key) == F.col("__k"), "left").drop("__k")
            .withColumn("n_items", F.coalesce("n_items", F.lit(0)).cast("bigint"))
            .withColumn("items_total", F.coalesce("items_total", F.lit(0).cast("decimal(18,2)")))
            .withColumn("total_matches", F.col("items_total") == F.col("header_total")))


def ledger_balance(ledger: DataFrame, account: str, type_col: str, amount: Column,
                   earn: Sequence[str], redeem: Sequence[str]) -> DataFrame:
    """Per account: earned, redeemed, balance and transaction count."""
    e = F.when(F.col(type_col).isin(list(earn)), amount)
    r = F.when(F.col(type_col).isin(list(redeem)), amount)
    z = F.lit(0).cast("decimal(18,2)")
    return (ledger.groupBy(account)
            .agg(F.coalesce(F.sum(e), z).cast("decimal(18,2)").alias("earned"),
                 F.coalesce(F.sum(r), z).cast("decimal(18,2)").alias("redeemed"),
                 F.count(F.lit(1)).alias("n_transactions"))
            .withColumn("balance", (F.col("earned") - F.col("redeemed")).cast("decimal(18,2)")))


def running_balance(ledger: DataFrame, account: str, order: Sequence[str], signed: Column,
                    out: str = "running_balance", skew_safe: bool | str = "auto") -> DataFrame:
    """Available balance after each transaction (cumulative signed sum in
    time order, ties broken by the following order columns).  An account
    holding more than a partition's share of the ledger is split over many
    tasks (``sequences.keyed_scan``)."""
    return keyed_scan(ledger, [account], order, running_sum={out: signed}, skew_safe=skew_safe)


def assign_tier(totals: DataFrame, amount_col: str, tiers: DataFrame, min_col: str = "min_miles") -> DataFrame:
    """Highest tier whose minimum is <= the amount (a range lookup: broadcast
    band join behind a size check, as-of lookup beyond it)."""
    return range_lookup(totals, amount_col, tiers, min_col)


def last_status_counts(events: DataFrame, key: str, order: Sequence[str], status: str,
                       statuses: Sequence[str]) -> DataFrame:
    """Outcome per entity = its latest status; one row of counts per outcome
    (two aggregates, both partially aggregated)."""
    last = (events.groupBy(key)
            .agg(F.max_by(F.col(status), F.struct(*[F.col(c) for c in order])).alias("__s")))
    return last.agg(F.count(F.lit(1)).alias("n_entities"),
                    *[F.count_if(F.col("__s") == s).alias(f"n_{s.lower()}") for s in statuses])


def transitions(events: DataFrame, key: str, order: Sequence[str], status: str,
                skew_safe: bool | str = "auto") -> DataFrame:
    """Each row with the entity's previous status (NULL for the first)."""
    out = keyed_scan(events, [key], order, lag=[status], skew_safe=skew_safe)
    return out.withColumnRenamed(f"lag_{status}", "from_status").withColumnRenamed(status, "to_status")


def transition_counts(trans: DataFrame, allowed: DataFrame) -> DataFrame:
    """Counts per (from, to) with an allowed flag from a literal table."""
    counts = trans.groupBy("from_status", "to_status").agg(F.count(F.lit(1)).alias("n_transitions"))
    a = checked_broadcast(allowed.select(F.col("from_status").alias("__f"), F.col("to_status").alias("__t"),
                                         F.lit(True).alias("__ok")))
    j = counts.join(a, F.col("from_status").eqNullSafe(F.col("__f")) & (F.col("to_status") == F.col("__t")), "left")
    return j.select("from_status", "to_status", "n_transitions",
                    F.coalesce(F.col("__ok"), F.lit(False)).alias("is_allowed"))


def expand_schedule(schedules: DataFrame, as_of: str, days_before: int, days_after: int,
                    only_past: bool = True, respect_days: bool = True) -> DataFrame:
    """Recurring schedules -> one instance per operating day in the window
    [as_of - days_before, as_of + days_after].  Columns needed: schedule_id,
    code, days_of_week ('MON,WED'), dep_minute, arr_minute (minutes of day).
    Instance id = code || (100 + schedule_id) || MMdd; arrival rolls to the
    next day when it is earlier than the departure."""
    d0 = F.date_sub(F.lit(as_of).cast("date"), days_before)
    d1 = F.date_add(F.lit(as_of).cast("date"), days_after)
    x = schedules.withColumn("flight_date", F.explode(F.sequence(d0, d1, F.expr("interval 1 day"))))
    if only_past:
        x = x.filter(F.col("flight_date") <= F.lit(as_of).cast("date"))
    if respect_days:
        x = x.filter(in_comma_list("days_of_week", weekday_code("flight_date")))
    day = F.col("flight_date").cast("timestamp_ntz")
    arr_day = F.when(F.col("arr_minute") < F.col("dep_minute"), F.date_add("flight_date", 1)) \
        .otherwise(F.col("flight_date")).cast("timestamp_ntz")
    return x.select(
        F.concat(F.col("code"), (F.col("schedule_id") + 100).cast("string"),
                 F.date_format("flight_date", "MMdd")).alias("flight_id"),
        "schedule_id", "flight_date",
        F.timestamp_add("MINUTE", F.col("dep_minute"), day).alias("scheduled_departure"),
        F.timestamp_add("MINUTE", F.col("arr_minute"), arr_day).alias("scheduled_arrival"))


def apply_delays(flights: DataFrame, delays: DataFrame, on: Sequence[str]) -> DataFrame:
    """Actual times = scheduled + delay minutes (0 when no delay recorded)."""
    j = flights.join(delays, list(on), "left")
    m = F.coalesce(F.col("delay_minutes"), F.lit(0))
    return (j.withColumn("delay_minutes", m)
            .withColumn("actual_departure", F.timestamp_add("MINUTE", m, F.col("scheduled_departure")))
            .withColumn("actual_arrival", F.timestamp_add("MINUTE", m, F.col("scheduled_arrival"))))


def usage_due(usage: DataFrame, schedules: DataFrame, model_col: str, hours: str, cycles: str,
              max_occurrences: int | None = None) -> DataFrame:
    """Maintenance occurrences due by accumulated usage: per (unit, check
    type) ``n = max(floor(hours / interval_h), floor(cycles / interval_c))``,
    kept whole in ``times_due``; one row per occurrence 1..n, at most
    ``max_occurrences`` of them when that is given.  The schedule
    table (types x models) is broadcast when it passes the size check."""
    j = usage.join(checked_broadcast(schedules), model_col)
    by_h = F.when(F.col("interval_flight_hours") > 0, F.floor(F.col(hours) / F.col("interval_flight_hours"))).otherwise(0)
    by_c = F.when(F.col("interval_flight_cycles") > 0, F.floor(F.col(cycles) / F.col("interval_flight_cycles"))).otherwise(0)
    n = F.greatest(by_h, by_c).cast("int")
    j = j.withColumn("times_due", n).filter(F.col("times_due") >= 1)
    last = F.col("times_due") if max_occurrences is None else F.least(F.col("times_due"), F.lit(max_occurrences))
    return j.withColumn("occurrence", F.explode(F.sequence(F.lit(1), last)))


def flag_from_events(entities: DataFrame, key: str, events: DataFrame, event_key: str,
                     condition: Column, out: str) -> DataFrame:
    """Entity flag = it has at least one event meeting ``condition``: the
    matching keys are reduced to distinct values (partial aggregation) and
    left joined, so the join cannot fan out."""
    hits = events.filter(condition).select(F.col(event_key).alias("__k")).distinct() \
        .withColumn("__hit", F.lit(True))
    return (entities.join(hits, F.col(key) == F.col("__k"), "left")
            .withColumn(out, F.coalesce(F.col("__hit"), F.lit(False))).drop("__k", "__hit"))


def hash_sample(df: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """Repeatable fraction of a population by a hash threshold on the key
    (the same rows on every run and partitioning)."""
    return df.filter(hash_fraction_keep(F.col(key), fraction, salt))


def pick_one(df: DataFrame, group: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Deterministic pick per group: the row with the smallest order tuple."""
    return (df.groupBy(group)
            .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order])).alias("__p"))
            .select(group, *[F.col(f"__p.{c}").alias(c) for c in cols]))


def upsert_state(base_state: DataFrame, changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Incremental current state: the latest of (base row, new changes) per
    key.  Only keys present in ``changes`` can change."""
    rest = [c for c in base_state.columns if c not in key]
    both = base_state.unionByName(changes.select(*base_state.columns))
    latest = both.groupBy(*key).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("__r"))
    return latest.select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest])


def period_end_balance(ledger: DataFrame, account: str, ts: str, signed: Column, until: Column, period: str = "MONTH") -> DataFrame:
    """Balance of every account at every period end from its first posting to
    ``until`` (a date): ``account``, ``period_end``, ``balance``.

    Semi-additive: balances add up over accounts, not over periods.  Postings
    are summed per (account, period) first, map-side; the running sum then
    sees one row per period of an account, and each such row is carried
    forward to the period before the next one (``sequence`` over the gap),
    without a calendar x account join."""
    start = F.date_trunc(period, F.col(ts)).cast("date")
    step = F.expr("interval 3 month" if period.upper() == "QUARTER" else f"interval 1 {period}")
    last = F.date_trunc(period, until.cast("timestamp_ntz")).cast("date")
    per = ledger.groupBy(F.col(account).alias("__a"), start.alias("__p")).agg(F.sum(signed).alias("__s"))
    w = Window.partitionBy("__a").orderBy("__p")
    run = per.filter((F.col("__p") <= last) & F.col("__p").isNotNull()).select(
        "__a", "__p", F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("balance"),
        F.lead("__p").over(w).alias("__n"))
    upto = F.when(F.col("__n").isNull(), last).otherwise((F.col("__n") - step).cast("date"))
    filled = run.select("__a", "balance", F.explode(F.sequence("__p", upto, step)).alias("__q"))
    return filled.select(F.col("__a").alias(account), F.date_sub((F.col("__q") + step).cast("date"), 1).alias("period_end"), "balance")


def cascade(tables: dict[str, tuple[DataFrame, str]], references: Sequence[tuple[str, str, str]], start: str, keys: DataFrame,
            max_rounds: int = 50) -> DataFrame:
    """All rows that hang on the given rows of ``start``, along declared
    references: ``table_name``, ``row_key`` (as string), ``level`` (the
    shortest way from the start).

    ``tables``: name -> (rows, key column); ``references``: (child table,
    its column, parent table); ``keys``: one column of keys of ``start``.
    Any shape will do, several ways to a table or a table that refers to
    itself: each round joins the children of the last round's new keys,
    stored, and ends when nothing new came.  A row counts once, at its
    first level; NULL refers to nothing."""
    from keelson.session import scratch_path
    spark = keys.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "frontier")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def frontier(name: str, df: DataFrame, level: int) -> DataFrame:
        return df.select(F.lit(name).alias("table_name"), df[df.columns[0]].cast("string").alias("row_key"), F.lit(level).alias("level")).filter("row_key is not null")

    new = stored(frontier(start, keys, 0).distinct())
    found, touched = new, {start}
    for level in range(1, max_rounds + 1):
        steps = []
        for child, column, parent in references:
            if parent in touched:
                rows, key = tables[child]
                up = new.filter(F.col("table_name") == parent).select(F.col("row_key").alias("__up"))
                steps.append((child, frontier(child, rows.join(up, F.col(column).cast("string") == F.col("__up"), "left_semi").select(key), level)))
        if not steps:
            return found
        reached = steps[0][1]
        for _, df in steps[1:]:
            reached = reached.unionByName(df)
        new = stored(reached.distinct().join(found.select("table_name", "row_key"), ["table_name", "row_key"], "left_anti"))
        # at most one row per table
        touched = {r[0] for r in new.select("table_name").distinct().collect()}
        if not touched:
            return found
        found = found.unionByName(new)
    raise ValueError(f"the cascade did not end in {max_rounds} rounds")
