"""Business rules, the valid / quarantine split and data-quality reports.

A ``Rule`` is a named boolean check with the reason reported when it fails.
Checks are evaluated null-safely: a rule passes only when its check is TRUE,
so ``valid`` and ``quarantine`` always partition the input.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.exprs import null_safe


@dataclass(frozen=True)
class Rule:
    name: str                 # flag column written, e.g. has_valid_status
    check: Callable[[], Column]
    reason: str               # text reported when the rule fails

    def flag(self) -> Column:
        return null_safe(self.check())


def accepted_values(name: str, col: str, values: Sequence[str], reason: str | None = None) -> Rule:
    vals = list(values)
    return Rule(name, lambda: F.col(col).isin(vals), reason or f"invalid {col} value")


def positive(name: str, col: str, reason: str | None = None) -> Rule:
    return Rule(name, lambda: F.col(col) > 0, reason or f"non-positive {col}")


def null_or_nonneg(name: str, col: str, reason: str | None = None) -> Rule:
    return Rule(name, lambda: F.col(col).isNull() | (F.col(col) >= 0), reason or f"negative {col}")


def implication(name: str, flag_col: str, then_col: str, reason: str | None = None) -> Rule:
    """If ``flag_col`` is TRUE then ``then_col`` must be present."""
    return Rule(name, lambda: (~F.col(flag_col)) | (F.col(flag_col) & F.col(then_col).isNotNull()),
                reason or f"{flag_col} without {then_col}")


def distinct_pair(name: str, a: str, b: str, reason: str | None = None) -> Rule:
    return Rule(name, lambda: F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)),
                reason or f"missing or identical {a}/{b}")


def required(name: str, col: str, reason: str | None = None) -> Rule:
    return Rule(name, lambda: F.col(col).isNotNull(), reason or f"missing {col}")


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add one null-safe flag per rule plus ``_valid``, ``quarantine_reason``
    (first failing rule in rule order, NULL when valid) and ``failed_rules``
    (all failing rule names, comma joined in rule order, '' when valid)."""
    out = df.withColumns({r.name: r.flag() for r in rules})
    valid = F.lit(True)
    for r in rules:
        valid = valid & F.col(r.name)
    reason = F.lit(None).cast("string")
    for r in reversed(rules):
        reason = F.when(~F.col(r.name), F.lit(r.reason)).otherwise(reason)
    failed = F.concat_ws(",", *[F.when(~F.col(r.name), F.lit(r.name)) for r in rules])
    return out.withColumns({"_valid": valid, "quarantine_reason": reason, "failed_rules": failed})


def exists_in(df: DataFrame, col: str, parent: DataFrame, parent_col: str, name: str) -> tuple[DataFrame, Rule]:
    """``df`` with a helper column and the rule that ``col``, where set,
    names a row of ``parent``: a referential check that quarantines instead
    of only reporting.  The parent is reduced to its distinct keys, so the
    join cannot multiply rows."""
    helper = f"__{name}"
    keys = parent.select(F.col(parent_col).alias("__pk")).distinct().withColumn(helper, F.lit(True))
    out = df.join(keys, F.col(col) == F.col("__pk"), "left").drop("__pk")
    return out, Rule(name, lambda: F.col(col).isNull() | F.col(helper), f"{col} without a match")


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Complementary views of a checked frame (``_valid`` is never NULL)."""
    return checked.filter(F.col("_valid")), checked.filter(~F.col("_valid"))


def valid_rows(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str] | None = None) -> DataFrame:
    v, _ = split(check(df, rules))
    return v.select(*keep) if keep else v.drop("_valid", "quarantine_reason", "failed_rules")


def quarantine_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    _, q = split(check(df, rules))
    return q.drop("_valid")


def reconcile(input_df: DataFrame, valid: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row of counts proving valid + quarantine = input as multisets.

    Net count per distinct row (+1 per input copy, -1 per output copy); rows
    are told apart by a 128-bit hash of all columns, NULLs included, so one
    pass shuffles two longs and three counts a row, whatever its width.
    ``n_missing`` / ``n_extra`` must be 0.
    """
    cols = [c for f in input_df.columns for c in (F.col(f).isNull(), F.col(f))]

    def tag(df, i, v, q):
        return df.select(F.xxhash64(*cols).alias("__a"), F.xxhash64(F.lit("b"), *cols).alias("__b"),
                         F.lit(i).alias("__i"), F.lit(v).alias("__v"), F.lit(q).alias("__q"))

    per_row = (tag(input_df, 1, 0, 0).unionByName(tag(valid, 0, 1, 0)).unionByName(tag(quarantine, 0, 0, 1))
               .groupBy("__a", "__b").agg(F.sum("__i").alias("i"), F.sum("__v").alias("v"), F.sum("__q").alias("q")))
    net = F.col("i") - F.col("v") - F.col("q")
    return per_row.agg(
        F.coalesce(F.sum("i"), F.lit(0)).cast("bigint").alias("n_input"),
        F.coalesce(F.sum("v"), F.lit(0)).cast("bigint").alias("n_valid"),
        F.coalesce(F.sum("q"), F.lit(0)).cast("bigint").alias("n_quarantine"),
        F.coalesce(F.sum(F.greatest(net, F.lit(0))), F.lit(0)).cast("bigint").alias("n_missing"),
        F.coalesce(F.sum(F.greatest(-net, F.lit(0))), F.lit(0)).cast("bigint").alias("n_extra"))


def dq_report(df: DataFrame, table: str, not_null: Sequence[str] = (), unique: Sequence[str] = (),
              accepted: dict[str, Sequence[str]] | None = None,
              relationships: dict | None = None) -> DataFrame:
    """dbt-style tests: not_null, unique, accepted_values, relationships
    (``{column: (parent DataFrame, parent column)}``: non-NULL values with
    no parent row, one left anti join each).

    Returns (table_name, test_name, column_name, failures).  One scan: the
    row-level tests are counted inside the aggregation by the first unique
    column (partial counts per value, map-side), and that aggregation also
    yields the duplicate count; each further unique column adds one
    partially aggregated shuffle.
    """
    accepted = accepted or {}
    row_tests = {}
    for c in not_null:
        row_tests[("not_null", c)] = F.col(c).isNull()
    for c, vals in accepted.items():
        row_tests[("accepted_values", c)] = F.col(c).isNotNull() & ~null_safe(F.col(c).isin(list(vals)))
    cols = {t: f"__t{i}" for i, t in enumerate(row_tests)}
    flagged = df.select(*unique, *[F.when(e, 1).otherwise(0).alias(cols[t]) for t, e in row_tests.items()])

    def stack(frame: DataFrame, entries: list) -> DataFrame:
        """One-row aggregate -> one row per test (``inline``: no re-scan)."""
        rows = [F.struct(F.lit(t).alias("test_name"), F.lit(c).alias("column_name"),
                         F.coalesce(v, F.lit(0)).cast("bigint").alias("failures")) for t, c, v in entries]
        return frame.select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))

    entries = [(t, c, F.col(cols[(t, c)])) for (t, c) in row_tests]
    if unique:
        first = unique[0]
        per = flagged.groupBy(first).agg(F.count(F.lit(1)).alias("__n"),
                                         *[F.sum(c).alias(c) for c in cols.values()])
        dup = F.when(F.col(first).isNotNull() & (F.col("__n") > 1), F.col("__n")).otherwise(0)
        tot = per.agg(F.sum(dup).alias("__dup"), *[F.sum(c).alias(c) for c in cols.values()])
        out = stack(tot, entries + [("unique", first, F.col("__dup"))])
    else:
        out = stack(flagged.agg(*[F.sum(c).alias(c) for c in cols.values()]), entries)
    for c in unique[1:]:
        dup = (df.filter(F.col(c).isNotNull()).groupBy(c).count().filter(F.col("count") > 1)
               .agg(F.sum("count").alias("__dup")))
        out = out.unionByName(stack(dup, [("unique", c, F.col("__dup"))]))
    for c, (parent, parent_col) in (relationships or {}).items():
        miss = relationship_failures(df.select(c), parent, c, parent_col).agg(F.count(F.lit(1)).alias("__m"))
        out = out.unionByName(stack(miss, [("relationships", c, F.col("__m"))]))
    return out


def relationship_failures(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose (non-NULL) foreign key has no parent: a left anti join."""
    p = parent.select(F.col(parent_col).alias("__pk")).distinct()
    return (child.filter(F.col(child_col).isNotNull())
            .join(p, F.col(child_col) == F.col("__pk"), "left_anti"))


def observe_counts(df: DataFrame, name: str, conds: dict[str, Column]):
    """Attach row-count metrics that are filled in by the next action over
    ``df`` (e.g. its write): no second pass to count."""
    from pyspark.sql import Observation
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [F.count_if(c).alias(k) for k, c in conds.items()]
    return df.observe(obs, *exprs), obs


def profile_by_day(df: DataFrame, day: Column, columns: Sequence[str]) -> DataFrame:
    """Mergeable profile: one row per (day, column) with ``n_rows``,
    ``n_nulls``, ``lowest``, ``highest`` and two sketches, of the distinct
    values (``distinct_sketch``, HyperLogLog) and, for numbers, of their
    distribution (``quantile_sketch``, KLL).

    Store it partitioned by day: a new day adds its rows, and a profile of
    any span merges sketches instead of reading the data.  Sketches are
    built map-side and merged after the shuffle, a few kilobytes per group
    whatever the rows."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double") or f.dataType.typeName().startswith("decimal")}
    aggs = []
    for c in columns:
        v = F.col(f"`{c}`")
        quantiles = F.kll_sketch_agg_double(v.cast("double")) if c in numeric else F.lit(None).cast("binary")
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if(v.isNull()).alias("n_nulls"),
                             F.min(v).cast("string").alias("lowest"), F.max(v).cast("string").alias("highest"),
                             F.lit(c in numeric).alias("is_number"),
                             F.hll_sketch_agg(v.cast("string"), F.lit(HLL_LG_K)).alias("distinct_sketch"), quantiles.alias("quantile_sketch")))
    per = df.groupBy(day.alias("day")).agg(F.array(*aggs).alias("__p"))
    return per.select("day", F.inline("__p"))


#: HyperLogLog buckets as a power of two: a relative error of about 0.8 % (one deviation).
HLL_LG_K = 14


def merge_profiles(profiles: DataFrame, quantiles: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """One row per column over all days of ``profiles``: ``n_rows``,
    ``n_nulls``, ``n_distinct`` (estimated, see ``HLL_LG_K``) and ``q<percent>``
    for numbers (KLL: rank error of about 1.3 %)."""
    merged = profiles.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
        F.kll_merge_agg_double("quantile_sketch").alias("__q"), F.max("is_number").alias("__number"))
    return merged.select("column_name", "n_rows", "n_nulls", "n_distinct", *[
        F.when(F.col("__number") & (F.col("n_rows") > F.col("n_nulls")), F.kll_sketch_get_quantile_double("__q", F.lit(float(q)))).alias(f"q{round(100 * q)}") for q in quantiles])
