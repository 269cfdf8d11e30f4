"""URL filter rules by a sorted sweep over reversed-host keys.

A host's labels are reversed (``a.example.net`` becomes ``net.example.a.``),
so a rule covers the interval of keys that start with its own key, and the
intervals of all rules are nested or apart.  Keys and rule starts are sorted
together and swept; each rule start replaces the stack by its own chain of
enclosing rules, and a key's active rules are those of the last chain that
its key still lies in.  Two sweeps are made: hosts against rule hosts, then
(rule host + path) against (rule host + rule path).

The sorted order is cut in buckets (range partitions over key and a spread
value, so one key's rows need not meet in a task); what a bucket inherits is
the last chain before it, one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir, table

#: The rules of the contract (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

#: Verdict of a url that no rule fits.
DEFAULT = "allow"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or
    a url without ``://``."""
    from .common import ascii_lower
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return ascii_lower(host), path


def host_key(host: Column) -> Column:
    """Labels reversed, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def chains(starts: DataFrame) -> DataFrame:
    """``key`` and ``chain``: the sorted array of all keys of ``starts`` that
    are prefixes of it, itself included."""
    starts = starts.select("key").where("key is not null and key <> ''").distinct()
    cut = starts.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")).select("key", F.expr("left(key, n)").alias("outer"))
    found = cut.join(starts.withColumnRenamed("key", "outer"), "outer")
    return found.groupBy("key").agg(F.array_sort(F.collect_set("outer")).alias("chain"))


def sweep(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """``rows`` (with a ``key``) and ``stack``: those keys of ``starts`` that
    are prefixes of the row's key, outermost first."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    names = [c for c in rows.columns if c != "key"]
    begin = chains(starts)
    null_rows = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in names]
    events = (begin.select("key", F.lit(0).alias("_kind"), "chain", F.lit(0).cast("long").alias("_spread"), *null_rows)
              .unionByName(rows.select("key", F.lit(1).alias("_kind"), F.lit(None).cast("array<string>").alias("chain"),
                                       F.xxhash64(*[F.col(c) for c in names]).alias("_spread"), *names)))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the bucket numbers are read twice below, so they are fixed in the shared folder
    sorted_events = (events.repartitionByRange(n, "key", "_kind", "_spread")
                     .withColumn("_bucket", F.spark_partition_id()).checkpoint())
    order = Window.partitionBy("_bucket").orderBy("key", "_kind", "_spread")
    last = sorted_events.where("chain is not null").groupBy("_bucket").agg(F.max_by("chain", "key").alias("chain"))
    buckets = spark.range(n).select(F.col("id").cast("int").alias("_bucket"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.join(last, "_bucket", "left").select("_bucket", F.last("chain", ignorenulls=True).over(before).alias("_carried"))
    swept = sorted_events.withColumn(
        "chain", F.last("chain", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    active = (swept.where("_kind = 1").join(F.broadcast(carried), "_bucket", "left")
              .withColumn("_chain", F.coalesce("chain", "_carried", F.array().cast("array<string>"))))
    return active.select("key", *names, F.filter("_chain", lambda r: F.startswith("key", r)).alias("stack"))


def apply_rules(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """All rows of ``pages`` with ``host``, ``path``, ``rule``, ``verdict``
    (they replace columns of the same name).

    ``rules`` has host, path, verdict.  The longest rule wins (host plus
    path, in characters); of equally long ones a blocking one, then the one
    whose text sorts first.  Null urls and urls without ``://`` have empty
    host and path and fit no rule; rules with a null host or path or an
    empty host are void.  ``default`` is the verdict without a rule.
    """
    added = ["host", "path", "rule", "verdict"]
    names = [c for c in pages.columns if c not in added]
    host, path = host_path(F.col(f"`{url}`"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), host.alias("host"), path.alias("path"))
    known = (rules.where("host is not null and path is not null and host <> ''")
             .select(host_key(F.lower("host")).alias("node"), F.concat("host", "path").alias("rule"), "path", "verdict")
             .groupBy("node", "path").agg(F.min_by(F.struct("rule", "verdict"), F.struct(F.col("verdict") != "block", "rule")).alias("r"))
             .select("node", F.concat("node", "path").alias("full"), "r.rule", "r.verdict"))
    pairs = rows.select("host", "path").distinct()
    hosts = pairs.select("host").distinct().withColumn("key", host_key(F.col("host")))
    nodes = sweep(hosts, known.select(F.col("node").alias("key"))).where(F.size("stack") > 0).select("host", "stack")
    tries = (pairs.join(nodes, "host").select("host", "path", F.explode("stack").alias("node"))
             .select("host", "path", F.concat("node", "path").alias("key")))
    fits = sweep(tries, known.select(F.col("full").alias("key"))).select("host", "path", F.explode("stack").alias("full"))
    best = (fits.join(known, "full").groupBy("host", "path")
            .agg(F.min_by(F.struct("rule", "verdict"), F.struct(-F.length("rule"), F.col("verdict") != "block", "rule")).alias("r")))
    return (rows.join(best, ["host", "path"], "left")
            .select("row.*", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", F.lit(default)).alias("verdict")))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return apply_rules(pages, rules).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(rhost, rpath, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (SELECT p.page_id, p.host, p.path, r.rhost || r.rpath AS rule, r.v,
        row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST) AS k
      FROM p LEFT JOIN r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""
