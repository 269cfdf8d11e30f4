from pyspark.sql import functions as F

from keelson.plans import fixtures as fx
from keelson.plans import layers as P
from keelson.session import scratch_path
from keelson.sinks import tables as sinks

from conftest import SF_SMALL


def test_run_layers_writes_and_counts(spark):
    out = scratch_path(spark, "pipe")
    raw = fx.cdc_raw(spark, SF_SMALL)
    counts = P.run_layers(raw, fx.EVENTS_SPEC, spark.read.parquet(f"{SF_SMALL}/customer.parquet"), out)
    bronze = sinks.read(spark, f"{out}/bronze")
    silver = sinks.read(spark, f"{out}/silver")
    fact = sinks.read(spark, f"{out}/fact")
    assert counts["bronze"]["rows"] == bronze.count()
    assert bronze.count() == bronze.select("entity_id", "source_lsn").distinct().count()
    n_valid = sinks.read(spark, f"{out}/silver/_valid=true").count()
    assert counts["silver"]["rows"] == silver.count()
    assert counts["silver"]["valid"] == n_valid
    assert counts["fact"]["rows"] == fact.count() == n_valid
    assert counts["fact"]["unmatched"] == fact.filter(F.col("customer_key").isNull()).count()
    # idempotent re-run: same content
    before = sorted(tuple(r) for r in fact.collect())
    P.run_layers(raw, fx.EVENTS_SPEC, spark.read.parquet(f"{SF_SMALL}/customer.parquet"), out)
    again = sorted(tuple(r) for r in sinks.read(spark, f"{out}/fact").collect())
    assert again == before


def test_overwrite_partitions_is_dynamic(spark):
    path = scratch_path(spark, "dyn")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.overwrite(df, path, partition_by=["p"])
    sinks.overwrite_partitions(spark.createDataFrame([(3, "b")], "v int, p string"), path, ["p"])
    got = sorted((r.v, r.p) for r in sinks.read(spark, path).collect())
    assert got == [(1, "a"), (3, "b")]


def test_rocksdb_state_store_runs(spark):
    from keelson.session import ROCKSDB_STATE
    from keelson.streaming import ingest, runner
    landing, out, ck = scratch_path(spark, "l"), scratch_path(spark, "o"), scratch_path(spark, "c")
    fx.cdc_raw(spark, SF_SMALL).write.parquet(f"{landing}/a")
    old = {k: spark.conf.get(k, None) for k in ROCKSDB_STATE}
    try:
        for k, v in ROCKSDB_STATE.items():
            spark.conf.set(k, v)
        raw = ingest.file_source(spark, f"{landing}/*", "value string, timestamp timestamp, lsn bigint, copy int")
        runner.run_to_end(runner.start_file_sink(ingest.bronze_stream(raw, fx.EVENTS_SPEC), out, ck))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    got = spark.read.parquet(out)
    assert got.count() == got.select("entity_id", "source_lsn").distinct().count() > 0


def test_upsert_rewrites_only_touched_buckets(spark):
    import os

    from keelson.operators import cdc
    from keelson.operators import incremental as I
    from keelson.session import local_path
    ch = cdc.parse_changes(fx.cdc_raw(spark, SF_SMALL), fx.EVENTS_SPEC).drop("_before", "_no_before")
    path = scratch_path(spark, "state")
    I.upsert_table(spark, path, ch, fx.EVENTS_SPEC, buckets=8)
    one_key = ch.filter(F.col("entity_id") == 7)
    listing = {d: sorted(os.listdir(os.path.join(local_path(path), d)))
               for d in os.listdir(local_path(path)) if d.startswith(I.BUCKET)}
    touched = I.upsert_table(spark, path, one_key, fx.EVENTS_SPEC, buckets=8)
    assert len(touched) == 1
    after = {d: sorted(os.listdir(os.path.join(local_path(path), d)))
             for d in os.listdir(local_path(path)) if d.startswith(I.BUCKET)}
    changed = {d for d in listing if listing[d] != after.get(d)}
    assert changed == {f"{I.BUCKET}={touched[0]}"}
    full = cdc.current_state_with_deletes(ch, fx.EVENTS_SPEC).select("entity_id", "source_lsn")
    got = I.read_current(spark, path).select("entity_id", "source_lsn")
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_fact_partitions_are_pruned(spark):
    out = scratch_path(spark, "pipe")
    P.run_layers(fx.cdc_raw(spark, SF_SMALL), fx.EVENTS_SPEC, spark.read.parquet(f"{SF_SMALL}/customer.parquet"), out)
    fact = sinks.read(spark, f"{out}/fact")
    q = fact.filter(F.col("change_month") == "2024-01")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(change_month" in plan
    assert q.count() == fact.filter(F.col("change_month") == "2024-01").count() > 0


def test_compact_small_files(spark):
    import glob

    from keelson.session import local_path
    src, dst = scratch_path(spark, "small"), scratch_path(spark, "compacted")
    spark.range(0, 5000, numPartitions=40).write.parquet(src)
    sinks.compact(spark, src, dst, target_files=2, cluster_by=["id"])
    assert len(glob.glob(f"{local_path(dst)}/*.parquet")) == 2
    assert sinks.read(spark, dst).count() == 5000


def test_additive_schema_evolution(spark):
    import pytest
    path = scratch_path(spark, "evolve")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(path)
    spark.createDataFrame([(2, "b", "shop")], "k int, v string, _source_system string").write.mode("append").parquet(path)
    got = sorted((r.k, r._source_system) for r in sinks.read(spark, path, merge_schema=True).collect())
    assert got == [(1, None), (2, "shop")]
    bad = scratch_path(spark, "evolve-bad")
    spark.createDataFrame([(1,)], "k int").write.parquet(bad)
    spark.createDataFrame([("x",)], "k string").write.mode("append").parquet(bad)
    with pytest.raises(Exception):
        sinks.read(spark, bad, merge_schema=True).collect()
