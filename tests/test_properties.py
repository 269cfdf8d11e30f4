"""Randomised change logs: current state equals a brute-force model."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F  # noqa: F401

from keelson.operators import cdc
from keelson.spec import TableSpec

SPEC = TableSpec(name="t", key=("k",), after_ddl="k bigint, v string")

change = st.tuples(st.integers(0, 4), st.integers(0, 6), st.sampled_from(["c", "u", "d"]), st.sampled_from("abc"))


@settings(max_examples=6, deadline=None)
@given(st.lists(change, min_size=1, max_size=40), st.integers(1, 3))
def test_current_state_model(spark_session_for_props, log, copies):
    spark = spark_session_for_props
    rows = []
    for lsn, (k, ts, op, v) in enumerate(log):
        for _ in range(copies):   # repeated deliveries
            rows.append((k, ts, lsn, op, None if op == "d" else v))
    df = spark.createDataFrame(rows, "k bigint, source_ts_ms bigint, source_lsn bigint, cdc_operation string, v string")
    df = df.withColumn("kafka_timestamp", F.lit(None).cast("timestamp")).repartition(3)
    got = {r.k: (r.source_lsn, r.v) for r in cdc.current_state_with_deletes(df, SPEC).collect()}
    latest = {}
    for lsn, (k, ts, op, v) in enumerate(log):
        if k not in latest or (ts, lsn) > latest[k][:2]:
            latest[k] = (ts, lsn, op, v)
    expect = {k: (lsn, v) for k, (ts, lsn, op, v) in latest.items() if op != "d"}
    assert got == expect


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(-5, 5))),
                min_size=1, max_size=60),
       st.integers(1, 9))
def test_ordered_scan_equals_windows(spark_session_for_props, rows, n):
    from keelson.operators.sequences import ordered_scan, window_scan
    spark = spark_session_for_props
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(rows)], "k int, t int, v int")
    kw = dict(lag=["v"], lead=["v"], running_sum={"s": F.col("v")})
    a = ordered_scan(df, ["k"], ["t"], num_partitions=n, **kw).select("k", "t", "lag_v", "lead_v", "s")
    b = window_scan(df, ["k"], ["t"], **kw).select("k", "t", "lag_v", "lead_v", "s")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


@settings(max_examples=5, deadline=None)
@given(st.sets(st.integers(-1000, 1000), min_size=1, max_size=80), st.integers(1, 9))
def test_dense_key_equals_row_number(spark_session_for_props, keys, n):
    from keelson.operators.dims import dense_key
    spark = spark_session_for_props
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = sorted(tuple(r) for r in dense_key(df.repartition(3), ["k"], "sk", num_partitions=n).collect())
    assert got == [(k, i) for i, k in enumerate(sorted(keys))]
