from decimal import Decimal

from pyspark.sql import functions as F

from keelson.functions import exprs as X


def test_decimal_roundtrip_signs(spark):
    vals = [0, 1, -1, 127, 128, -128, -129, 255, 256, 10 ** 12, -(10 ** 12), 1061683, 99999999]
    df = spark.createDataFrame([(v,) for v in vals], "v bigint")
    out = df.select("v", X.decode_decimal_base64(X.encode_decimal_base64(F.col("v") / 100, 2), 18, 2).alias("d"))
    got = {r.v: r.d for r in out.collect()}
    for v in vals:
        assert got[v] == Decimal(v) / 100


def test_decimal_decode_minimal_bytes(spark):
    # minimal big-endian two's complement as a capture tool sends it
    cases = {"EDMz": Decimal("10616.83"), "AA==": Decimal("0.00"), "/w==": Decimal("-0.01"),
             "AIA=": Decimal("1.28"), "gA==": Decimal("-1.28"), "/38=": Decimal("-1.29")}
    df = spark.createDataFrame([(k,) for k in cases], "b string")
    got = {r.b: r.d for r in df.select("b", X.decode_decimal_base64("b", 10, 2).alias("d")).collect()}
    assert got == cases


def test_null_safe(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    got = [r.x for r in df.select(X.null_safe(F.col("c")).alias("x")).collect()]
    assert got == [True, False, False]


def test_epoch_ms_zone_free(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:07.179575' as t")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["UTC", "America/New_York", "Asia/Kolkata"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert df.select(X.epoch_ms("t")).first()[0] == 1704067207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_hash_fraction_is_repeatable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = df.filter(X.hash_fraction_keep("k", 0.7)).count()
    b = df.repartition(7).filter(X.hash_fraction_keep("k", 0.7)).count()
    assert a == b and 0.68 * 20000 < a < 0.72 * 20000


def test_struct_diff(spark):
    df = spark.sql("select named_struct('a', 1, 'b', 'x', 'c', cast(null as int)) as b4, "
                   "named_struct('a', 2, 'b', 'x', 'c', 3) as af")
    assert df.select(X.struct_diff("b4", "af", ["a", "b", "c"])).first()[0] == "a,c"


def test_epoch_ms_roundtrip(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:07.179' as t")
    assert df.select((X.from_epoch_ms(X.epoch_ms("t")) == F.col("t")).alias("x")).first().x


def test_decimal_decode_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.integers(min_value=-(10 ** 15), max_value=10 ** 15), min_size=1, max_size=50))
    def check(vals):
        import base64
        from decimal import Decimal

        def minimal(v):
            n = max(1, (v.bit_length() + 8) // 8)
            return base64.b64encode(v.to_bytes(n, "big", signed=True)).decode()
        df = spark.createDataFrame([(minimal(v), v) for v in vals], "b string, v bigint")
        for r in df.select("v", X.decode_decimal_base64("b", 18, 2).alias("d")).collect():
            assert r.d == Decimal(r.v) / 100
    check()


def test_decimal_decode_is_strict(spark):
    df = spark.createDataFrame([("EDMz",), ("%%%",), ("",), (None,), ("12.5",), ("-3",)], "b string")
    got = [r.d for r in df.select(X.decode_decimal_base64("b", 10, 2).alias("d")).collect()]
    assert got == [Decimal("10616.83"), None, None, None, None, None]
    faults = [r.f for r in df.select(X.decimal_fault("b", X.decode_decimal_base64("b", 10, 2)).alias("f")).collect()]
    assert faults == [False, True, True, False, True, True]


def test_decimal_decode_of_wide_values(spark):
    """Longer than 8 bytes, redundant sign bytes, digits that are base64 too,
    more scale than a division keeps, and values over the precision."""
    import base64
    wide = [0, 1, -1, 10 ** 30, -(10 ** 30), (1 << 63), -(1 << 63) - 1, 10 ** 37, -(10 ** 37), 123456789]
    rows = [(base64.b64encode(v.to_bytes(n, "big", signed=True)).decode(), str(v)) for v in wide for n in (16, 20)]
    df = spark.createDataFrame(rows, "b string, v string")
    for r in df.select("v", X.decode_decimal_base64("b", 38, 0).alias("d"), X.decode_decimal_base64("b", 38, 8).alias("s")).collect():
        assert r.d == Decimal(r.v)
        assert r.s == (Decimal(r.v).scaleb(-8) if abs(int(r.v)) < 10 ** 38 else None)
    one = spark.createDataFrame([("1234",), ("B1vNFQ==",), ("f////w==",)], "b string")
    got = [r.d for r in one.select(X.decode_decimal_base64("b", 18, 8).alias("d")).collect()]
    assert got[0] == Decimal(int.from_bytes(base64.b64decode("1234"), "big", signed=True)).scaleb(-8) and got[1] == Decimal("1.23456789")
    small = one.select(X.decode_decimal_base64("b", 4, 2).alias("d")).collect()   # over the precision: NULL, no failed job
    assert small[1].d is None and small[2].d is None


def test_tiny_fractions_keep_some(spark):
    keep = spark.range(2_000_000).filter(X.hash_fraction_keep("id", 1 / 262144)).count()
    assert 0 < keep < 40
