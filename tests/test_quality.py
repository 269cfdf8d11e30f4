from pyspark.sql import functions as F

from keelson.operators import quality as Q

RULES = [Q.accepted_values("ok_status", "status", ["A", "B"]),
         Q.positive("ok_amount", "amount"),
         Q.required("ok_ref", "ref")]


def _frame(spark):
    rows = []
    i = 0
    for status in ["A", "Z", None]:
        for amount in [5, -1, None]:
            for ref in ["r", None]:
                rows.append((i, status, amount, ref))
                i += 1
    return spark.createDataFrame(rows, "id int, status string, amount int, ref string")


def test_truth_tables(spark):
    df = _frame(spark)
    out = {r.id: r for r in Q.check(df, RULES).collect()}
    for r in df.collect():
        o = out[r.id]
        assert o.ok_status == (r.status in ("A", "B"))
        assert o.ok_amount == (r.amount is not None and r.amount > 0)
        assert o.ok_ref == (r.ref is not None)
        assert o._valid == (o.ok_status and o.ok_amount and o.ok_ref)
        if not o._valid:
            first = [n for n, ok in [("invalid status value", o.ok_status), ("non-positive amount", o.ok_amount),
                                     ("missing ref", o.ok_ref)] if not ok][0]
            assert o.quarantine_reason == first
        else:
            assert o.quarantine_reason is None and o.failed_rules == ""


def test_split_is_whole(spark):
    df = _frame(spark)
    valid, quarantine = Q.split(Q.check(df, RULES))
    assert valid.count() + quarantine.count() == df.count() == 18
    rec = Q.reconcile(df, valid.select(*df.columns), quarantine.select(*df.columns)).first()
    assert (rec.n_input, rec.n_missing, rec.n_extra) == (18, 0, 0)


def test_reconcile_detects_loss(spark):
    df = _frame(spark)
    # the captured jobs' filters: raw checks lose NULL rows
    chk = df.withColumn("c", F.col("status").isin("A", "B") & (F.col("amount") > 0))
    valid, quarantine = chk.filter("c"), chk.filter("not c")
    rec = Q.reconcile(df, valid.select(*df.columns), quarantine.select(*df.columns)).first()
    assert rec.n_missing > 0 and rec.n_extra == 0


def test_implication_and_pair(spark):
    df = spark.createDataFrame([(True, "x", "a", "b"), (True, None, "a", "a"), (False, None, None, "b"),
                                (None, None, "a", None)], "g boolean, why string, o string, d string")
    r1 = Q.implication("f1", "g", "why")
    r2 = Q.distinct_pair("f2", "o", "d")
    got = [(r.f1, r.f2) for r in df.select(r1.flag().alias("f1"), r2.flag().alias("f2")).collect()]
    assert got == [(True, True), (False, False), (True, False), (False, False)]


def test_null_or_nonneg(spark):
    df = spark.createDataFrame([(None,), (0,), (3,), (-2,)], "h int")
    r = Q.null_or_nonneg("f", "h")
    assert [x.f for x in df.select(r.flag().alias("f")).collect()] == [True, True, True, False]


def test_dq_report_counts(spark):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (2, None), (3, "Q")], "k int, s string")
    rep = {(r.test_name, r.column_name): r.failures
           for r in Q.dq_report(df, "t", not_null=["s"], unique=["k"], accepted={"s": ["A", "B"]}).collect()}
    assert rep == {("not_null", "s"): 1, ("unique", "k"): 2, ("accepted_values", "s"): 1}


def test_valid_and_quarantine_helpers(spark):
    df = _frame(spark)
    v = Q.valid_rows(df, RULES)
    q = Q.quarantine_rows(df, RULES)
    assert v.columns == df.columns + [r.name for r in RULES]
    assert "quarantine_reason" in q.columns and "_valid" not in q.columns
    assert v.count() + q.count() == df.count()
    assert Q.valid_rows(df, RULES, keep=["id"]).columns == ["id"]
