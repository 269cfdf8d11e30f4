"""Change-data-capture operators.

Input: transport rows ``(value binary|string, timestamp timestamp)`` holding a
JSON change envelope ``{"payload": {before, after, source{ts_ms, snapshot, db,
table, txId, lsn}, op, ts_ms}}``.  Everything is built-in expressions:
``from_json`` with a declared schema (unknown fields ignored, malformed
records become a NULL payload), nested selects, aggregates and windows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.exprs import decimal_fault, decimal_of_hex, decode_temporal, hex_of_base64, struct_diff
from keelson.spec import TableSpec



def _image_schema(spec: TableSpec) -> T.StructType:
    """Row image as it travels: decimal fields arrive as base64 strings,
    temporal fields as numbers since the epoch."""
    fields = []
    for f in spec.after_schema.fields:
        if f.name in spec.decimals:
            fields.append(T.StructField(f.name, T.StringType(), True))
        elif f.name in spec.temporal:
            unit = spec.temporal[f.name]
            fields.append(T.StructField(f.name, T.IntegerType() if unit == "days" else T.LongType(), True))
        else:
            fields.append(T.StructField(f.name, f.dataType, True))
    return T.StructType(fields)


def envelope_schema(spec: TableSpec) -> T.StructType:
    """Change record, either wrapped (``{"payload": {...}}``, JSON converter
    with schemas on) or bare (the same fields at top level)."""
    record = _record_schema(spec)
    return T.StructType([T.StructField("payload", record, True), *record.fields])


def _record_schema(spec: TableSpec) -> T.StructType:
    image = _image_schema(spec)
    source = T.StructType([
        T.StructField("ts_ms", T.LongType()), T.StructField("snapshot", T.StringType()),
        T.StructField("db", T.StringType()), T.StructField("table", T.StringType()),
        T.StructField("txId", T.LongType()), T.StructField("lsn", T.LongType())])
    payload_fields = []
    if spec.keep_before:
        payload_fields.append(T.StructField("before", image, True))
    payload_fields += [T.StructField("after", image, True), T.StructField("source", source, True),
                       T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())]
    return T.StructType(payload_fields)


def _decoded_image(img: Column, spec: TableSpec, decimals: Column) -> list[Column]:
    """Columns of a row image; ``decimals`` holds its decoded decimals."""
    out = []
    for f in spec.after_schema.fields:
        if f.name in spec.decimals:
            out.append(decimals[f.name].alias(f.name))
        elif f.name in spec.temporal:
            out.append(decode_temporal(img[f.name], spec.temporal[f.name]).alias(f.name))
        else:
            out.append(img[f.name].alias(f.name))
    return out


def _with_decimals(df: DataFrame, images: dict[str, Column], spec: TableSpec) -> DataFrame:
    """Adds, for each named image, a struct of its decoded decimals.  Two
    projections: the first computes the hex digits, the second reads them
    several times, which keeps Catalyst from merging the two."""
    if not spec.decimals:
        return df.withColumns({out: F.lit(None).cast("struct<none:int>") for out in images})
    if spec.decimal_encoding == "base64":
        df = df.withColumns({f"__{out}_{n}": hex_of_base64(img[n]) for out, img in images.items() for n in spec.decimals})
        value = {(out, n): decimal_of_hex(f"__{out}_{n}", p, s) for out in images for n, (p, s) in spec.decimals.items()}
    else:
        value = {(out, n): img[n].try_cast(f"decimal({p},{s})") for out, img in images.items() for n, (p, s) in spec.decimals.items()}
    return df.withColumns({out: F.struct(*[value[out, n].alias(n) for n in spec.decimals]) for out in images})


def _decodable(img: Column, decoded: Column, spec: TableSpec) -> Column:
    """Every decimal that was sent is decoded (NULL images pass)."""
    ok = F.lit(True)
    for name in spec.decimals:
        ok = ok & ~decimal_fault(img[name], decoded[name])
    return F.coalesce(ok, F.lit(True))


def parse_raw(raw: DataFrame, spec: TableSpec, value_col: str = "value",
              ts_col: str = "timestamp", keep=None, decode: bool = False) -> DataFrame:
    """Transport rows -> ``json_value, kafka_timestamp, p`` (the parsed
    payload, NULL when the message is not a valid envelope).

    The record may come wrapped (``{"payload": ...}``) or bare.  With
    ``decode`` the decoded decimals of the after image come as ``d``.  With
    ``keep`` (a predicate on the payload and, with ``decode``, its decimals)
    only matching rows are returned.
    Parse and decode are projected columns read by a generator,
    ``explode(when(keep, array(record)))``, rather than followed by a
    ``filter``: Catalyst pushes a filter below the projection by
    substituting the calls into it (doing them twice for every message), and
    would inline the parse into each reference of a collapsed projection; a
    generator's input stays a projected column, so each message is parsed,
    and each decimal decoded, exactly once, in compiled code.
    """
    msgs = raw.select(F.col(value_col).cast("string").alias("json_value"),
                      F.col(ts_col).alias("kafka_timestamp"),
                      F.from_json(F.col(value_col).cast("string"), envelope_schema(spec)).alias("__env"))
    env = F.col("__env")
    bare_fields = [f.name for f in _record_schema(spec).fields]
    bare = F.when(env.getField("op").isNotNull(), F.struct(*[env.getField(n).alias(n) for n in bare_fields]))
    msgs = msgs.select("json_value", "kafka_timestamp", F.coalesce(env.getField("payload"), bare).alias("p"))
    given = ["p"]
    if decode:
        msgs = _with_decimals(msgs, {"d": F.col("p.after")}, spec)
        given.append("d")
    record = F.array(F.struct(*given))
    rows = record if keep is None else F.when(keep(*[F.col(g) for g in given]), record)
    return (msgs.select("json_value", "kafka_timestamp", F.explode(rows).alias("__r"))
            .select("json_value", "kafka_timestamp", *[F.col(f"__r.{g}").alias(g) for g in given]))


def _meta(spec: TableSpec) -> list[Column]:
    return [F.col("p.op").alias("cdc_operation"),
            F.col("p.source.ts_ms").alias("source_ts_ms"),
            F.col("p.source.snapshot").alias("is_snapshot"),
            F.col("p.source.txId").alias("source_tx_id"),
            F.col("p.source.lsn").alias("source_lsn"),
            F.col("kafka_timestamp"),
            F.lit(spec.source_system).alias("_source_system")]


def parse_envelope(raw: DataFrame, spec: TableSpec, **kw) -> DataFrame:
    """Bronze rows in the captured form: the after image flattened plus change
    metadata; deletes (no after image), unparsable messages and those with
    an undecodable decimal are left out (the key must be in the after
    image); ``dead_letters`` returns the last two."""
    def keep(p, d):
        ok = p.isNotNull()
        for k in spec.key:
            ok = ok & p["after"][k].isNotNull()
        return ok & _decodable(p["after"], d, spec)
    parsed = parse_raw(raw, spec, keep=keep, decode=True, **kw)
    return parsed.select(*_decoded_image(F.col("p.after"), spec, F.col("d")), *_meta(spec))


def parse_changes(raw: DataFrame, spec: TableSpec, **kw) -> DataFrame:
    """All parsed changes, deletes included: the key comes from the after
    image, else from the before image; value columns come from the after
    image (NULL for a delete).  ``_before`` keeps the decoded before image,
    ``_no_before`` tells an absent before image from an all-NULL one."""
    def key_of(p, k):
        return F.coalesce(p["after"][k], p["before"][k]) if spec.keep_before else p["after"][k]

    def keep(p, d):
        ok = p.isNotNull()
        for k in spec.key:
            ok = ok & key_of(p, k).isNotNull()
        return ok & _decodable(p["after"], d, spec)
    parsed = parse_raw(raw, spec, keep=keep, decode=True, **kw)
    p = F.col("p")
    key_cols = [key_of(p, k).alias(k) for k in spec.key]
    after, before = F.col("p.after"), F.col("p.before")
    value_cols = [c for c, f in zip(_decoded_image(after, spec, F.col("d")), spec.after_schema.fields)
                  if f.name not in spec.key]
    extra = []
    if spec.keep_before:
        parsed = _with_decimals(parsed, {"b": before}, spec)
        extra = [F.struct(*_decoded_image(before, spec, F.col("b"))).alias("_before"),
                 before.isNull().alias("_no_before")]
    return parsed.select(*key_cols, *value_cols, *_meta(spec), *extra)


def dead_letters(raw: DataFrame, spec: TableSpec, **kw) -> DataFrame:
    """Messages that ``parse_changes`` leaves out, with their text, their
    transport time and the reason: not an envelope, no key, or a decimal
    that cannot be decoded.  Parsed rows and dead letters together are all
    messages."""
    p = F.col("p")
    has_key = F.lit(True)
    for k in spec.key:
        has_key = has_key & (F.coalesce(p["after"][k], p["before"][k]) if spec.keep_before else p["after"][k]).isNotNull()
    reason = (F.when(p.isNull(), "unparsable").when(~has_key, "no key")
              .when(~_decodable(p["after"], F.col("d"), spec), "undecodable decimal"))
    parsed = parse_raw(raw, spec, decode=True, **kw)
    return parsed.select("json_value", "kafka_timestamp", reason.alias("reason")).filter(F.col("reason").isNotNull())


def ledger_rows(changes: DataFrame, spec: TableSpec, order: Sequence[str] | None = None) -> DataFrame:
    """Rows of an append-only ledger that stand: a delete takes back all
    earlier rows of its key; rows written after it count again.  The last
    delete per key is an aggregate, joined back to the rows."""
    order = [c for c in (order or spec.order) if c in changes.columns]
    last = (changes.filter(F.col("cdc_operation") == "d").groupBy(*spec.key)
            .agg(F.max(_order_struct(order)).alias("__deleted")))
    rows = changes.filter(F.col("cdc_operation") != "d").join(last, list(spec.key), "left")
    stands = F.col("__deleted").isNull() | (_order_struct(order) > F.col("__deleted"))
    return rows.filter(stands).drop("__deleted").select(*changes.columns)


def parse_stats(raw: DataFrame, spec: TableSpec, **kw) -> DataFrame:
    """Diagnostic: messages, parsed envelopes and rows with a key, by op."""
    parsed = parse_raw(raw, spec, **kw)
    key_present = F.lit(True)
    for k in spec.key:
        key_present = key_present & F.col(f"p.after.{k}").isNotNull()
    return (parsed.groupBy(F.col("p.op").alias("cdc_operation"))
            .agg(F.count(F.lit(1)).alias("n_messages"),
                 F.count_if(F.col("p").isNotNull()).alias("n_parsed"),
                 F.count_if(key_present).alias("n_with_after_key")))


#: What a declared type may look like in a JSON image.
_KINDS = {"int": ["integer"], "bigint": ["integer"], "smallint": ["integer"], "tinyint": ["integer"], "double": ["integer", "number"],
          "float": ["integer", "number"], "string": ["string"], "boolean": ["boolean"]}


def _accepted_kinds(spec: TableSpec) -> dict[str, list[str]]:
    out = {}
    for f in spec.after_schema.fields:
        if f.name in spec.decimals:
            out[f.name] = ["string"] if spec.decimal_encoding == "base64" else ["string", "integer", "number"]
        elif f.name in spec.temporal:
            out[f.name] = ["integer"]
        else:
            out[f.name] = _KINDS.get(f.dataType.simpleString(), ["string"])
    return out


def schema_drift(raw: DataFrame, spec: TableSpec, value_col: str = "value") -> DataFrame:
    """What the images hold against what the spec declares: ``table_name``,
    ``column_name``, ``issue``, ``observed``, ``n_rows``.

    * ``undeclared``: a field of some after image that the spec has not (the
      parser ignores it);
    * ``retyped``: a declared field whose values are of another kind (the
      parser reads them as NULL), a row for each kind;
    * ``vanished``: a declared field that no after image has.

    Images are parsed as VARIANT, without a schema; their fields are counted
    by name and kind, so what is shuffled is a few rows per task.  JSON null
    is of every kind; unparsable messages and deletes have no image."""
    v = F.try_parse_json(F.col(value_col).cast("string"))
    image = F.coalesce(F.try_variant_get(v, "$.payload.after", "map<string,variant>"), F.try_variant_get(v, "$.after", "map<string,variant>"))
    fields = raw.select(F.explode(image).alias("column_name", "v"))
    t = F.schema_of_variant("v")
    kind = (F.when(t == "BIGINT", "integer").when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "number").when(t == "STRING", "string")
            .when(t == "BOOLEAN", "boolean").when(t == "VOID", "null").otherwise("nested"))
    seen = fields.groupBy("column_name", kind.alias("observed")).agg(F.count(F.lit(1)).alias("n_rows"))
    allowed = F.create_map(*[F.lit(x) for n, kinds in _accepted_kinds(spec).items() for x in (n, ",".join([*kinds, "null"]))])
    declared = allowed[F.col("column_name")]
    issue = F.when(declared.isNull(), "undeclared").when(~F.array_contains(F.split(declared, ","), F.col("observed")), "retyped")
    # one row per declared field: the spec bounds it
    names = raw.sparkSession.createDataFrame([(n,) for n in spec.row_fields], "column_name string")
    gone = names.join(seen, "column_name", "left_anti").select(
        "column_name", F.lit(None).cast("string").alias("observed"), F.lit(0).cast("bigint").alias("n_rows"), F.lit("vanished").alias("issue"))
    rows = seen.withColumn("issue", issue).filter("issue is not null").unionByName(gone)
    return rows.select(F.lit(spec.name).alias("table_name"), "column_name", "issue", "observed", "n_rows")


def sample(bronze: DataFrame, n: int, order: Sequence[str], text_cols: dict[str, int]) -> DataFrame:
    """First ``n`` rows in a deterministic order with text columns cut to a
    prefix (inspection output; the limit is the feature).  Spark plans this
    as TakeOrderedAndProject: a per-partition top-n, no full sort."""
    out = bronze.orderBy(*order).limit(n)
    return out.withColumns({c: F.substring(F.col(c), 1, k) for c, k in text_cols.items()})


def dedupe_changes(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop repeated deliveries of the same change: one row per (key,
    change id).  The change id is the log position plus commit time,
    transaction and operation, so sources that send no log position still
    keep every version.  Near-unique, so the shuffle is balanced."""
    return changes.dropDuplicates([*spec.key, *spec.change_id])


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def current_state(changes: DataFrame, spec: TableSpec, order: Sequence[str] | None = None) -> DataFrame:
    """Latest version per key as an aggregate: ``max_by(row, (ts, lsn, ...))``.

    An aggregate, so Spark pre-aggregates map-side: a key holding a third of
    all changes still ships one row per map task, unlike a window that sorts
    the whole key in one task.  Ties in the order are broken by the next
    order column; rows equal in all of them are repeated deliveries.
    """
    order = list(order or spec.order)
    order = [c for c in order if c in changes.columns]
    rest = [c for c in changes.columns if c not in spec.key]
    latest = (changes.groupBy(*spec.key)
              .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), _order_struct(order)).alias("__r")))
    return latest.select(*spec.key, *[F.col(f"__r.{c}").alias(c) for c in rest])


def current_state_window(changes: DataFrame, spec: TableSpec, order: Sequence[str] | None = None) -> DataFrame:
    """Same result as ``current_state`` in the window form:
    ``row_number() over (partition by key order by ts desc, lsn desc) = 1``
    (Spark plans a partial + final WindowGroupLimit)."""
    order = [c for c in (order or spec.order) if c in changes.columns]
    w = Window.partitionBy(*spec.key).orderBy(*[F.col(c).desc() for c in order])
    return changes.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def current_state_with_deletes(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Current state where a key whose latest change is a delete is gone.
    Before images are no state: they are left out before the shuffle."""
    images = [c for c in ("_before", "_no_before") if c in changes.columns]
    return current_state(changes.drop(*images), spec).filter(F.col("cdc_operation") != "d")


def change_diff(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Per change, the value fields that differ between the before image and
    the after image (NULL-aware), sorted and comma joined."""
    after = F.struct(*[F.col(c) for c in spec.row_fields])
    before = F.when(~F.col("_no_before"), F.col("_before"))
    return changes.withColumn("changed_columns", struct_diff(before, after, spec.value_fields))
