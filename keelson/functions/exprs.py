"""Column expressions. All built-in Spark functions: no UDFs, full codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe(cond: Column) -> Column:
    """A check passes only when it is TRUE; NULL counts as failed.

    Plain ``filter(c)`` / ``filter(~c)`` both drop a NULL row, so a split
    on a raw check loses rows; wrapping every check keeps the split whole.
    """
    return F.coalesce(cond, F.lit(False))


def epoch_us(ts) -> Column:
    """Microseconds since epoch of a timestamp_ntz / timestamp, zone-free."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _c(ts).cast("timestamp_ntz"))


def epoch_ms(ts) -> Column:
    """Milliseconds since epoch, truncated (floor for post-1970 values)."""
    return F.floor(epoch_us(ts).cast("decimal(20,0)") / F.lit(1000)).cast("bigint")


def from_epoch_ms(ms) -> Column:
    """Epoch milliseconds -> timestamp_ntz (UTC wall clock), zone-free."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def decode_temporal(value, unit: str) -> Column:
    """Number since the epoch -> timestamp_ntz ("micros", "millis") or date
    ("days"): the capture tool's default JSON encodings of TIMESTAMP and
    DATE columns."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    if unit == "micros":
        return F.timestamp_add("MICROSECOND", _c(value), epoch)
    if unit == "millis":
        return F.timestamp_add("MILLISECOND", _c(value), epoch)
    if unit == "days":
        return F.date_add(F.lit("1970-01-01").cast("date"), _c(value))
    raise ValueError(f"unknown temporal unit {unit!r}")


def encode_decimal_base64(value, scale: int) -> Column:
    """Change-capture encoding of a decimal: base64 of the big-endian
    two's-complement unscaled value (8 bytes here).  Used to build test
    envelopes; the decoder accepts any length."""
    unscaled = F.round(_c(value) * F.lit(10 ** scale)).cast("bigint")
    return F.base64(F.unhex(F.lpad(F.hex(unscaled), 16, "0")))


def hex_of_base64(b64) -> Column:
    """Hex digits of strict base64 text; NULL when it is malformed."""
    return F.hex(F.try_to_binary(_c(b64), F.lit("base64")))


def decimal_of_hex(digits, precision: int, scale: int) -> Column:
    """Decimal of the hex digits of a big-endian two's-complement unscaled value.

    Up to 8 bytes (nearly all values) the digits are extended by their sign
    and read as one number.  Longer ones are extended or, where only sign
    bytes go, cut to 128 bits and read as two halves.  The scale is applied
    as a decimal exponent of the text, so every scale is exact.  NULL for no
    digits and for a value that does not fit ``decimal(precision, scale)``.

    ``digits`` is used several times: give a column that a projection of its
    own has computed (Catalyst does not inline it then).
    """
    h = _c(digits)
    sign = F.when(h >= "8", "F").otherwise("0")
    short = F.conv(F.lpad(h, 16, sign), 16, -10)
    signed = F.concat(F.repeat(sign, F.lit(32)), h)
    wide = F.regexp_extract(signed, "^(?:0*(?=[0-7].{31}$)|F*(?=[89A-F].{31}$))([0-9A-F]{32})$", 1)
    high = F.conv(F.substring(wide, 1, 16), 16, -10).cast("decimal(20,0)")
    low = F.conv(F.substring(wide, 17, 16), 16, 10).cast("decimal(20,0)")
    long = F.try_add(F.try_multiply(high, F.lit(str(1 << 64)).cast("decimal(20,0)")), low).cast("decimal(38,0)").cast("string")
    unscaled = F.when(F.length(h) <= 16, short).otherwise(long)
    return F.when(h != "", F.concat(unscaled, F.lit(f"E-{scale}"))).try_cast(f"decimal({precision},{scale})")


def decode_decimal_base64(b64, precision: int, scale: int) -> Column:
    """Decode a base64 two's-complement unscaled integer of any length into a
    decimal; NULL for malformed text, an empty value and a value that does
    not fit (``decimal_fault`` tells those from a NULL that was sent).

    One expression, for a column or two; ``operators.cdc`` binds the digits
    by a projection and calls ``decimal_of_hex``."""
    return decimal_of_hex(hex_of_base64(b64), precision, scale)


def decimal_fault(sent, decoded) -> Column:
    """A decimal that was sent but could not be decoded."""
    return _c(sent).isNotNull() & _c(decoded).isNull()


def hash_fraction_keep(key, fraction: float, salt: str = "") -> Column:
    """Repeatable fraction filter: keep a row when the first 15 hex digits of
    md5(salt || key) are below ``fraction``·16^15.  Compared as strings (fixed
    width lowercase hex), which orders like the numbers."""
    threshold = round(fraction * 16 ** 15)
    if threshold >= 16 ** 15:
        return F.lit(True)
    bound = format(threshold, "015x")
    h = F.substring(F.md5(F.concat(F.lit(salt), _c(key).cast("string"))), 1, 15)
    return h < F.lit(bound)


def date_key(d) -> Column:
    """yyyyMMdd integer key of a date."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def weekday_code(d) -> Column:
    """Three-letter upper-case weekday (MON..SUN) of a date."""
    return F.upper(F.date_format(_c(d), "EEE"))


def in_comma_list(list_col, value: Column) -> Column:
    """Membership of ``value`` in a comma separated list such as 'MON,WED'."""
    return F.array_contains(F.split(F.regexp_replace(_c(list_col), r"\s", ""), ","), value)


def struct_diff(before, after, fields: list[str]) -> Column:
    """Sorted, comma joined names of the fields whose value differs
    (NULL-aware) between two row images."""
    names = [F.when(~_c(before)[f].eqNullSafe(_c(after)[f]), F.lit(f)) for f in fields]
    return F.array_join(F.array_sort(F.filter(F.array(*names), lambda x: x.isNotNull())), ",")
