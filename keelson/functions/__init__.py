from keelson.functions.exprs import (  # noqa: F401
    null_safe, epoch_ms, epoch_us, from_epoch_ms, decode_decimal_base64, encode_decimal_base64,
    hash_fraction_keep, date_key, weekday_code, in_comma_list, struct_diff,
)
