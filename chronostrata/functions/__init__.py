from chronostrata.functions.cleaning import (
    amount,
    blank_to_null,
    conform_key,
    date_key,
    differs,
    is_decimal,
    is_digits,
    is_email,
    normalize_phone,
    segment,
    to_date_lenient,
    to_int,
    to_money,
    to_ts,
)
from chronostrata.functions.hashing import hash_key, hashdiff, register_hash_function, version_key
from chronostrata.functions.periods import (
    as_date,
    as_moment,
    effective_date,
    effective_ts,
    in_last_days,
    is_current,
    valid_at,
)

__all__ = [
    "amount",
    "as_date",
    "as_moment",
    "blank_to_null",
    "conform_key",
    "date_key",
    "differs",
    "effective_date",
    "effective_ts",
    "hash_key",
    "hashdiff",
    "in_last_days",
    "is_current",
    "is_decimal",
    "is_digits",
    "is_email",
    "normalize_phone",
    "register_hash_function",
    "segment",
    "to_date_lenient",
    "to_int",
    "to_money",
    "to_ts",
    "valid_at",
    "version_key",
]
