"""Column expressions that turn staged text into typed values. A value that does not
parse becomes NULL instead of failing the job; `split_rejects` reports it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronostrata import fixed_values as fv


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def to_int(c: Column | str, kind: str = "int") -> Column:
    """Text to a whole number; `kind="bigint"` for key ranges beyond 2^31."""
    return _col(c).try_cast(kind)


def to_date_lenient(c: Column | str) -> Column:
    """Text to date; `2024-1-5` is accepted as well as `2024-01-05`."""
    return F.try_to_date(blank_to_null(c), fv.DATE_PATTERN)


def to_ts(c: Column | str) -> Column:
    return blank_to_null(c).try_cast("timestamp_ntz")


def to_money(c: Column | str) -> Column:
    return blank_to_null(c).try_cast("decimal(10,2)")


def is_digits(c: Column | str) -> Column:
    """Never NULL: a missing key is not digits."""
    return F.coalesce(_col(c).rlike(fv.DIGITS), F.lit(False))


def is_decimal(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(fv.DECIMAL), F.lit(False))


def is_email(c: Column | str) -> Column:
    return F.coalesce(F.trim(_col(c)).rlike(fv.EMAIL), F.lit(False))


def normalize_phone(c: Column | str) -> Column:
    """Digits only; a trunk prefix 8 and a missing country code both become 7."""
    digits = F.regexp_replace(_col(c), fv.NON_DIGIT, "")
    return F.nullif(
        F.when((F.length(digits) == 11) & digits.startswith("8"), F.concat(F.lit("7"), F.substr(digits, F.lit(2))))
        .when(F.length(digits) == 10, F.concat(F.lit("7"), digits))
        .otherwise(digits),
        F.lit(""),
    )


def conform_key(c: Column | str, pattern: str = r"^[A-Za-z]+-", kind: str = "int") -> Column:
    """One spelling of a business key: the source prefix and leading zeros are dropped."""
    return to_int(F.regexp_replace(F.trim(_col(c).cast("string")), pattern, ""), kind)


def amount(price: Column | str, quantity: Column | str) -> Column:
    return (_col(price) * _col(quantity)).cast("decimal(18,2)")


def date_key(d: Column | str) -> Column:
    """YYYYMMDD as a number, by arithmetic: no text is made and no time zone taken."""
    d = _col(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.day(d)


def segment(c: Column | str, threshold: float = fv.PREMIUM_THRESHOLD) -> Column:
    return F.when(_col(c) >= F.lit(threshold), F.lit(fv.PREMIUM)).otherwise(F.lit(fv.BASIC))


def differs(a: Column | str, b: Column | str) -> Column:
    """Not equal, with NULL as a value of its own."""
    return ~_col(a).eqNullSafe(_col(b))
