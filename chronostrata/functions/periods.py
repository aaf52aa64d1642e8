"""Time predicates. Periods are half-open `[valid_from, valid_to)` with an open end while
current, unless `closed=True` (price lists)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d: Column | dt.date | str) -> Column:
    """A run-date argument (date, ISO text or expression) as a date expression."""
    return d.cast("date") if isinstance(d, Column) else F.lit(str(d)).cast("date")


def as_moment(d: Column | dt.datetime | dt.date | str) -> Column:
    """A run-time argument as an expression. A datetime is taken as written, without a time zone;
    Python's and the session's need not agree."""
    if isinstance(d, dt.datetime):
        return F.lit(d.isoformat(sep=" ")).cast("timestamp_ntz")
    return d if isinstance(d, Column) else F.lit(d)


def effective_ts(event_ts: Column | str, load_ts: Column | str) -> Column:
    return F.coalesce(_col(event_ts), _col(load_ts))


def effective_date(event_ts: Column | str, load_ts: Column | str) -> Column:
    return effective_ts(event_ts, load_ts).cast("date")


def valid_at(
    d: Column,
    valid_from: Column | str = "valid_from",
    valid_to: Column | str = "valid_to",
    closed: bool = False,
) -> Column:
    start, end = _col(valid_from), _col(valid_to)
    return (d >= start) & (end.isNull() | ((d <= end) if closed else (d < end)))


def is_current(valid_to: Column | str = "valid_to") -> Column:
    return _col(valid_to).isNull()


def in_last_days(d: Column | str, as_of: Column | dt.date | str, days: int) -> Column:
    """From `days` days before `as_of` up to and including it."""
    # The column itself is compared, so that both bounds reach the scan.
    return (_col(d) >= F.date_sub(as_date(as_of), days)) & (_col(d) < F.date_add(as_date(as_of), 1))
