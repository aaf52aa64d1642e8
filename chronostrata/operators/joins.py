"""Joins on key and time. No side is broadcast by hint: Spark broadcasts what its own size
estimate allows and otherwise shuffles, splitting skewed partitions at run time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronostrata.functions import as_date, differs, valid_at
from chronostrata.operators.ordered import HOT_ROWS, carry_last, in_order

MAX_VERSIONS = 64


def anti(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b.select(*keys), list(keys), "left_anti")


def semi(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b.select(*keys), list(keys), "left_semi")


def new_or_changed(src: DataFrame, current: DataFrame, key: str, hash_col: str = "hashdiff") -> DataFrame:
    """Rows of `src` whose key has no row in `current` or whose hash is another one."""
    known = current.select(F.col(key).alias("_key"), F.col(hash_col).alias("_hash"))
    joined = src.join(known, F.col(key) == F.col("_key"), "left")
    return joined.where(F.col("_key").isNull() | differs(hash_col, "_hash")).drop("_key", "_hash")


def join_as_of(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    ts_col: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    closed: bool = False,
    max_versions: int = MAX_VERSIONS,
) -> DataFrame:
    """Each fact with the version valid at its time; facts without one are left out.

    A fact gets one version at most: of the versions that start at or before its time the last one, if
    it is still valid. Versions of equal start are ordered by a hash of their columns, empty periods do not
    count. So touching and overlapping periods give the same rows whatever the length of a history.

    The longest history of a key is looked up first (one count over the key column of
    `history`). Up to `max_versions` rows the join is equality on the key with the period as a
    condition, so that a small history is broadcast and the facts stay where they are. Above it
    a heavy key would compare all its facts to all its versions; `join_as_of_long` does not.
    """
    history = _periods(history, valid_from, valid_to, closed)
    longest = history.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    if longest > max_versions:
        return join_as_of_long(facts, history, key, ts_col, valid_from, valid_to, closed)
    following = F.lead(valid_from).over(Window.partitionBy(key).orderBy(valid_from, _version_order(history, key)))
    versions = history.withColumn("_next", following).withColumnRenamed(key, "_key")
    at = valid_at(facts[ts_col], versions[valid_from], versions[valid_to], closed)
    last = versions["_next"].isNull() | (facts[ts_col] < versions["_next"])
    return facts.join(versions, (facts[key] == versions["_key"]) & at & last).drop("_key", "_next")


def _periods(history: DataFrame, valid_from: str, valid_to: str, closed: bool) -> DataFrame:
    """Without the periods that hold no moment."""
    start, end = F.col(valid_from), F.col(valid_to)
    return history.where(end.isNull() | (end >= start if closed else end > start))


def _version_order(history: DataFrame, key: str) -> Column:
    return F.xxhash64(*[c for c in history.columns if c != key])


def join_as_of_long(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    ts_col: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    closed: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """`join_as_of` for histories of any length.

    Facts and versions are sorted together by (key, time) and the last version carried on to
    the facts after it.
    """
    history = _periods(history, valid_from, valid_to, closed)
    version_cols = [c for c in history.columns if c != key]
    fact_cols = [c for c in facts.columns if c != key]
    version, fact = F.struct(*version_cols), F.struct(*fact_cols)
    starts = history.select(
        key, F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"), _version_order(history, key).alias("_nth"),
        version.alias("_version"), F.lit(None).alias("_fact"),
    )
    # Facts of one moment need no order among themselves; the id only makes it total.
    asked = facts.select(
        key, F.col(ts_col).alias("_at"), F.lit(1).alias("_kind"), F.xxhash64(*facts.columns).alias("_nth"),
        F.lit(None).alias("_version"), fact.alias("_fact"),
    )
    rows = in_order(starts.union(asked), key, ("_at", "_kind", "_nth"), hot_rows)
    found = carry_last(rows, "_version", "_valid").plain().where(F.col("_fact").isNotNull())
    found = found.where(valid_at(F.col("_at"), F.col("_valid")[valid_from], F.col("_valid")[valid_to], closed))
    return found.select(
        key,
        *[F.col("_fact")[c].alias(c) for c in fact_cols],
        *[F.col("_valid")[c].alias(c) for c in version_cols],
    )


def expand_days(
    history: DataFrame,
    date_from: Column | dt.date | str,
    date_to: Column | dt.date | str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    name: str = "date_actual",
) -> DataFrame:
    """One row per version and day it was valid on, days from `date_from` to `date_to` (both
    included). Each period makes its own days, so the calendar needs no range join."""
    first = F.greatest(as_date(F.col(valid_from)), as_date(date_from))
    last = F.least(F.coalesce(F.date_sub(as_date(F.col(valid_to)), 1), as_date(date_to)), as_date(date_to))
    bounded = history.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    return bounded.withColumn(name, F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")


def date_bounds(df: DataFrame, date_from: Column, date_to: Column) -> DataFrame:
    """One row with the first and last day found."""
    return df.agg(F.min(date_from).alias("date_from"), F.max(date_to).alias("date_to"))
