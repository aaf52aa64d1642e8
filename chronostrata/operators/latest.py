"""One row per key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronostrata.functions import as_date, as_moment


def latest_by_key(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under `order` (give `desc_nulls_first()` where NULL sorts as
    newest). Spark keeps one row per key and map task before it shuffles, so a heavy key
    arrives as a few rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def dedupe(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Repeated source rows: keep one per key."""
    return latest_by_key(df, keys, order)


def latest_as_of(
    df: DataFrame,
    keys: str | Sequence[str],
    ts_col: str,
    d: Column | dt.date | str,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Newest version at or before `d` in an append-only history."""
    order = [F.desc(ts_col), *[F.desc(t) for t in tie]]
    return latest_by_key(df.where(F.col(ts_col) <= as_moment(d)), keys, order)


def last_of_day(df: DataFrame, keys: str | Sequence[str], ts_col: str, tie: Sequence[str] = ()) -> DataFrame:
    """The last row of every (key, day), with the day in `_day`."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [F.desc(ts_col), *[F.desc(t) for t in tie]]
    return latest_by_key(df.withColumn("_day", as_date(F.col(ts_col))), [*keys, "_day"], order)


def latest_attrs(dim: DataFrame, key: str, order: str, cols: Sequence[str]) -> DataFrame:
    """`cols` of the newest version of each key, NULLs included."""
    picked = F.max_by(F.struct(*cols), F.col(order)).alias("_latest")
    return dim.groupBy(key).agg(picked).select(key, *[F.col("_latest")[c].alias(c) for c in cols])
