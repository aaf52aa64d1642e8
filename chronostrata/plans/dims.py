"""Dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronostrata import fixed_values as fv
from chronostrata.functions import as_date, date_key, valid_at
from chronostrata.operators.history import scd2_backfill, scd2_kept, scd2_opened, stamp
from chronostrata.operators.keys import assign_keys, next_key


def dim_date(
    spark: SparkSession,
    date_from: dt.date | str = fv.CALENDAR_FROM,
    date_to: dt.date | str = fv.CALENDAR_TO,
) -> DataFrame:
    """One row per day from `date_from` to `date_to`."""
    bounds = spark.range(1).select(as_date(date_from).alias("date_from"), as_date(date_to).alias("date_to"))
    return calendar(bounds)


def calendar(bounds: DataFrame) -> DataFrame:
    """Calendar over the one row `(date_from, date_to)` of `bounds`, which may come from data."""
    filled = bounds.where("date_from <= date_to")
    days = filled.select(F.explode(F.sequence("date_from", "date_to")).alias("d"))
    d = F.col("d")
    small = {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "day": F.day(d),
    }
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("date_actual"),
        *[c.cast("smallint").alias(n) for n, c in small.items()],
        F.date_format(d, "EEEE").alias("weekday_name"),
        (F.dayofweek(d) - 1).cast("smallint").alias("weekday_num"),
        (F.day(d) <= fv.FIRST_WEEK_LAST_DAY).alias("is_first_week"),
    )


def dim_product(products: DataFrame) -> DataFrame:
    """Full reload, numbered by business key."""
    rows = products.select(F.col("product_id").alias("product_bk"), F.col("name").alias("product_name"))
    return assign_keys(rows, ["product_bk"], "product_sk")


def dim_history(
    events: DataFrame,
    key: str,
    attrs: Sequence[str],
    ts_col: str,
    tie: Sequence[str],
    sk: str,
    run_ts: dt.datetime,
    bk: str = "customer_bk",
) -> DataFrame:
    """History dimension from all events, daily periods, numbered in the order (bk, valid_from)."""
    periods = scd2_backfill(events.withColumnRenamed(key, bk), bk, attrs, ts_col, tie)
    return stamp(assign_keys(periods, [bk, "valid_from"], sk), run_ts)


def dim_history_increment(
    dim: DataFrame,
    snapshot: DataFrame,
    key: str,
    attrs: Sequence[str],
    eff_col: str,
    sk: str,
    run_ts: dt.datetime,
    bk: str = "customer_bk",
) -> DataFrame:
    """Next version of a history dimension; opened rows get numbers above the ones in use."""
    snapshot = snapshot.withColumnRenamed(key, bk)
    opened = scd2_opened(dim, snapshot, bk, attrs, eff_col)
    numbered = assign_keys(opened, [bk, "valid_from"], sk, start=next_key(dim, sk))
    return scd2_kept(dim, snapshot, bk, attrs, eff_col, run_ts).unionByName(stamp(numbered, run_ts))


def normalise_attribute(dim: DataFrame, attr: str, sk: str) -> tuple[DataFrame, DataFrame]:
    """Move `attr` into a table of its own: `(lookup, dim with the lookup's key instead)`."""
    lookup = assign_keys(dim.select(attr).where(F.col(attr).isNotNull()).distinct(), [attr], sk)
    return lookup, dim.join(lookup, attr, "left").drop(attr)


def status_at(history: DataFrame, d: Column | dt.date | str, key: str, cols: Sequence[str]) -> DataFrame:
    """State of every key on one day."""
    return history.where(valid_at(as_date(d))).select(key, *cols)
