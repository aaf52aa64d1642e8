"""Daily status snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronostrata.functions import as_date
from chronostrata.operators.joins import expand_days, semi


def mart_status_daily(
    history: DataFrame, dates: DataFrame, as_of: Column | dt.date | str, status: str = "status"
) -> DataFrame:
    """Keys per status and day, from the first day of the history to `as_of` or the last end of
    a period, within the calendar `dates`.

    A key holds one status at a time, so counting distinct keys equals adding one where a period
    begins and taking one off where it ends. Changes per (status, day) are summed map-side; what
    follows has at most statuses times days rows, however many keys there are.
    """
    steps = history.select(
        status,
        F.explode(
            F.array(
                F.struct(as_date(F.col("valid_from")).alias("day"), F.lit(1).alias("step")),
                F.struct(as_date(F.col("valid_to")).alias("day"), F.lit(-1).alias("step")),
            )
        ).alias("s"),
    ).select(status, "s.day", "s.step").where("day IS NOT NULL")
    daily = steps.groupBy(status, "day").agg(F.sum("step").alias("step"))
    by_day = Window.partitionBy(status).orderBy("day")
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = daily.select(
        status,
        F.col("day").alias("valid_from"),
        F.lead("day").over(by_day).alias("valid_to"),
        F.sum("step").over(running).alias("customers_cnt"),
    ).where("customers_cnt > 0")
    # The last day anything is known: an open period reaches `as_of`.
    until = history.agg(F.max(F.coalesce(as_date(F.col("valid_to")), as_date(as_of)))).scalar()
    days = expand_days(levels, F.col("valid_from"), until)
    return semi(days.select("date_actual", status, "customers_cnt"), dates, ["date_actual"])
