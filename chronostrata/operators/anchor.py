"""Anchor modelling: a table of keys, one history per attribute, ties between entities."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata.functions import differs
from chronostrata.operators.latest import latest_as_of
from chronostrata.operators.ordered import HOT_ROWS, in_order, with_prev


def anchor(events: DataFrame, key: str) -> DataFrame:
    return events.select(key).distinct()


def anchor_split(
    events: DataFrame,
    key: str,
    attrs: Sequence[str],
    ts_col: str,
    tie: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> dict[str, DataFrame]:
    """History of each attribute by itself: `{attr: (key, attr, valid_from)}`, one row per change.
    All attributes read their previous value in the same window."""
    rows = in_order(events.select(key, *attrs, ts_col, *tie), key, (ts_col, *tie), hot_rows)
    seen = {f"_before_{a}": a for a in attrs}
    told = with_prev(rows, {**seen, "_had_row": F.lit(True)}).plain()
    return {
        a: told.where(F.col("_had_row").isNull() | differs(a, f"_before_{a}")).select(
            key, a, F.col(ts_col).alias("valid_from")
        )
        for a in attrs
    }


def tie(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct pairs of related keys."""
    return df.select(*keys).distinct()


def anchor_as_of(
    keys: DataFrame, attributes: Mapping[str, DataFrame], key: str, d: Column | dt.date | str
) -> DataFrame:
    """The entity as it was at `d`: every key with the value of each attribute, NULL before its
    first one."""
    result = keys
    for attr, history in attributes.items():
        result = result.join(latest_as_of(history, key, "valid_from", d).select(key, attr), key, "left")
    return result
