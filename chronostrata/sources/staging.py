"""Raw batches into staging."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronostrata.functions import as_moment
from chronostrata.sources.schemas import LOAD_META, staging_schema

# An unquoted blank is a missing value, a quoted blank ("") is an empty text.
CSV_OPTIONS = {"header": "true", "nullValue": "\\N", "emptyValue": "", "mode": "PERMISSIVE", "enforceSchema": "false"}


def read_stg_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """CSV files with a header, every column text. `columns` is the header of the file, load
    metadata included where the file carries it."""
    return spark.read.schema(staging_schema(columns, load_meta=False)).options(**CSV_OPTIONS).csv(path)


def stage_rows(
    spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str], load_id: str, load_ts: dt.datetime
) -> DataFrame:
    """A literal batch."""
    return with_load_meta(spark.createDataFrame(list(rows), staging_schema(columns, load_meta=False)), load_id, load_ts)


def with_load_meta(df: DataFrame, load_id: str, run_ts: dt.datetime) -> DataFrame:
    """Stamp `_load_id` and `_load_ts`; values that came with the rows are kept."""
    wanted = {"_load_id": (F.lit(load_id), "string"), "_load_ts": (as_moment(run_ts), "timestamp_ntz")}
    stamped = {}
    for name in LOAD_META:
        default, kind = wanted[name]
        default = default.cast(kind)
        stamped[name] = F.coalesce(F.col(name).try_cast(kind), default) if name in df.columns else default
    return df.withColumns(stamped)
