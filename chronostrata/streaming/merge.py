"""A history fed by a stream that keeps every change, whatever the batches and the order events come in.

A batch writes its events to the log and its changes to the history, and commits both under its number. Keys
with events older than what they have seen are built anew from the log in the same batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronostrata.operators.joins import anti, semi
from chronostrata.operators.merge import SEEN, scd2_merge
from chronostrata.session import cut
from chronostrata.sources.batches import committed, read_part, write_part
from chronostrata.sources.buckets import BUCKET, BucketedHistory

LOG = "log"
LATE = "late"


def history_schema(events: T.StructType, key: str, attrs: Sequence[str], ts_col: str, tie: Sequence[str], grain: str) -> T.StructType:
    """Columns of the current rows of a merged history."""
    at = T.DateType() if grain == "day" else events[ts_col].dataType
    fields = [T.StructField(c, events[c].dataType) for c in (key, *attrs)]
    seen = T.StructType([T.StructField(c, events[c].dataType) for c in (ts_col, *tie)])
    times = [T.StructField("valid_from", at), T.StructField("valid_to", at)]
    return T.StructType([*fields, T.StructField("hashdiff", T.StringType()), *times, T.StructField(SEEN, seen)])


def merge_batch(
    table: BucketedHistory, batch: DataFrame, number: int, attrs: Sequence[str], ts_col: str,
    tie: Sequence[str] = (), grain: str = "day",
) -> None:
    """Merge one batch of events; those without a key are left out. A batch that is already committed is
    left alone; one that was cut off is done again from what was committed before it."""
    spark, key = batch.sparkSession, table.key
    if number in committed(spark, table.root):
        return
    columns = list(dict.fromkeys([key, *attrs, ts_col, *tie]))
    write_part(batch.select(*columns, table.bucket().alias(BUCKET)).where(F.col(key).isNotNull()), table.root, LOG, number, [BUCKET])
    mine = T.StructType([batch.schema[c] for c in columns])
    events = spark.read.schema(mine).parquet(f"{table.root}/{LOG}/batch={number}")
    # At most one number per bucket reaches the driver.
    touched = [r[BUCKET] for r in events.select(table.bucket().alias(BUCKET)).distinct().collect()]
    heads = table.current(spark, before=number, only=touched)
    told = scd2_merge(heads, events, key, attrs, ts_col, tie, grain, write_once=True)
    log = read_part(spark, table.root, LOG, T.StructType([*mine, T.StructField(BUCKET, T.IntegerType())]), before=number)
    # An event the log has is a replay. What is left belongs inside the history.
    first_time = cut(_not_logged(told.late, log, columns))
    write_part(first_time, table.root, LATE, number)
    late_buckets = [r[BUCKET] for r in first_time.select(table.bucket().alias(BUCKET)).distinct().collect()]
    if not late_buckets:
        table.write(number, told.current, told.closed, touched)
        return
    keys = first_time.select(key).distinct()
    # Only the buckets of late keys are read from the log.
    whole = log.where(F.col(BUCKET).isin(late_buckets)).select(*columns).unionByName(events.select(*columns))
    anew = scd2_merge(None, semi(whole, keys, [key]), key, attrs, ts_col, tie, grain, write_once=True)
    current = anti(told.current, keys, [key]).unionByName(anew.current)
    closed = anti(told.closed, keys, [key]).unionByName(anew.closed)
    table.write(number, current, closed, touched, rebuilt=keys)


def _not_logged(late: DataFrame, log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Events that are not in the log; NULL is a value."""
    known = log.select(*[F.col(c).alias(f"_{c}") for c in columns])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]
    return late.select(*columns).distinct().join(known, same, "left_anti")


def merge_foreach_batch(
    table: BucketedHistory, attrs: Sequence[str], ts_col: str, tie: Sequence[str] = (), grain: str = "day"
) -> Callable[[DataFrame, int], None]:
    """For `streaming.history.run_scd2_stream`."""

    def apply(batch: DataFrame, number: int) -> None:
        merge_batch(table, batch, number, attrs, ts_col, tie, grain)

    return apply
