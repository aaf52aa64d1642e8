"""Merging a batch of events into a history: every change of the batch, not the newest one only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata.functions import is_current
from chronostrata.operators.history import scd2_backfill
from chronostrata.operators.ordered import HOT_ROWS, in_order, with_next
from chronostrata.session import cut

SEEN = "seen"


@dataclass(frozen=True)
class Merged:
    """`current`: the last two versions of each key, to be merged with the next batch. `closed`: versions before
    them that were not closed until now. `late`: events not after the last one their key has seen."""

    current: DataFrame
    closed: DataFrame
    late: DataFrame


def seen_at(ts_col: str, tie: Sequence[str]) -> Column:
    """What orders the events of a key: their time and ties, the first of which is the time."""
    return F.struct(F.col(ts_col), *[F.col(c) for c in tie])


def scd2_merge(
    heads: DataFrame | None,
    events: DataFrame,
    key: str,
    attrs: Sequence[str],
    ts_col: str,
    tie: Sequence[str] = (),
    grain: str = "day",
    hot_rows: int | None = HOT_ROWS,
    write_once: bool = False,
) -> Merged:
    """Splice the version chain of `events` onto `heads`, the last two versions of each key.

    `heads` is the `current` of the merge before (None at first). The two versions stand as events of their
    start before the batch, and the chain of both is built as `scd2_backfill` builds it: states that repeat
    the open one open nothing, and a later event of the day (or moment) an open version began in
    replaces it. That is why the version before the open one stays: if the replaced one was all that
    ended it, it goes on. So events that come in order of `(ts_col, *tie)` per key give the history of
    `scd2_backfill` over all of them, however they are cut into batches.

    In order is told by `seen`, the last event of a key, not by the start of its open version: an event that
    only confirmed a state also fixes what came before it. `late` events are replays, or versions that belong
    inside the history; `streaming.merge` tells them apart and rebuilds the keys.

    With `write_once` the chain is written to the shared folder, so that who needs both `current` and `closed` builds it
    once. The batch is shuffled by key as the history windows need it, and `heads` with it. Closed versions are not read.
    """
    order = seen_at(ts_col, tie)
    # Ahead of the given ties: what is stored comes before what is new.
    ties = ["_new", *tie]
    log = events.select(*dict.fromkeys([key, *attrs, ts_col, *tie])).withColumn("_new", F.lit(1))
    late = events.where("false")
    rows, marks = log, log.select(key, order.alias(SEEN))
    if heads is not None:
        known = heads.where(is_current()).select(F.col(key).alias("_key"), F.col(SEEN).alias("_seen"))
        met = events.join(known, F.col(key) == F.col("_key"), "left").withColumn("_late", F.col("_seen").isNotNull() & (order <= F.col("_seen")))
        late = met.where("_late").select(*events.columns)
        fresh = met.where("NOT _late").select(*log.drop("_new").columns).withColumn("_new", F.lit(1))
        start = F.col("valid_from").cast(events.schema[ts_col].dataType)
        stored = heads.select(
            key, *attrs, start.alias(ts_col),
            *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in tie], F.lit(0).alias("_new"),
        )
        rows = stored.unionByName(fresh)
        marks = fresh.select(key, order.alias(SEEN)).unionByName(heads.where(is_current()).select(key, SEEN))
    chain = scd2_backfill(rows, key, attrs, ts_col, ties, grain, hot_rows=hot_rows)
    # One row per key: with the daily grain a key has few versions in a batch.
    ordered = in_order(chain, key, "valid_from", None if grain == "day" else hot_rows, counted=rows)
    told = with_next(ordered, {"_next_to": F.struct("valid_to")}).plain()
    if write_once:
        told = cut(told)
    # The second last is the one whose next version is open; the open one has no next.
    last_two = F.col("_next_to").isNull() | F.col("_next_to.valid_to").isNull()
    marks = marks.groupBy(key).agg(F.max(SEEN).alias(SEEN))
    current = told.where(last_two).drop("_next_to").join(marks, key)
    return Merged(current.select(*chain.columns, SEEN), told.where(~last_two).select(*chain.columns), late)
