"""Keyed merges, written as one window over the union of both sides: a heavy key arrives as
one row per map task, and no side is joined in full."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata.operators.joins import anti
from chronostrata.operators.latest import latest_by_key


def snapshot_latest(
    staged: DataFrame, keys: str | Sequence[str], effective: Column, tie: Sequence[str] = ("_load_ts", "_load_id")
) -> DataFrame:
    """Newest state per key: by effective time, then load time, then load id."""
    return latest_by_key(staged, keys, [effective.desc_nulls_first(), *[F.col(t).desc_nulls_first() for t in tie]])


def upsert_newer(
    target: DataFrame,
    src: DataFrame,
    keys: str | Sequence[str],
    effective: Column,
    tie: Sequence[str] = ("_load_ts", "_load_id"),
) -> DataFrame:
    """Target with source rows added or put in place of older ones; on equal effective time the
    stored row stays."""
    both = target.withColumn("_stored", F.lit(1)).unionByName(
        src.select(*target.columns).withColumn("_stored", F.lit(0))
    )
    order = [effective.desc_nulls_first(), F.desc("_stored"), *[F.col(t).desc_nulls_first() for t in tie]]
    return latest_by_key(both, keys, order).drop("_stored")


def insert_if_absent(
    target: DataFrame, src: DataFrame, keys: Sequence[str], order: Sequence[str] = ("_load_ts", "_load_id")
) -> DataFrame:
    """Target plus source rows with a new key; of source rows with the same key the earliest
    loaded counts. Replaying a batch adds nothing."""
    first = latest_by_key(src.select(*target.columns), keys, [F.asc(c) for c in order])
    return target.unionByName(anti(first, target, list(keys)))
