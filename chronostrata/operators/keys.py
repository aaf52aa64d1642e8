"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronostrata.session import cut

# monotonically_increasing_id holds the partition above bit 33 and the row number below.
_ROW_BITS = 33
ROWS_PER_PARTITION = 1_000_000
MAX_PARTITIONS = 100_000


def assign_keys(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    start: int = 1,
    partitions: int | None = None,
    rows_per_partition: int = ROWS_PER_PARTITION,
) -> DataFrame:
    """Consecutive numbers from `start` in the order of `order`, which must be total.

    Rows are range-partitioned and numbered inside their partition; each partition then adds
    the rows before it. Ranges are cut at quantiles of the order columns, which Spark samples, and
    there are as many as the rows need, counted first, so a task's share does not grow with the table. Counting,
    sampling and sorting read the rows from a cut, so that they are computed once. An
    increment goes on at the greatest key plus one. Where the order does not matter, `hash_keys` needs neither
    a sort nor a cut.
    """
    rows = df if partitions else cut(df)
    n = partitions or max(1, min(MAX_PARTITIONS, ceil(rows.count() / rows_per_partition)))
    placed = cut(
        rows.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", _ROW_BITS)
    # One row per partition, at most MAX_PARTITIONS of them.
    sizes = placed.groupBy(part.alias("_cut")).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_cut", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.withColumn("_cut", part).join(F.broadcast(offsets), "_cut")
    within = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return numbered.select((F.lit(start).cast("long") + F.col("_offset") + within).alias(name), *df.columns)


def hash_keys(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """A number for each row that follows from `columns` alone (64 bits, never negative): the same on every run, with no
    shuffle, sort or cut. Dense it is not, and two rows share one with a chance of about n^2 / 2^64; the table's
    own key constraint tells."""
    key = F.shiftrightunsigned(F.xxhash64(*columns), 1)
    return df.select(key.alias(name), *df.columns)


def next_key(dim: DataFrame, name: str) -> int:
    """The number an increment starts at (one aggregate over the key column)."""
    top = dim.agg(F.max(name)).first()[0]
    return 1 if top is None else int(top) + 1
