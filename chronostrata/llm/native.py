"""Expressions on texts and distributed ranks, all of them Spark's own functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Word separators of all contracts: blank, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole_row(docs: DataFrame) -> Column:
    """All columns in one struct, `_row`, so that added columns cannot clash with the input's."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def from_row(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"_row.`{c}`") for c in columns]


def words(text: Column) -> Column:
    """Words of a text in order; no words for a null, empty or blank text."""
    trimmed = F.trim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(
        F.array().cast("array<string>")
    )


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def mixed_order(seed: str, *cols: Column) -> Column:
    """A number in [0, 2^60) that looks random but depends on the values alone."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("-")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


ORDER_BITS = 60


def slice_bits(rows: int, rows_per_slice: int = 1000, most_bits: int = 17) -> int:
    """Bits of the order number that name a slice, so that a slice has about `rows_per_slice`
    rows; at most 2^17 slices, after which the slices grow (by then one has 100,000 rows and
    more only above 10^10 rows)."""
    return max(0, min(most_bits, (max(rows, 1) // rows_per_slice).bit_length()))


def with_running(
    df: DataFrame,
    part: str,
    order: str,
    ties: Sequence[str],
    sums: dict[str, str],
    bits: int,
    order_bits: int = ORDER_BITS,
) -> DataFrame:
    """Running sums before each row within `part`, in the order (`order`, `ties`).

    `sums` maps an integer column to the name of its running sum (the row itself left out);
    `part` must not be null. The range of `order` is cut into 2^`bits` slices. A slice is one
    window, and what lies before it comes from one row per (part, slice): no task holds a whole
    part, and rows that are equal in all order columns may change places among themselves only.
    """
    sliced = df.withColumn("_slice", F.shiftright(F.col(order), order_bits - bits))
    totals = sliced.groupBy(part, "_slice").agg(*[F.sum(c).alias(f"_t{i}") for i, c in enumerate(sums)])
    before = Window.partitionBy(part).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        part,
        "_slice",
        *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_b{i}") for i in range(len(sums))],
    )
    inside = Window.partitionBy(part, "_slice").orderBy(order, *ties).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    out = sliced.join(offsets, [part, "_slice"])
    return out.select(
        *df.columns,
        *[
            (F.col(f"_b{i}") + F.sum(c).over(inside) - F.col(c)).cast("long").alias(name)
            for i, (c, name) in enumerate(sums.items())
        ],
    )
