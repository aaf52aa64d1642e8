"""One history out of the periods of several sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata.functions import hashdiff
from chronostrata.operators.ordered import HOT_ROWS, carry_all, change_points, in_order

SOURCES = "sources"


def overlay(
    sources: Mapping[str, DataFrame],
    key: str,
    attrs: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Periods in which, attribute by attribute, the first source (in the order given) that has a value counts.

    `sources` maps a name to periods `[valid_from, valid_to)` of the key that do not overlap within the source. They are
    cut at each other's borders; neighbouring pieces with equal values are one period again, and where no source has a
    period there is none. `sources` of the result names the source of each attribute, in the order of `attrs`
    ('' where none has a value); a change of source alone begins a new period.

    Borders of all sources are swept together: a period is two points, its start with the values and its end
    without, points of one key and moment are one row, and the state of every source is carried on to the
    points after it. So no period is compared with another, the shuffle moves two rows per period, and a hot key is cut
    like any other (`operators.ordered`).
    """
    names = list(sources)
    order = [f"_s{i}" for i in range(len(names))]
    state_type = _state_type(next(iter(sources.values())), attrs)

    def points(df: DataFrame, mine: str) -> DataFrame:
        values = F.struct(*[F.col(a) for a in attrs])
        start = F.struct(F.lit(True).alias("open"), values.alias("v")).cast(state_type)
        end = F.struct(F.lit(False).alias("open"), F.lit(None).cast(values_type).alias("v")).cast(state_type)
        df = df.where(F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from)))
        opened = df.select(key, F.col(valid_from).alias("_at"), start.alias(mine))
        closed = df.where(F.col(valid_to).isNotNull()).select(key, F.col(valid_to).alias("_at"), end.alias(mine))
        both = opened.unionByName(closed)
        return both.select(key, "_at", *[(F.col(o) if o == mine else F.lit(None).cast(state_type)).alias(o) for o in order])

    values_type = state_type[len("struct<open:boolean,v:") : -1]
    everything = None
    for name, mine in zip(names, order, strict=True):
        part = points(sources[name], mine)
        everything = part if everything is None else everything.unionByName(part)
    # Where one period ends and the next of the same source begins, the start counts.
    met = everything.groupBy(key, "_at").agg(*[F.max_by(o, F.col(f"{o}.open")).alias(o) for o in order])
    carried = carry_all(in_order(met, key, "_at", hot_rows), {f"_in{o}": o for o in order})

    def first(a: str) -> Column:
        return F.coalesce(*[F.col(f"_in{o}.v.{a}") for o in order])

    def source(a: str) -> Column:
        said = [F.when(F.col(f"_in{o}.v.{a}").isNotNull(), F.lit(n)) for n, o in zip(names, order, strict=True)]
        return F.coalesce(*said, F.lit(""))

    some = F.coalesce(*[F.when(F.col(f"_in{o}.open"), F.lit(True)) for o in order], F.lit(False))
    told = carried.df.select(
        *[c for c in carried.df.columns if not c.startswith("_in") and c not in order],
        *[first(a).alias(a) for a in attrs], F.array(*[source(a) for a in attrs]).alias(SOURCES), some.alias("_some"),
    )
    # Values are compared as they are, NULL included.
    told = told.withColumn("_state", F.struct("_some", SOURCES, *[F.col(a) for a in attrs]))
    pieces = change_points(type(carried)(told, carried.keys, carried.order, carried.hot), "_state", "_at")
    return pieces.where("_some").select(
        key, *attrs, SOURCES, hashdiff(*attrs).alias("hashdiff"), F.col("_at").alias(valid_from), F.col("_to").alias(valid_to)
    )


def _state_type(df: DataFrame, attrs: Sequence[str]) -> str:
    values = ",".join(f"`{a}`:{df.schema[a].dataType.simpleString()}" for a in attrs)
    return f"struct<open:boolean,v:struct<{values}>>"
