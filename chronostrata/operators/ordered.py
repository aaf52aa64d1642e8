"""Looking at neighbouring rows of one key, also when that key holds a third of all rows.

A window partitioned by key puts all rows of a key in one task. Keys above `hot_rows` are
therefore cut into chunks along the order columns: the window runs per (key, chunk), and the
value that crosses a chunk border comes from a table with one row per (hot key, chunk). The
result is the same as with one window over the whole key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronostrata.session import cut, sound_unions

HOT_ROWS = 2_000_000
MAX_HOT_KEYS = 10_000
MAX_CHUNKS = 10_000

_CHUNK = "_chunk"
_PREV = "_prev"
_NEXT = "_next"
_EDGE = "_edge"


@dataclass(frozen=True)
class OrderedRows:
    """Rows with the key and total order their neighbours are defined by.

    `order` names ascending columns that together identify a row within its key.
    `hot` tells whether some keys were cut into chunks (column `_chunk`).
    """

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot: bool

    def where(self, condition: Column) -> OrderedRows:
        return replace(self, df=self.df.where(condition))

    def plain(self) -> DataFrame:
        return self.df.drop(_CHUNK)


def in_order(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    hot_rows: int | None = HOT_ROWS,
    counted: DataFrame | None = None,
    cut_by: int | None = None,
) -> OrderedRows:
    """Prepare `df` for `with_prev`, `with_next`, `carry_last`, `last_of_moment` and `change_points`.

    Runs one count per key over the key columns alone. `hot_rows=None` skips it: right
    where a key has few rows by construction, such as one per day. Where `df` is costly to
    compute, `counted` may be the table it comes from: any rows with these keys, at least as
    many per key. `cut_by` names how many of the order columns place the cuts (all of them by default): with
    one, rows of one moment stay in one chunk.
    """
    sound_unions(df.sparkSession)
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    order = (order,) if isinstance(order, str) else tuple(order)
    if hot_rows is None:
        return OrderedRows(df, keys, order, False)
    # At most MAX_HOT_KEYS rows reach the driver. A key left out of the list holds at most
    # 1/MAX_HOT_KEYS of all rows, which one task can take.
    source = df if counted is None else counted
    per_key = source.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > hot_rows)
    heaviest = per_key.orderBy(F.desc("_rows")).limit(MAX_HOT_KEYS).collect()
    if not heaviest:
        return OrderedRows(df, keys, order, False)

    # The list is rebuilt from values, so it is the same in both joins below.
    listed = df.sparkSession.createDataFrame(heaviest, per_key.schema).drop("_rows")
    marks = F.broadcast(listed.select(*[F.col(k).alias(f"_hot_{k}") for k in keys]))
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    cold = df.join(marks, same, "left_anti").withColumn(_CHUNK, F.lit(0))
    chunks = min(MAX_CHUNKS, ceil(sum(r["_rows"] for r in heaviest) / hot_rows) + 1)
    # Range partitions follow (key, order), however uneven the rows lie in time. The cut keeps
    # the chunk numbers fixed, which sampling again after a lost executor would not.
    chunked = cut(
        df.join(marks, same, "left_semi")
        .repartitionByRange(chunks, *keys, *order[:cut_by])
        .withColumn(_CHUNK, F.spark_partition_id() + 1)
    )
    return OrderedRows(cold.unionByName(chunked), keys, order, True)


def _within(rows: OrderedRows):
    by = [*rows.keys, _CHUNK] if rows.hot else list(rows.keys)
    return Window.partitionBy(*by).orderBy(*rows.order)


def _chunk_ends(rows: OrderedRows, value: Column, last: bool) -> DataFrame:
    """One row per (hot key, chunk): `value` of its last or first row. Never more rows than
    chunks plus hot keys, both bounded above."""
    pick = F.max_by if last else F.min_by
    return rows.df.where(F.col(_CHUNK) > 0).groupBy(*rows.keys, _CHUNK).agg(pick(value, F.struct(*rows.order)).alias(_EDGE))


def _over_edges(rows: OrderedRows):
    return Window.partitionBy(*rows.keys).orderBy(_CHUNK)


def _join_edges(rows: OrderedRows, df: DataFrame, edges: DataFrame) -> DataFrame:
    names = {k: f"_edge_{k}" for k in (*rows.keys, _CHUNK)}
    edges = F.broadcast(edges.withColumnsRenamed(names))
    match = [F.col(k).eqNullSafe(F.col(e)) for k, e in names.items()]
    return df.join(edges, match, "left").drop(*names.values())


def _neighbour(rows: OrderedRows, columns: Mapping[str, Column | str], forward: bool) -> OrderedRows:
    value = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])
    held = _NEXT if forward else _PREV
    step = F.lead if forward else F.lag
    df = rows.df.withColumn(held, step(value).over(_within(rows)))
    if rows.hot:
        ends = _chunk_ends(rows, value, last=not forward)
        ends = ends.withColumn(_EDGE, step(_EDGE).over(_over_edges(rows)))
        df = _join_edges(rows, df, ends)
        # A neighbour inside the chunk is a struct, never NULL, so NULL means "at the border".
        df = df.withColumn(held, F.coalesce(held, _EDGE)).drop(_EDGE)
    return replace(rows, df=df.withColumns({n: F.col(held)[n] for n in columns}).drop(held))


def with_prev(rows: OrderedRows, columns: Mapping[str, Column | str]) -> OrderedRows:
    """Add `{new column: expression of the previous row of the key}`."""
    return _neighbour(rows, columns, forward=False)


def with_next(rows: OrderedRows, columns: Mapping[str, Column | str]) -> OrderedRows:
    """Add `{new column: expression of the next row of the key}`."""
    return _neighbour(rows, columns, forward=True)


def carry_last(rows: OrderedRows, value: str, name: str) -> OrderedRows:
    """Add the last non-NULL `value` at or before each row of the key."""
    return carry_all(rows, {name: value})


def carry_all(rows: OrderedRows, columns: Mapping[str, str]) -> OrderedRows:
    """Add, for each `{new column: column}`, the last non-NULL value at or before each row of the key: one
    window and one table of chunk borders for all of them."""
    so_far = _within(rows).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = rows.df.withColumns({n: F.last(c, ignorenulls=True).over(so_far) for n, c in columns.items()})
    if rows.hot:
        order = F.struct(*rows.order)
        ends = rows.df.where(F.col(_CHUNK) > 0).groupBy(*rows.keys, _CHUNK).agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(f"{_EDGE}{i}") for i, c in enumerate(columns.values())]
        )
        before = _over_edges(rows).rowsBetween(Window.unboundedPreceding, -1)
        earlier = {f"{_EDGE}{i}": F.last(f"{_EDGE}{i}", ignorenulls=True).over(before) for i in range(len(columns))}
        df = _join_edges(rows, df, ends.withColumns(earlier))
        df = df.withColumns({n: F.coalesce(n, f"{_EDGE}{i}") for i, n in enumerate(columns)}).drop(*earlier)
    return replace(rows, df=df)


def last_of_moment(rows: OrderedRows) -> OrderedRows:
    """Of the rows of a key that are equal in the first order column, the last one. `rows` must have been
    prepared with `cut_by=1`. One more value in the window over the key, no shuffle of its own."""
    after = F.lead(F.struct(rows.order[0])).over(_within(rows))
    moved_on = F.col("_after").isNull() | ~F.col("_after")[rows.order[0]].eqNullSafe(F.col(rows.order[0]))
    return replace(rows, df=rows.df.withColumn("_after", after).where(moved_on).drop("_after"))


def change_points(rows: OrderedRows, state: str, at: str, previous: Mapping[str, str] | None = None) -> DataFrame:
    """Rows whose `state` differs from the row before them in their key, with `_to`, the `at` of the next such
    row, and, for each `{new column: column}` of `previous`, its value in the such row before.

    With hot keys, one table of chunk borders answers all of it: per chunk its first and last state, where it
    changes first inside, and the values of its last change. What that means across chunks follows from
    the borders alone, so the rows are read twice (borders, result), not once more for every value.
    """
    previous = dict(previous or {})
    names = list(previous.values())
    held = F.struct(F.lit(True).alias("_some"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(names)])
    before = F.lag(F.struct(F.col(state).alias("s"))).over(_within(rows))
    df = rows.df.withColumn("_before", before)
    inside = F.col("_before").isNotNull() & ~F.col("_before.s").eqNullSafe(F.col(state))
    changed = F.col("_before").isNull() | inside
    if rows.hot:
        edges = _change_edges(rows, df, state, at, held, inside)
        df = _join_edges(rows, df, edges)
        open_start = F.col("_before").isNull() & (F.col("_last").isNull() | ~F.col("_last.s").eqNullSafe(F.col(state)))
        changed = open_start | inside
    points = replace(rows, df=df.where(changed).withColumn("_held", held))
    step = _within(points)
    df = points.df.withColumns({"_next": F.lead(F.struct(F.col(at).alias("at"))).over(step), "_prev": F.lag("_held").over(step)})
    to, prior = F.col("_next.at"), F.col("_prev")
    if rows.hot:
        to = F.when(F.col("_next").isNotNull(), to).otherwise(F.col("_following.at"))
        prior = F.coalesce(prior, F.col("_earlier"))
    values = {n: prior[f"v{i}"] for i, n in enumerate(previous)}
    return df.select(*rows.df.drop(_CHUNK).columns, to.alias("_to"), *[v.alias(n) for n, v in values.items()])


def _change_edges(rows: OrderedRows, df: DataFrame, state: str, at: str, held: Column, inside: Column) -> DataFrame:
    """One row per (hot key, chunk): `_last`, the state before the chunk; `_following`, where the next change
    after it is; `_earlier`, the values of the last change before it."""
    order = F.struct(*rows.order)
    now, here = F.struct(F.col(state).alias("s")), F.struct(F.col(at).alias("at"))
    borders = df.where(F.col(_CHUNK) > 0).groupBy(*rows.keys, _CHUNK).agg(
        F.min_by(now, order).alias("first"), F.max_by(now, order).alias("last"),
        F.min_by(here, order).alias("first_at"), F.min_by(held, order).alias("first_held"),
        F.min_by(here, F.when(inside, order)).alias("inner_at"), F.max_by(held, F.when(inside, order)).alias("inner_held"),
    )
    over = _over_edges(rows)
    told = borders.withColumn("_last", F.lag("last").over(over))
    opens = F.col("_last").isNull() | ~F.col("_last.s").eqNullSafe(F.col("first.s"))
    told = told.withColumns(
        {
            "_change": F.when(opens, F.col("first_at")).otherwise(F.col("inner_at")),
            "_kept": F.coalesce("inner_held", F.when(opens, F.col("first_held"))),
        }
    )
    ahead, behind = over.rowsBetween(1, Window.unboundedFollowing), over.rowsBetween(Window.unboundedPreceding, -1)
    return told.select(
        *rows.keys, _CHUNK, "_last", F.first("_change", ignorenulls=True).over(ahead).alias("_following"),
        F.last("_kept", ignorenulls=True).over(behind).alias("_earlier"),
    )
