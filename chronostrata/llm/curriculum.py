"""Mixing sources to target weights along a curriculum.

A source's weight changes linearly over training time: w(t) = w * (1 + slope * (2t - 1)) for t in
[0, 1], so its mean is w. The share of the mix a source gets is the integral of its schedule. Its
cumulative demand up to t is target * ((1 - slope) * t + slope * t^2); the middle of each document,
counted in words within its source's shuffled order, is put through the inverse of that, and gives
the document a time. Sorting by time is the training order.

Targets: all sources together get `total` (by default as many words as there are). No source gets more
than `max_repeats` times its own words; what is over goes to the others by weight. A source is read
in rounds over the same shuffled order; a document is taken in a round if its middle lies before the
target, so a source's words differ from its target by half a document at most.

Defined results: a null text has no words and is never taken. Null sources are one source, last in
order. The order within a source depends on document ids and sizes only; rows equal in both
may change places, which changes nothing they return. An empty table gives an empty result. Input
columns keep their values; `size`, `source_size`, `target` and `positions` are replaced if present.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronostrata.llm.native import from_row, mixed_order, slice_bits, whole_row, with_running, word_count
from chronostrata.session import cut

MAX_REPEATS = 3
SLOPE = 0.5


def _part(source: Column) -> Column:
    """A key that is never null; the null source sorts last by code point."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("z"))


def targets(sizes: DataFrame, weights: tuple[int, ...], max_repeats: int, total: int | None) -> DataFrame:
    """Target words of each source, from one row per source: `_part`, `source_size`.

    With cap = max_repeats * size, target = min(cap, level * weight) for one level. Sources reach
    their cap in the order of cap / weight, so the level follows from running sums in that order.
    The windows see one row per source.
    """
    by_name, whole = Window.orderBy("_part"), Window.partitionBy()
    ranked = sizes.withColumn("_no", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_no") % len(weights)).cast("int") + 1)
    ranked = ranked.withColumns({"_w": weight.cast("long"), "_cap": F.col("source_size") * max_repeats})
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "_part")
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    goal = F.sum("source_size").over(whole) if total is None else F.lit(total)
    told = ranked.withColumns(
        {
            "_goal": F.least(goal, F.sum("_cap").over(whole)),
            "_full": F.coalesce(F.sum("_cap").over(upto), F.lit(0)),
            "_open": F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(upto), F.lit(0)),
        }
    )
    level = (F.col("_goal") - F.col("_full")) / F.col("_open")
    told = told.withColumn("_level", F.when(level * F.col("_w") <= F.col("_cap"), level))
    # The first source that stays under its cap fixes the level for all from there on.
    ratio = (F.col("_cap") / F.col("_w")).alias("ratio")
    first = F.min(F.when(F.col("_level").isNotNull(), F.struct(ratio, "_part", "_level"))).over(whole)
    target = F.coalesce(
        F.least(F.col("_cap").cast("double"), first["_level"] * F.col("_w")), F.col("_cap").cast("double")
    )
    slope = F.when(F.col("_no") % 2 == 0, F.lit(SLOPE)).otherwise(F.lit(-SLOPE))
    return told.select("_part", "source_size", target.alias("target"), slope.alias("_slope"))


def _time(words: Column, target: Column, slope: Column) -> Column:
    """Inverse of the cumulative demand: the time at which `words` of a source have been used."""
    share = F.least(words / target, F.lit(1.0))
    return (F.sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope)


def curriculum(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_repeats: int = MAX_REPEATS,
    total: int | None = None,
    seed: str = "mix",
) -> DataFrame:
    """Every row with `size`, `source_size`, `target` and `positions`: the times at which the row is
    used, none for a row that is left out. `weights` go round over the sources by name."""
    added = ["size", "source_size", "target", "positions"]
    rest = [c for c in docs.columns if c != text and c.lower() not in added]
    slim = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("_row"),
        F.col(doc_id).alias("_id"),
        word_count(F.col(text)).alias("size"),
        _part(F.col(source)).alias("_part"),
    ).withColumn("_u", mixed_order(seed, F.col("_id"), F.col("size")))
    return _placed(cut(slim), "_id", weights, max_repeats, total).select(*from_row(rest), *added)


def _placed(slim: DataFrame, doc_id: str, weights: tuple[int, ...], max_repeats: int, total: int | None) -> DataFrame:
    sizes = slim.groupBy("_part").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    plan = cut(targets(sizes.drop("_n"), weights, max_repeats, total))
    running = with_running(slim, "_part", "_u", [doc_id, "size"], {"size": "_before"}, slice_bits(slim.count()))
    # No broadcast hint: Spark broadcasts the sources where their number is small.
    out = running.join(plan, "_part")
    start = F.transform(
        F.sequence(F.lit(0), F.lit(max_repeats - 1)), lambda k: k * F.col("source_size") + F.col("_before")
    )
    used = F.filter(start, lambda s: (F.col("size") > 0) & (2 * s + F.col("size") < 2 * F.col("target")))
    times = F.transform(used, lambda s: _time(s + F.col("size") / 2, F.col("target"), F.col("_slope")))
    return out.withColumn("positions", times)


def training_order(placed: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per use of a document, range-sorted by its time (`position`)."""
    used = placed.select("*", F.explode("positions").alias("position"))
    return used.orderBy("position", F.col(doc_id))


def mixed_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options
) -> DataFrame:
    """The documents in training order, with the input's columns: each as often as the mix uses it.

    Places are worked out without the texts; texts are shuffled once to meet their places and once to be
    sorted. Rows of equal id and text are one document whose uses add up."""
    keyed = docs.select(
        whole_row(docs),
        F.col(doc_id).alias("_id"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_key"),
        F.col(text).alias("_text"),
        F.col(source).alias("_source"),
    )
    placed = curriculum(keyed.drop("_row"), "_id", "_text", "_source", **options)
    uses = cut(placed.groupBy("_id", "_key").agg(F.flatten(F.collect_list("positions")).alias("positions")))
    uses = uses.where(F.size("positions") > 0).select(F.col("_id").alias("_use_id"), F.col("_key").alias("_use"), "positions")
    once = keyed.select("_row", "_id", "_key").dropDuplicates(["_id", "_key"])
    found = once.join(uses, once["_id"].eqNullSafe(uses["_use_id"]) & (once["_key"] == uses["_use"]))
    return training_order(found, "_id").select(*from_row(docs.columns))
