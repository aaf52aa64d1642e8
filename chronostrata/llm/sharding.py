"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded number within their source and ranked; rank / rows of the source is the
fractional rank. Sorted by it, every stretch of the table has the sources in the proportions of the
whole, so cuts of that order give shards that match the mixture.

Equal texts stay in one shard (a null text counts as an empty one). The unit that is sorted and cut is
therefore the group of equal texts. It belongs to the source that most of its bytes come from, and stands
where one seeded draw for the whole group puts it, however many copies it has: at the fractional rank, by
bytes, among the shuffled groups of its source. Cuts are made where the shards' bytes come out equal.

Groups above 1/64 of a shard's share (at most 64 a shard, so their number is bounded) would make cuts
uneven: they are dealt first, largest first, each to the shard that has least of its source so far, and of
those to the emptiest. The cuts fill up the rest, and the other groups of such a source are spread so that each
shard gets what it still lacks of it. Shards differ by about 1/64 unless one group is larger than a
shard's share; then that group has its shard alone and the others are even.

Within a shard rows are in order of their own fractional rank in their source, so slots are mixed as well.

Defined results: null sources are a source of their own. Rows that are equal in id and text may
change slots among themselves. An empty table gives an empty result. Columns `size`, `text_crc32`,
`law`, `shard`, `slot` and `grown_shard` of the input are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata.llm.native import from_row, let, mixed_order, slice_bits, with_running
from chronostrata.session import cut

HEAVY_PARTS = 64
RANK_BITS = 40  # resolution of the fractional rank


def fractional_ranks(rows: DataFrame, part: str, order: str, ties: list[str], n_rows: int) -> DataFrame:
    """`_rank` in [0, 2^40): the fractional rank of each row in its part, as an integer."""
    ranked = with_running(rows.withColumn("_one", F.lit(1)), part, order, ties, {"_one": "_before"}, slice_bits(n_rows))
    of_part = rows.groupBy(part).agg(F.count("*").alias("_n"))
    fraction = (F.col("_before") + 0.5) / F.col("_n")
    return ranked.join(of_part, part).withColumn("_rank", F.floor(fraction * (1 << RANK_BITS)).cast("long")).drop(
        "_one", "_before", "_n"
    )


def _deal_heavy(heavy: list, loads: list[int], of_source: dict[str, list[int]]) -> dict[bytes, int]:
    """Largest first to the shard with least of the source, then to the emptiest; a shard that is over the others
    by more than the group's own bytes is passed over. `heavy` holds at most HEAVY_PARTS groups a shard."""
    placed = {}
    for row in sorted(heavy, key=lambda r: (-r["_bytes"], r["_key"])):
        own = of_source.setdefault(row["_part"], [0] * len(loads))
        least = min(loads)
        near = [i for i, load in enumerate(loads) if load <= least + row["_bytes"]]
        i = min(near, key=lambda i: (own[i], loads[i], i))
        placed[row["_key"]] = i
        loads[i] += row["_bytes"]
        own[i] += row["_bytes"]
    return placed


def _room(loads: list[int], light: int) -> list[int]:
    """Bytes each shard takes of the light groups, so that the fullest shards are as even as can be."""
    level, rest = 0, light
    for n, load in enumerate(ranked := sorted(loads), 1):
        level = (rest + sum(ranked[:n])) // n
        if n == len(ranked) or level <= ranked[n]:
            break
    return [max(0, level - load) for load in loads]


def _which(shard_of: dict[bytes, int], key: Column) -> Column:
    if not shard_of:
        return F.lit(None).cast("int")
    return F.create_map(*[x for k, s in shard_of.items() for x in (F.lit(k), F.lit(s))])[key]


def _spread(of_source: dict[str, list[int]], light: dict[str, int]) -> Column:
    """Where the fractional rank `_f` of a group stands among all, in [0, 1): itself, but for sources with heavy
    groups, whose rest goes to the shards by what each still lacks. One entry per source that has heavy groups."""
    entries = []
    for part, loads in of_source.items():
        room = _room(loads, light.get(part, 0))
        if sum(room):
            ends = [sum(room[: i + 1]) / sum(room) for i in range(len(room))]
            entries += [F.lit(part), F.array(*[F.lit(e) for e in ends])]
    if not entries:
        return F.col("_f")

    def stretched(ends: Column) -> Column:
        i = F.coalesce(F.array_position(F.transform(ends, lambda e: F.col("_f") < e), True), F.size(ends)).cast("int")
        low = F.when(i > 1, F.get(ends, i - 2)).otherwise(F.lit(0.0))
        width = F.get(ends, i - 1) - low
        inside = F.when(width > 0, (F.col("_f") - low) / width).otherwise(F.lit(0.5))
        return (i - 1 + inside) / F.size(ends)

    ends = F.create_map(*entries)[F.col("_part")]
    return F.when(ends.isNull(), F.col("_f")).otherwise(let(ends, stretched))


def _group_sources(ranked: DataFrame) -> DataFrame:
    """One row per group of equal texts: bytes of all rows, and the source that most of them come from."""
    per = ranked.groupBy("_key", "_part").agg(F.sum("size").alias("_of_part"))
    most = F.max_by("_part", F.struct("_of_part", "_part")).alias("_part")
    return per.groupBy("_key").agg(F.sum("_of_part").alias("_bytes"), most)


def interleaved_shards(
    docs: DataFrame,
    n_shards: int,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = "shards",
) -> DataFrame:
    """All rows without their text, with `size`, `text_crc32`, `law`, `shard`, `slot`, `grown_shard`."""
    added = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    rest = [c for c in docs.columns if c != text and c.lower() not in added]
    raw = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("_row"),
        F.col(doc_id).alias("_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.unhex(F.md5(raw)).alias("_key"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("z")).alias("_part"),
    )
    slim = cut(slim.withColumn("_u", mixed_order(seed, F.col("_id"), F.col("text_crc32"))))
    n_rows = slim.count()
    ranked = cut(fractional_ranks(slim, "_part", "_u", ["_id", "size"], n_rows))
    groups = cut(_group_sources(ranked).withColumn("_draw", mixed_order(seed, F.hex("_key"))))

    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    bound = max(1, total // (n_shards * HEAVY_PARTS))
    # No more than n_shards * HEAVY_PARTS groups can be larger than that share of all bytes.
    heavy = groups.where(F.col("_bytes") > bound).select("_key", "_part", "_bytes").collect()
    loads, of_source = [0] * n_shards, {}
    placed = _deal_heavy(heavy, loads, of_source)
    room = _room(loads, total - sum(r["_bytes"] for r in heavy))

    light = groups.where(F.col("_bytes") <= bound)
    parts = light.groupBy("_part").agg(F.sum("_bytes").alias("_n"))
    rest_of = {r["_part"]: r["_n"] for r in parts.where(F.col("_part").isin(list(of_source))).collect()} if of_source else {}
    run = with_running(light, "_part", "_draw", ["_key"], {"_bytes": "_before"}, slice_bits(n_rows))
    # Somewhere within its own bytes, by the draw: sources with few groups do not all stand in the middle.
    within = F.pmod(F.xxhash64("_draw", "_key"), F.lit(1 << 20)) / (1 << 20)
    run = run.join(parts, "_part").withColumn("_f", (F.col("_before") + within * F.col("_bytes")) / F.col("_n"))
    at = F.least(F.floor(_spread(of_source, rest_of) * (1 << RANK_BITS)), F.lit((1 << RANK_BITS) - 1)).cast("long")
    spread = cut(run.select("_key", "_bytes", at.alias("_at"), F.lit(0).alias("_all")))
    run = with_running(spread, "_all", "_at", ["_key"], {"_bytes": "_before"}, slice_bits(n_rows), RANK_BITS)
    middle = F.col("_before") * 2 + F.col("_bytes")
    ends = [2 * sum(room[: i + 1]) for i in range(n_shards)]
    open_shards = [i for i in range(n_shards) if room[i]] or [0]
    shard = F.lit(open_shards[-1])
    for i in reversed(open_shards[:-1]):
        shard = F.when(middle < ends[i], F.lit(i)).otherwise(shard)
    dealt = run.select("_key", shard.alias("shard"))
    if placed:
        big = groups.where(F.col("_bytes") > bound).select("_key", _which(placed, F.col("_key")).alias("shard"))
        dealt = dealt.union(big)
    # A key with very many rows is a skewed join key, which adaptive execution splits.
    sharded = ranked.join(dealt, "_key").withColumn("_one", F.lit(1))
    slotted = with_running(
        cut(sharded), "shard", "_rank", ["_u", "_id"], {"_one": "slot"}, slice_bits(n_rows // n_shards), RANK_BITS
    )
    return slotted.select(
        *from_row(rest),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_sources(sharded: DataFrame, source: str = "source") -> DataFrame:
    """Rows and bytes of each source in each shard, to check the mixture."""
    return sharded.groupBy("shard", source).agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))


def read_in_order(sharded: DataFrame) -> DataFrame:
    return sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")

