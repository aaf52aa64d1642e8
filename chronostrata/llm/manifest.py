"""A dataset manifest as a content-addressed Merkle DAG, and proofs by descent from its root.

Leaves are digests of whole rows. Per part (language) they stand in the order of the id and are joined two by
two until one digest, the subroot, is left; a last run of one is hashed by itself. Subroots, ordered by part, are
joined in the same way to the root.

The store maps digests to children. A record packs the node it is named by and its descendants of up to
`DIGITS` levels: `children[k]` are the nodes k levels above the record's floor. Records are built by one
shuffle per `DIGITS` levels, in groups of at most 2^DIGITS nodes, so neither a large part nor a large table makes a
large task, and all levels together move little more rows than there are leaves.

A proof is found by descent. A request names a part and a rank; the digits of the rank choose the child at
every level from the root on, the unselected children are collected, and the segments so gathered are put
in reverse, from leaf to root. Requests that share their way so far travel as one (the distinct leading
digits), so no record is asked for by more than 2^DIGITS of them, the root's included.

Ranks come from range partitions over (part, id, digest) with a row number each; a part's first number is met by
part and block of numbers, so a part with a third of all rows is spread like any other. Nothing is sent to the driver but the
greatest number of leaves of a part and the number of parts.

Defined results: a null value is hashed as `-`; null parts are a part of their own, before all others; null
ids come first in their part; rows equal in part and id stand in the order of their digests, and repeated
rows are leaves of their own; a part of one leaf has that leaf as its subroot. A text of any length is hashed whole, in
its row. An empty table has no root and gives no proofs. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata.llm.native import let
from chronostrata.operators.keys import assign_keys
from chronostrata.session import cut

DIGITS = 8
BLOCK_BITS = 16
ROWS_PER_PARTITION = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

Path = "array<struct<sibling:string,right:boolean>>"


@dataclass(frozen=True)
class Manifest:
    """`leaves` (_group, _rank and the columns carried), `stages` of records (digest, height, children) from
    the leaves upwards, `tops` (_group, digest, _n), the same for the parts, and the root digest."""

    leaves: DataFrame
    stages: list[DataFrame]
    parts: DataFrame
    part_stages: list[DataFrame]
    root: DataFrame


def digest(*texts: Column) -> Column:
    """Lowercase hex sha256 of the texts put together."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def field(value: Column) -> Column:
    """`-` for null, else bytes, colon and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def _height(n: Column) -> Column:
    """Levels above `n` nodes: ceil(log2 n), exactly."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1))).cast("int")


def _height_at(n: Column, stage: int) -> Column:
    """Levels that a part of `n` leaves has in a stage of `DIGITS` levels."""
    return F.greatest(F.lit(0), F.least(F.lit(DIGITS), _height(n) - stage * DIGITS))


def _pairs(nodes: Column) -> Column:
    firsts = F.sequence(F.lit(0), F.size(nodes) - 1, F.lit(2))
    return F.transform(firsts, lambda i: digest(F.get(nodes, i), F.coalesce(F.get(nodes, i + 1), F.lit(""))))


def _levels(nodes: Column, height: Column) -> Column:
    """`nodes` and the levels above them, `height` of them."""
    steps = F.array_repeat(F.lit(0), height)
    return F.aggregate(steps, F.array(nodes), lambda built, _: F.concat(built, F.array(_pairs(F.element_at(built, -1)))))


def _stage_count(most: int) -> int:
    return max(0, -(-(max(most, 1) - 1).bit_length() // DIGITS))


def _build(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """`nodes` (_group, _rank, digest, _n) joined up to one node per part: the records of each stage, and
    (_group, digest, _n). `most` is the greatest number of nodes in a part."""
    stages = []
    for stage in range(_stage_count(most)):
        grouped = nodes.groupBy("_group", F.shiftright("_rank", DIGITS).alias("_rank")).agg(
            F.sort_array(F.collect_list(F.struct("_rank", "digest"))).alias("_nodes"), F.first("_n").alias("_n")
        )
        height = _height_at(F.col("_n"), stage)
        levels = grouped.select(
            "_group", "_rank", "_n", height.alias("height"), _levels(F.col("_nodes.digest"), height).alias("_levels")
        )
        packed = cut(
            levels.select(
                "_group", "_rank", "_n", "height", F.element_at(F.element_at("_levels", -1), 1).alias("digest"),
                F.slice("_levels", 1, F.col("height")).alias("children"),
            )
        )
        stages.append(packed.where("height > 0").select("digest", "height", "children"))
        nodes = packed.select("_group", "_rank", "digest", "_n")
    return stages, nodes.select("_group", "digest", "_n")


def _ranked(leaves: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """`leaves` (_group, ...) with `_rank` in their part and its size `_n`; and the sizes per part."""
    rows = leaves.count()
    partitions = max(1, min(100_000, -(-rows // ROWS_PER_PARTITION)))
    numbered = assign_keys(leaves, ["_group", *order], "_number", 0, partitions)
    of_part = numbered.groupBy("_group").agg(F.min("_number").alias("_first"), F.max("_number").alias("_last"))
    of_part = cut(of_part.withColumn("_n", F.col("_last") - F.col("_first") + 1))
    blocks = F.sequence(F.shiftright("_first", BLOCK_BITS), F.shiftright("_last", BLOCK_BITS))
    spread = of_part.select("_group", "_first", "_n", F.explode(blocks).alias("_block"))
    ranked = numbered.withColumn("_block", F.shiftright("_number", BLOCK_BITS)).join(spread, ["_group", "_block"])
    return ranked.withColumn("_rank", F.col("_number") - F.col("_first")).drop("_number", "_first", "_block"), of_part


def build(
    docs: DataFrame, fields: Sequence[str] = FIELDS, part: str = "lang", doc_id: str = "doc_id", **extra: Column
) -> Manifest:
    """The manifest of `docs`. `extra` names expressions over `docs` to carry along with the leaves."""
    key = F.coalesce(F.concat(F.lit("1"), F.col(part).cast("string")), F.lit("0"))
    rows = cut(
        docs.select(
            key.alias("_group"), F.col(doc_id), leaf(*[F.col(c) for c in fields]).alias("digest"),
            *[c.alias(n) for n, c in extra.items()],
        )
    )
    leaves, of_part = _ranked(rows, [doc_id, "digest"])
    most = of_part.agg(F.max("_n")).first()[0] or 0
    stages, tops = _build(leaves.select("_group", "_rank", "digest", "_n"), most)
    ordered, of_all = _ranked(tops.withColumnsRenamed({"_group": "_name", "_n": "_leaves"}).withColumn("_group", F.lit("")), ["_name"])
    # Few rows: one per part.
    parts = cut(ordered)
    count = of_all.agg(F.max("_n")).first()[0] or 0
    part_stages, root = _build(parts.select("_group", "_rank", "digest", "_n"), count)
    return Manifest(leaves, stages, parts, part_stages, root)


def _descend(
    stages: list[DataFrame], tops: DataFrame, requests: DataFrame, carried: Sequence[str]
) -> DataFrame:
    """`requests` (_group, _rank, carried...) with `digest`, the node found, and `_path`, the unselected
    children on the way from the top of their part, first the topmost. `tops` has (_group, digest, _n, _path)
    and what else each part's requests are to get."""
    asked = F.collect_list(F.struct("_rank", *carried)).alias("_asked")
    prefix = F.shiftright("_rank", DIGITS).alias("_prefix")
    groups = []
    at = requests.select("_group", "_rank", *carried)
    for stage in range(len(stages)):
        mine = asked if stage == 0 else F.collect_list(F.struct("_rank")).alias("_asked")
        groups.append(at.groupBy("_group", prefix).agg(mine))
        at = groups[-1].select("_group", F.col("_prefix").alias("_rank"))
    if not stages:
        return at.join(tops, "_group").drop("_group")
    told = [c for c in tops.columns if c not in ("_group", "digest", "_path")]
    state = tops.withColumn("_prefix", F.lit(0).cast("long"))
    for stage in reversed(range(len(stages))):
        height = _height_at(F.col("_n"), stage)
        met = groups[stage].join(state, ["_group", "_prefix"]).withColumn("height", height)
        met = met.join(_once(stages[stage]), ["digest", "height"], "left")

        def way(request: Column) -> Column:
            place = request["_rank"].bitwiseAND(F.lit((1 << DIGITS) - 1)).cast("int")
            segment = F.transform(
                F.filter(F.sequence(F.lit(DIGITS - 1), F.lit(0), F.lit(-1)), lambda k: k < F.col("height")),
                lambda k: let(
                    F.call_function("shiftright", place, k),
                    lambda i: F.struct(
                        F.coalesce(F.get(F.get("children", k), i.bitwiseXOR(F.lit(1))), F.lit("")).alias("sibling"),
                        (i % 2 == 1).alias("right"),
                    ),
                ),
            )
            found = F.when(F.col("height") > 0, F.get(F.get("children", F.lit(0)), place)).otherwise(F.col("digest"))
            return F.struct(request.alias("asked"), found.alias("digest"), F.concat("_path", segment).cast(Path).alias("_path"))

        rows = met.select("_group", *told, F.explode(F.transform("_asked", way)).alias("_w"))
        state = rows.select("_group", *told, "_w.digest", "_w._path", "_w.asked.*").withColumnRenamed("_rank", "_prefix")
    return state.drop("_group").withColumnRenamed("_prefix", "_rank")


def _once(records: DataFrame) -> DataFrame:
    """Equal subtrees (of repeated rows) are one record."""
    return records.groupBy("digest", "height").agg(F.first("children").alias("children"))


def proofs(manifest: Manifest, requests: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Per request (_group, _rank, carried...): the `root`, its part's `subroot`, the `digest` found at its rank and
    `path`, from leaf to root, of (sibling, right): `sibling` is empty where a run has one node only, `right` says that
    the way comes from the right."""
    top = manifest.root.select("_group", "digest", "_n", F.array().cast(Path).alias("_path"), F.col("digest").alias("root"))
    parts = manifest.parts.select("_group", "_rank", "_name", "_leaves")
    subroots = _descend(manifest.part_stages, top, parts, ["_name", "_leaves"])
    tops = subroots.select(
        F.col("_name").alias("_group"), "digest", F.col("_leaves").alias("_n"), "_path", "root", F.col("digest").alias("subroot")
    )
    found = _descend(manifest.stages, tops, requests, carried)
    return found.select(*carried, "digest", "subroot", "root", F.reverse("_path").alias("path"))


def fold(start: Column, path: Column) -> Column:
    """The root that `path` leads to from a leaf."""

    def up(at: Column, step: Column) -> Column:
        left = F.when(step["right"], step["sibling"]).otherwise("")
        right = F.when(step["right"], F.lit("")).otherwise(step["sibling"])
        return digest(left, at, right)

    return F.aggregate(path, start, up)


def audit(docs: DataFrame, held: dict[str, Column], **names: str) -> DataFrame:
    """Every row of `docs` proven against the manifest of `docs`: doc_id, leaf, subroot, root, proof_sha256,
    folded_root and verified. `held` names the field values to fold from (a replica's, say) where
    they differ from the row's own."""
    fields, doc_id = names.get("fields", FIELDS), names.get("doc_id", "doc_id")
    other = leaf(*[held.get(c, F.col(c)) for c in fields])
    manifest = build(docs, fields, names.get("part", "lang"), doc_id, _held=other)
    requests = manifest.leaves.select("_group", "_rank", doc_id, "_held")
    told = proofs(manifest, requests, [doc_id, "_held"])
    folded = told.withColumn("folded_root", fold(F.col("_held"), F.col("path")))
    siblings = F.transform("path", lambda p: p["sibling"])
    return folded.select(
        doc_id, F.col("digest").alias("leaf"), "subroot", "root", digest(F.array_join(siblings, "")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
