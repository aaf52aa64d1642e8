"""WARC records and their fixity: Merkle trees over ordered offset ranges, and an audit of replicas.

Pages become response records; records of an archive stand one after another, so each has an offset.
A leaf of the archive's tree is the digest of a record's bytes together with its length. A node is the digest
over its (up to) 64 children in order and the length of their range. Offsets follow from the lengths, so
a record that grows or shrinks changes its own branch and no other: a hash stands for the same bytes wherever
they begin. Trees of two replicas are compared from the roots: only children of nodes that differ are looked at
on the next level, down to the records. Reported are records that are damaged, missing, or added, and runs of
records that stand elsewhere, one row for all neighbours with the same shift.

Nodes are grouped by (archive, place of the parent), at most 64 to a group, so an archive that holds a third
of all records is spread like any other. Each level is written to the shared folder; a tree over n
records has log64(n) levels above the leaves. Records are ordered in slices that Spark's range
partitioning makes, so keys may be of any type that sorts and lie as unevenly as they like.

Defined results: a null page is a record without content, a null url an empty one; very long pages are digested
whole. Records are in order of key (null keys first), equal keys in order of their digests; repeated rows are
records each. An empty archive has no root; replicas that both lack an archive agree on it. An empty table
gives an empty report. Further columns of the pages are not used, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronostrata.llm.native import slice_bits, with_running
from chronostrata.session import cut

FANOUT = 64
SLICE_ROWS = 4000
HEADER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: {}\r\nContent-Type: text/html\r\nContent-Length: {}\r\n\r\n"


def warc_record(url: Column, html: Column) -> Column:
    """The bytes of one record: header, content, two line ends."""
    before, between, after = HEADER.split("{}")
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit(before),
        F.coalesce(url, F.lit("")),
        F.lit(between),
        F.octet_length(body).cast("string"),
        F.lit(after),
        body,
        F.lit("\r\n\r\n"),
    ).cast("binary")


def records(pages: DataFrame, archive: Column, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The ordered records of archives: (archive, key, digest, offset, length, ordinal).

    The bytes themselves are digested where they are read; only their digests are shuffled."""
    data = warc_record(F.col(url), F.col(html))
    slim = pages.select(
        F.coalesce(archive.cast("string"), F.lit("")).alias("archive"),
        F.col(key).alias("key"),
        F.sha2(data, 256).alias("digest"),
        F.octet_length(data).cast("long").alias("length"),
    )
    return cut(slim)


def _ordered(slim: DataFrame) -> DataFrame:
    """Offsets and ordinals. Slices are ranges of (key, digest) over all archives together, so that no archive
    is one task."""
    bits = slice_bits(slim.count(), SLICE_ROWS)
    sliced = slim.repartitionByRange(1 << bits, "key", "digest")
    # Written before use: the sample that ranges come from may differ when a lost partition is computed again.
    placed = cut(sliced.withColumns({"_at": F.spark_partition_id().cast("long"), "_one": F.lit(1)}))
    run = with_running(placed, "archive", "_at", ["key", "digest"], {"length": "offset", "_one": "ordinal"}, bits, bits)
    return run.select("archive", "key", "digest", "length", "offset", "ordinal")


@dataclass
class MerkleTree:
    """Levels from the leaves to the roots: (archive, place, hash, start, end), leaves also `key` and `digest`."""

    levels: list[DataFrame]

    @property
    def roots(self) -> DataFrame:
        return self.levels[-1]

    def padded(self, depth: int, fanout: int) -> list[DataFrame]:
        """The levels, with parents of the roots on top until there are `depth` of them."""
        levels = list(self.levels)
        while len(levels) < depth:
            levels.append(cut(parents(levels[-1], fanout)))
        return levels


def parents(level: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The next level: at most `fanout` children to a node."""
    child = F.struct("place", "hash", "start", "end")
    grouped = level.groupBy("archive", F.floor(F.col("place") / fanout).cast("long").alias("up"))
    node = grouped.agg(F.array_sort(F.collect_list(child)).alias("c"))
    joined = F.array_join(F.transform("c", lambda x: x["hash"]), "")
    start, end = F.array_min(F.transform("c", lambda x: x["start"])), F.array_max(F.transform("c", lambda x: x["end"]))
    whole = F.sha2(F.concat_ws("|", joined, end - start), 256)
    return node.select("archive", F.col("up").alias("place"), whole.alias("hash"), start.alias("start"), end.alias("end"))


def merkle_tree(slim: DataFrame, fanout: int = FANOUT) -> MerkleTree:
    """The trees of all archives, one per archive; smaller ones repeat their root up to the top."""
    leaf = F.sha2(F.concat_ws("|", "digest", "length"), 256)
    level = cut(
        _ordered(slim).select(
            "archive", F.col("ordinal").alias("place"), leaf.alias("hash"), F.col("offset").alias("start"),
            (F.col("offset") + F.col("length")).alias("end"), "key", "digest",
        )
    )
    levels = [level]
    while (top := levels[-1].agg(F.max("place")).first()[0]) is not None and (top > 0 or len(levels) == 1):
        levels.append(cut(parents(levels[-1], fanout)))
    return MerkleTree(levels)


def _differing(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Nodes of one level whose hashes differ, or that one side lacks."""
    left = a.select("archive", "place", *[F.col(c).alias(f"a_{c}") for c in columns])
    right = b.select("archive", "place", *[F.col(c).alias(f"b_{c}") for c in columns])
    both = left.join(right, ["archive", "place"], "full")
    return both.where(~F.col("a_hash").eqNullSafe(F.col("b_hash")))


def _paired(both: DataFrame, *names: str) -> DataFrame:
    """The n-th record of one side with the n-th of the other, among those equal in `names`: (archive, a, b)."""
    keys = [F.col(n).alias(f"_{i}") for i, n in enumerate(names)]
    keyed = both.select("*", *keys)
    own = [f"_{i}" for i in range(len(names))]
    nth = keyed.withColumn("_n", F.row_number().over(Window.partitionBy(*own, "side").orderBy("r.place")))
    sides = [F.max(F.when(F.col("side") == i, F.col("r"))).alias(x) for i, x in enumerate("ab")]
    return nth.groupBy(*own, "_n").agg(*sides).select(F.col("_0").alias("archive"), "a", "b")


def _moved(differing: DataFrame, pairs: DataFrame, ours: DataFrame) -> DataFrame:
    """Runs of neighbours in our order that start elsewhere on the other side, by the same shift.

    Records in nodes that agree are not looked at: between two places that differ, the n-th of one side is the n-th
    of the other, and all are shifted by what the places before have added or lost."""
    last = ours.groupBy("archive").agg((F.max("place") + 1).alias("q"), F.max("end").alias("q_start"))
    bits = slice_bits(2 * differing.count())
    order_bits = max(bits, int(last.agg(F.max("q")).first()[0] or 0).bit_length())
    one = differing.withColumn("_one", F.lit(1))
    numbered = cut(with_running(one, "archive", "place", [], {"_one": "_k"}, bits, order_bits))
    after = numbered.select("archive", (F.col("_k") - 1).alias("_k"), F.col("place").alias("q"), F.col("a_start").alias("q_start"))
    shift = F.col("b_end") - F.col("a_end")
    shifted = numbered.select("archive", "_k", "place", "a_end", shift.alias("shift"))
    between = cut(shifted.join(after, ["archive", "_k"], "left").where("shift <> 0"))
    tail = between.where("q IS NULL").drop("q", "q_start").join(last, "archive")
    stretch = between.where("q IS NOT NULL").unionByName(tail).where("q > place + 1")
    stretch = stretch.select("archive", F.col("place") + 1, F.col("q") - F.col("place") - 1, F.col("a_end"), F.col("q_start"), "shift")
    names = ["archive", "place", "n_records", "start", "end", "shift"]
    stretch = stretch.toDF(*names).withColumn("other_end", F.col("end") + F.col("shift"))
    # A record that differs may have another length, so its end can be shifted otherwise than its start.
    single = pairs.where("a.start <> b.start").select(
        "archive", "a.place", F.lit(1).cast("long"), "a.start", "a.end", F.col("b.start") - F.col("a.start"), "b.end"
    )
    items = stretch.unionByName(single.toDF(*names, "other_end"))
    part = F.concat_ws(":", F.col("shift").cast("string"), "archive")
    run = with_running(items.withColumn("_part", part), "_part", "place", [], {"n_records": "_before"}, bits, order_bits)
    # Constant within a run of neighbours, greater after every gap.
    grouped = run.groupBy("archive", "shift", (F.col("place") - F.col("_before")).alias("_run"))
    return grouped.agg(
        F.min("place").alias("place"), F.sum("n_records").alias("n_records"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.max("other_end").alias("other_end"),
    ).withColumn("other_start", F.col("start") + F.col("shift"))


def audit(ours: MerkleTree, theirs: MerkleTree, fanout: int = FANOUT) -> DataFrame:
    """What differs between replicas: (archive, place, n_records, key, start, end, other_key, other_start,
    other_end, kind). Subtrees with equal hashes are not looked into.

    Records that differ are paired by key, equal digests first, then in order of place. `damaged` ones have other
    bytes; `missing` and `added` ones have no partner. `moved` rows are runs of `n_records` neighbours that begin at
    another offset, all by the same number of bytes; damaged ones among them count as moved too. Runs have no key."""
    depth = max(len(ours.levels), len(theirs.levels))
    side = [t.padded(depth, fanout) for t in (ours, theirs)]
    open_: DataFrame | None = None
    for i in range(depth - 1, 0, -1):
        a, b = (levels[i] for levels in side)
        if open_ is not None:
            a, b = (x.join(open_, ["archive", "place"], "left_semi") for x in (a, b))
        found = _differing(a, b, ["hash"])
        first = F.col("place") * fanout
        below = F.explode(F.sequence(first, first + fanout - 1)).alias("place")
        open_ = cut(found.select("archive", below))
    a, b = (levels[0] for levels in side)
    if open_ is not None:
        a, b = (x.join(open_, ["archive", "place"], "left_semi") for x in (a, b))
    names = ["start", "end", "key", "digest"]
    differing = cut(_differing(a, b, ["hash", *names]))

    def records_of(i: int, x: str) -> DataFrame:
        record = F.struct("place", *[F.col(f"{x}_{c}").alias(c) for c in names])
        return differing.where(f"{x}_hash IS NOT NULL").select(F.lit(i).alias("side"), "archive", record.alias("r"))

    same = cut(_paired(records_of(0, "a").unionByName(records_of(1, "b")), "archive", "r.key", "r.digest"))
    alone = [same.where(f"{x} IS NULL").select(F.lit(i).alias("side"), "archive", F.col(y).alias("r")) for i, (x, y) in enumerate(["ba", "ab"])]
    rest = cut(_paired(alone[0].unionByName(alone[1]), "archive", "r.key"))
    kind = F.when(F.col("b").isNull(), F.lit("missing")).when(F.col("a").isNull(), F.lit("added")).otherwise(F.lit("damaged"))
    told = rest.select(
        "archive", F.coalesce("a.place", "b.place").alias("place"), F.lit(1).cast("long").alias("n_records"), F.col("a.key").alias("key"),
        F.col("a.start").alias("start"), F.col("a.end").alias("end"), F.col("b.key").alias("other_key"), F.col("b.start").alias("other_start"),
        F.col("b.end").alias("other_end"), kind.alias("kind"),
    )
    pairs = same.unionByName(rest).where("a IS NOT NULL AND b IS NOT NULL")
    none = F.lit(None).cast(told.schema["key"].dataType)
    runs = _moved(differing, pairs, ours.levels[0])
    return told.unionByName(
        runs.select(
            "archive", "place", "n_records", none.alias("key"), "start", "end", none.alias("other_key"), "other_start", "other_end",
            F.lit("moved").alias("kind"),
        )
    )


def moved_records(told: DataFrame, ours: MerkleTree) -> DataFrame:
    """The report with one row per record, runs of moved ones opened: `key`, `start` and `end` of each, and where it
    stands on the other side. Damaged records have their own row and no second one.

    A run may span an archive, so it is opened in pieces of at most SLICE_ROWS places that are dealt anew."""
    names = ["archive", "place", "key", "start", "end", "other_key", "other_start", "other_end", "kind"]
    shift = (F.col("other_start") - F.col("start")).alias("shift")
    runs = told.where("kind = 'moved'").select("archive", F.col("place").alias("first"), (F.col("place") + F.col("n_records") - 1).alias("last"), shift)
    steps = F.explode(F.sequence("first", "last", F.lit(SLICE_ROWS).cast("long"))).alias("at")
    dealt = runs.select("archive", "last", "shift", steps).repartition("archive", "at")
    places = dealt.select("archive", "shift", F.explode(F.sequence("at", F.least("last", F.col("at") + SLICE_ROWS - 1))).alias("place"))
    single = told.where("kind <> 'moved'")
    moved = ours.levels[0].join(places, ["archive", "place"]).join(
        single.where("kind = 'damaged'").select("archive", "place"), ["archive", "place"], "left_anti"
    )
    to = [(F.col(c) + F.col("shift")).alias(f"other_{c}") for c in ("start", "end")]
    opened = moved.select("archive", "place", "key", "start", "end", F.col("key").alias("other_key"), *to, F.lit("moved").alias("kind"))
    return single.select(*names).unionByName(opened)
