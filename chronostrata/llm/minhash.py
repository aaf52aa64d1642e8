"""Near duplicates: universal hash minima, banding, verification, components.

1. Each text becomes the set of its word shingles (64-bit hashes). Texts with equal sets are one node
   from here on; exact copies cost nothing more.
2. 128 multiply-add hashes of the set are minimised; 16 mixed bits of each minimum are kept, and four
   minima make a band, a 64-bit number. Texts of similarity 0.8 share one of the 32 bands but for
   a chance of 5 in 10^8.
3. A band with several nodes is a bucket. Every node of a bucket is compared with the bucket's least
   node only: first the signatures (at least 0.6 of the minima equal; for a pair of similarity 0.8
   this fails in 1 of 10^8 cases), then the full sets. Components of these links come next.
4. Only links between nodes of a bucket that lie in different components can still matter: strays
   against the bucket's main component and against each other. They are compared in blocks of bounded
   size: the signatures, the sizes, and sets of 16-bit hashes, which never show less in common than the full
   sets do. So what a block lists are links but for hash collisions (more of them in texts of tens of
   thousands of words); the full sets decide, and the components are taken again. The most alike pairs go
   first, twice, and then all that are left: a large group of near copies is one component by then, so the
   pairs within it are never listed, nor are those of a group whose texts are not quite alike enough.

Links inside a component that step 3 has found are not listed: the component is the result.

Defined results: null, empty and blank texts have no shingles and no links; very long texts are taken whole. Fewer words than a
shingle make one shingle. Null ids are the largest ids. Repeated rows are in one component. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostrata.llm.components import components
from chronostrata.llm.native import from_row, whole_row
from chronostrata.llm.spans import mix, pieces, shingle_hashes, word_hashes
from chronostrata.session import cut

BANDS, ROWS = 32, 4
_RNG = np.random.default_rng(7)
MULTIPLY = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64)
ESTIMATE = 0.6
# Rounds over the pairs across components: the three most alike of each node first, which leaves few
# components; then all pairs that are left.
BEST_ROUNDS = (3, 3, None)
CHUNK = 1024  # nodes of a bucket that are compared at a time; all are compared
CHUNK_SHINGLES = 1 << 21  # shingles they have together, but for a single longer text


def _minima(shingles: np.ndarray) -> bytes:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 2048):
        hashed = shingles[at : at + 2048, None] * MULTIPLY[None, :] + ADD[None, :]
        np.minimum(least, hashed.min(axis=0), out=least)
    return (mix(least) >> np.uint64(48)).astype("<u2").tobytes()


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 2):
            words, _, _, borders = word_hashes(part.column(2), lower=True)
            count, node, signature = [], [], []
            for a, b in zip(borders[:-1], borders[1:], strict=True):
                own = np.unique(shingle_hashes(words[a:b], size))
                count.append(len(own))
                node.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                signature.append(_minima(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(count, pa.int64()),
                    pa.array(node, pa.binary()),
                    pa.array(signature, pa.binary()),
                ],
                names=["doc_id", "text_key", "n_shingles", "node", "signature"],
            )

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))
    for batch in batches:
        if batch.num_rows == 0:
            continue
        signature = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u8").reshape(-1, BANDS)
        band = mix(signature ^ number[None, :]).view(np.int64).ravel()
        node = batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))
        yield pa.RecordBatch.from_arrays([pa.array(band), node], names=["band", "node"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps pairs whose signatures agree."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        left, right = (
            np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype="<u2").reshape(-1, BANDS * ROWS) for i in (2, 3)
        )
        keep = pa.array((left == right).mean(axis=1) >= ESTIMATE)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, 1):
            words, _, _, borders = word_hashes(part.column(1), lower=True)
            own = [np.unique(shingle_hashes(words[a:b], size)) for a, b in zip(borders[:-1], borders[1:], strict=True)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.uint64), *own]).view(np.int64)
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
            small = pa.array([np.sort(mix(x) >> np.uint64(48)).astype("<u2").tobytes() for x in own], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), lists, small], names=["node", "shingles", "small"])

    return run


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


class _Links:
    """Compares pairs of nodes: signatures first, then the full sets."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, percent: int):
        self.signed, self.sets, self.percent = nodes.select("node", "signature"), sets, percent

    def verified(self, pairs: DataFrame) -> DataFrame:
        told = pairs.join(self.signed.toDF("a", "sa"), "a").join(self.signed.toDF("b", "sb"), "b")
        alike = cut(told.select("a", "b", "sa", "sb").mapInArrow(_alike, "a binary, b binary"))
        both = alike.join(self.sets.toDF("a", "xa"), "a").join(self.sets.toDF("b", "xb"), "b")
        shared = F.size(F.array_intersect("xa", "xb"))
        union = F.size("xa") + F.size("xb") - shared
        return cut(both.where(shared * 100 >= union * self.percent).select("a", "b"))


def _blocks(crowded: DataFrame, grouped: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Buckets that hold several components, in blocks of at most about 2 * CHUNK nodes.

    Nodes in the component of the bucket's least node (its main one) are compared with the strays of
    the bucket only, strays with all others; both kinds are cut into chunks, and a block pairs two chunks.
    """
    told = crowded.join(grouped, "node", "left").select(
        "band", "node", "least", F.coalesce("component", "node").alias("component")
    )
    main = F.max(F.expr("IF(node = least, component, NULL)")).alias("main")
    buckets = told.groupBy("band").agg(main, F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = told.join(buckets.where("low <> high").select("band", "main"), "band")
    mixed = mixed.join(nodes.select("node", "n_shingles"), "node")
    mixed = cut(mixed.select("band", "node", "component", "n_shingles", (F.col("component") != F.col("main")).alias("stray")))

    def chunks(stray: str) -> Column:
        many, much = (F.sum(F.expr(f"IF({stray}, {x}, 0)")) for x in ("1", "n_shingles"))
        return F.greatest(F.ceil(many / CHUNK), F.ceil(much / CHUNK_SHINGLES)).cast("int")

    counts = mixed.groupBy("band").agg(chunks("NOT stray").alias("mains"), chunks("stray").alias("strays"))
    hashed = F.xxhash64("node")
    rows = mixed.join(counts, "band").join(nodes.select("node", "signature"), "node").join(sets.select("node", "small"), "node")
    chunk = F.when(F.col("stray"), F.col("mains") + F.pmod(hashed, F.col("strays"))).otherwise(F.pmod(hashed, F.col("mains")))
    rows = rows.withColumn("chunk", chunk.cast("int"))
    partners = F.when(F.col("stray"), F.sequence(F.lit(0), F.col("mains") + F.col("strays") - 1)).otherwise(
        F.sequence(F.col("mains"), F.col("mains") + F.col("strays") - 1)
    )
    dealt = rows.withColumn("partner", F.explode(partners))
    item = F.struct("node", "component", "signature", "chunk", "small")
    return dealt.groupBy("band", F.least("chunk", "partner").alias("lo"), F.greatest("chunk", "partner").alias("hi")).agg(
        F.collect_list(item).alias("items")
    )


def _codes(small: bytes) -> np.ndarray:
    """A multiset of 16-bit hashes as a set of numbers: the hash, and how many equal ones stand before it."""
    values = np.frombuffer(small, dtype="<u2").astype(np.int64)  # sorted
    return values + ((np.arange(len(values)) - np.searchsorted(values, values)) << 16)


def _pairs_of_blocks(best: int | None, percent: int):
    """Pairs of a block that lie in different components and whose signatures, sizes and small sets agree: of each
    node the `best` ones, or all. A pair that shares several bands is told in the first of them only."""
    number = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for band, lo, hi, items in zip(*[batch.column(i) for i in range(4)], strict=True):
                items = items.values
                chunk = items.field("chunk").to_numpy()
                node = items.field("node").to_pylist()
                _, component = np.unique(node_codes(items.field("component")), return_inverse=True)
                signature = np.frombuffer(b"".join(items.field("signature").to_pylist()), dtype="<u2").reshape(-1, BANDS * ROWS)
                bands = mix(signature.view("<u8") ^ number[None, :]).view(np.int64)
                here = int(np.argmax((bands == band.as_py()).all(axis=0)))
                codes = [_codes(x) for x in items.field("small").to_pylist()]
                size = np.array([len(x) for x in codes])
                marked = np.zeros(max(int(x.max()) for x in codes) + 1, bool)
                first, second = (np.flatnonzero(chunk == c.as_py()) for c in (lo, hi))
                sides = [(first, second)] if lo.as_py() == hi.as_py() or best is None else [(first, second), (second, first)]
                for own, across in sides:
                    for i in own:
                        others = across[across > i] if lo.as_py() == hi.as_py() and best is None else across
                        others = others[component[others] != component[i]]
                        equal = signature[others] == signature[i]
                        count = np.count_nonzero(equal, axis=1)
                        alike = np.flatnonzero(count >= ESTIMATE * BANDS * ROWS)
                        alike = alike[(bands[others[alike]] == bands[i]).argmax(axis=1) == here]
                        others = others[alike]
                        near = np.minimum(size[others], size[i]) * 100 >= np.maximum(size[others], size[i]) * percent
                        others = others[near]
                        if not len(others):
                            continue
                        marked[codes[i]] = True
                        starts = np.cumsum(size[others]) - size[others]
                        shared = np.add.reduceat(marked[np.concatenate([codes[j] for j in others])].astype(np.int64), starts)
                        marked[codes[i]] = False
                        union = size[others] + size[i] - shared
                        linked = shared * 100 >= union * percent
                        others, likeness = others[linked], (shared / union)[linked]
                        if best is not None and len(others) > best:
                            others = others[np.argsort(-likeness, kind="stable")[:best]]
                        for j in others:
                            a, b = sorted((node[i], node[j]))
                            left.append(a), right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

    return run


def node_codes(nodes: pa.Array) -> np.ndarray:
    """16-byte names as numpy strings, which sort and compare fast."""
    return np.frombuffer(b"".join(nodes.to_pylist()), dtype="V16")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: `doc_id`, `text_key` (digest of the text), `n_shingles`, `first_id` and
    `first_key` (the row that stands for the component: the least id, then the least digest)."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    members = cut(
        texts.mapInArrow(
            _signatures(shingle),
            f"doc_id {id_type}, text_key binary, n_shingles bigint, node binary, signature binary",
        )
    )
    nodes = cut(members.where("n_shingles > 0").dropDuplicates(["node"]))
    bands = nodes.select("node", "signature").mapInArrow(_bands, "band bigint, node binary")
    buckets = bands.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1")
    crowded = cut(bands.join(buckets.drop("n"), "band"))

    # The sets of all nodes that share a bucket, each from one text that stands for it.
    wanted = nodes.join(crowded.select("node").distinct(), "node").select("node", "doc_id", "text_key")
    same = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["text_key"] == wanted["text_key"])
    sets = texts.join(wanted, same).select("node", "text").mapInArrow(
        _sets(shingle), "node binary, shingles array<bigint>, small binary"
    )
    sets = cut(sets.dropDuplicates(["node"]))  # a repeated row gives its node twice

    links = _Links(nodes, sets.select("node", "shingles"), percent)
    stars = crowded.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    linked = links.verified(stars)
    grouped = components(linked)

    for best in BEST_ROUNDS:
        blocks = _blocks(crowded, grouped, nodes, sets)
        pairs = blocks.mapInArrow(_pairs_of_blocks(best, percent), "a binary, b binary")
        more = links.verified(pairs.distinct())
        if not more.isEmpty():
            linked = cut(linked.unionByName(more))
            grouped = components(linked)

    rows = members.join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Struct order puts null ids first; the flag makes them last.
    stand_in = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    firsts = rows.where("component IS NOT NULL").groupBy("component").agg(stand_in)
    out = rows.join(firsts, "component", "left")
    alone = F.col("component").isNull()
    return out.select(
        "doc_id",
        "text_key",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("first_id"),
        F.when(alone, F.col("text_key")).otherwise(F.col("first.text_key")).alias("first_key"),
    )


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with all input columns; a row that is there twice stays once.

    Rows without shingles are components of their own."""
    told = near_duplicates(docs, doc_id, text, shingle, percent)
    kept = told.where(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key")))
    kept = kept.select(F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_key")).distinct()
    keyed = docs.select(whole_row(docs), F.col(doc_id).alias("_id"), text_key(F.col(text)).alias("_key"))
    on = keyed["_id"].eqNullSafe(kept["_kept_id"]) & (keyed["_key"] == kept["_kept_key"])
    return keyed.join(kept, on, "left_semi").dropDuplicates(["_id", "_key"]).select(*from_row(docs.columns))
