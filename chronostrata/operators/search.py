"""Nearest vectors."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERY_BLOCK = 1024
VECTOR_PART = 1_000_000
BROADCAST_BYTES = 64 << 20


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1, norms)


def vector_top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    query_id: str = "query_id",
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block: int = QUERY_BLOCK,
    part: int = VECTOR_PART,
) -> DataFrame:
    """The `k` stored vectors with the greatest cosine to each query, exactly; ties go by the id.

    Queries are numbered into blocks of about `block`, each one row. Vectors stay in their partitions and are
    packed there, an Arrow batch to a row. Every pack meets every block by a join on the block's number: blocks
    that are small together (their size is checked) are broadcast, so vectors are not shuffled; more of them are
    dealt with the packs over a grid of blocks and parts of the vectors. A joined row is one matrix product, which sends
    on at most `k` vectors per query, and the best `k` are kept again before and after the last shuffle. It is one plan
    for any number of queries, none of which goes through the driver. Queries are read twice (counted, packed): where
    they are costly to make, `session.cut` them first.

    Rows without a vector are neither asked for nor found; queries and vectors of different lengths do not
    meet. `ragged` lists what therefore has no partner.
    """
    asked = queries.where(F.col(embedding).isNotNull()).select(F.col(query_id).alias("_id"), _doubles(embedding))
    stored = vectors.where(F.col(embedding).isNotNull()).select(F.col(vec_id).alias("_id"), _doubles(embedding))
    n, longest = asked.agg(F.count("*"), F.max(F.size("_x"))).first()
    blocks = max(1, ceil(n / block))
    small = n * (longest or 0) * 8 <= BROADCAST_BYTES
    parts = 1 if small else max(1, ceil(stored.count() / part))
    rows = asked.withColumn("_b", F.pmod(F.xxhash64("_id", "_x"), F.lit(blocks)))
    packed = rows.groupBy("_b").agg(F.collect_list(F.struct("_id", "_x")).alias("asked"))
    packed = F.broadcast(packed) if small else packed.withColumn("_p", F.explode(_numbers(parts)))
    query_type, vec_type = queries.schema[query_id].dataType, vectors.schema[vec_id].dataType
    pack = T.StructType([T.StructField("held", _pack_type(vec_type))])
    packs = stored.mapInArrow(_pack, pack)
    if not small:
        packs = packs.withColumn("_p", F.pmod(F.xxhash64(F.col("held")[0]["_id"]), F.lit(parts)))
    met = packs.withColumn("_b", F.explode(_numbers(blocks))).join(packed, ["_b"] if small else ["_b", "_p"])
    schema = T.StructType([T.StructField("_q", query_type), T.StructField("_v", vec_type), T.StructField("score", T.DoubleType())])
    scored = met.select("asked", "held").mapInArrow(_scorer(k), schema)
    best = Window.partitionBy("_q").orderBy(F.desc("score"), F.asc("_v"))
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("_q").alias(query_id), F.col("_v").alias(vec_id), "score", "rank")


def ragged(
    queries: DataFrame, vectors: DataFrame, query_id: str = "query_id", vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """Rows that can meet nothing: without a vector, or of a length the other side does not have. (side, id, length)."""

    def lengths(df: DataFrame, side: str, name: str) -> DataFrame:
        return df.select(F.lit(side).alias("side"), F.col(name).cast("string").alias("id"), F.size(embedding).alias("length"))

    both = lengths(queries, "query", query_id).unionByName(lengths(vectors, "vector", vec_id))
    both = both.withColumn("length", F.when(F.col("length") >= 0, F.col("length")))
    # One row per length that both sides have.
    shared = both.where(F.col("length").isNotNull()).groupBy("length").agg(F.countDistinct("side").alias("_sides")).where("_sides = 2")
    return both.join(shared, "length", "left_anti").select("side", "id", "length")


def _doubles(column: str) -> Column:
    return F.col(column).cast("array<double>").alias("_x")


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _pack_type(id_type: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("_id", id_type), T.StructField("_x", T.ArrayType(T.DoubleType()))]))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per batch, with all its rows in a list."""
    for batch in batches:
        if batch.num_rows:
            rows = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], names=["_id", "_x"])
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, batch.num_rows], rows)], names=["held"])


def _by_length(rows: pa.StructArray) -> dict[int, tuple[pa.Array, np.ndarray]]:
    """Ids and unit vectors of each length; vectors with a NULL inside are left out."""
    ids, lists = rows.field("_id"), rows.field("_x")
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    told = {}
    for n in np.unique(sizes[sizes > 0]):
        at = pa.array(np.flatnonzero(sizes == n))
        matrix = lists.take(at).flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, int(n))
        whole = np.flatnonzero(~np.isnan(matrix).any(axis=1))
        told[int(n)] = ids.take(at).take(pa.array(whole)), _unit(matrix[whole])
    return told


def _scorer(k: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asked, held in zip(batch.column(0), batch.column(1), strict=True):
                vectors = _by_length(held.values)
                for n, (names, queries) in _by_length(asked.values).items():
                    if n in vectors and len(queries) and len(vectors[n][0]):
                        yield _best(names, queries, *vectors[n], k)

    return score


def _best(names: pa.Array, queries: np.ndarray, others: pa.Array, units: np.ndarray, k: int) -> pa.RecordBatch:
    scores = queries @ units.T
    take = min(k, len(units))
    floor = np.partition(scores, -take, axis=1)[:, -take]
    order = pc.sort_indices(others).to_numpy()
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    picked = []
    for row, least in zip(scores, floor, strict=True):
        at_least = np.flatnonzero(row >= least)
        picked.append(at_least[np.lexsort((place[at_least], -row[at_least]))[:take]])
    q, v = np.repeat(np.arange(len(queries)), take), np.concatenate(picked)
    return pa.RecordBatch.from_arrays([names.take(pa.array(q)), others.take(pa.array(v)), pa.array(scores[q, v])], names=["_q", "_v", "score"])
