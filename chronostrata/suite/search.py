"""Vector lookup over the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronostrata.operators.search import vector_top_k
from chronostrata.suite.base import query, table

TOP = 10


@query("vector_top_k", f"""
    WITH parts AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    centre AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS c FROM parts GROUP BY label, i),
    dots AS (SELECT c.label AS query_id, p.vec_id, sum(c.c * p.x) / sqrt(sum(CAST(p.x AS DOUBLE) * p.x)) AS s
             FROM parts p JOIN centre c ON c.i = p.i GROUP BY c.label, p.vec_id)
    SELECT query_id, vec_id, rank FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS INTEGER) AS rank FROM dots) x
    WHERE rank <= {TOP}""")
def vector_top_k_(spark, sf):
    """Vectors nearest to the mean of each label."""
    vectors = table(spark, sf, "embeddings")
    parts = vectors.select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("c"))
    # One entry per dimension of the vectors, whatever their number.
    ordered = F.array_sort(F.collect_list(F.struct("i", "c")))
    queries = means.groupBy("label").agg(F.transform(ordered, lambda e: e["c"]).alias("embedding"))
    found = vector_top_k(queries.withColumnRenamed("label", "query_id"), vectors, TOP)
    return found.select("query_id", "vec_id", "rank")
