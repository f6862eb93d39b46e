"""Property-graph operators on node and edge tables, and vector search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def expand(edges: DataFrame, seeds: DataFrame, valid: Column) -> DataFrame:
    """Edges that touch a seed (column id) and are valid, once each: two semi-joins instead of a disjunction."""
    live = edges.filter(valid)
    out = live.join(seeds.select(F.col("id").alias("start_id")), "start_id", "left_semi").select(*edges.columns)
    into = live.join(seeds.select(F.col("id").alias("end_id")), "end_id", "left_semi").select(*edges.columns)
    return out.unionByName(into).distinct()


def mirrored(edges: DataFrame) -> DataFrame:
    """Edges and the reverse of every edge whose reverse is not asserted; ``was_mirrored`` tells."""
    reverse = edges.select(F.col("end_id").alias("start_id"), F.col("start_id").alias("end_id"))
    missing = reverse.join(edges.select("start_id", "end_id"), ["start_id", "end_id"], "left_anti").distinct()
    return edges.select("start_id", "end_id").distinct().withColumn("was_mirrored", F.lit(False)).unionByName(missing.withColumn("was_mirrored", F.lit(True)))


def asymmetric(edges: DataFrame) -> DataFrame:
    """Edges without their reverse."""
    return edges.select("start_id", "end_id").distinct().join(
        edges.select(F.col("end_id").alias("start_id"), F.col("start_id").alias("end_id")), ["start_id", "end_id"], "left_anti"
    )


def without_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("start_id").alias("id")).unionByName(edges.select(F.col("end_id").alias("id")))
    return nodes.join(ends, "id", "left_anti")


def cosine_top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score, rank: the k nearest vectors of each query. The queries are a small stated set, sent to all vectors."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    q = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    pairs = vectors.join(F.broadcast(q)).filter("query_id != vec_id")
    score = dot(F.col("embedding"), F.col("q")) / F.sqrt(dot(F.col("embedding"), F.col("embedding")) * dot(F.col("q"), F.col("q")))
    scored = pairs.select("query_id", "vec_id", F.round(score, 6).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return scored.withColumn("vec_rank", F.row_number().over(w)).filter(F.col("vec_rank") <= k)


def constraint_counts(checks: dict[str, DataFrame]) -> DataFrame:
    """check_name, n_violations of every check (a DataFrame of violating rows)."""
    parts = [df.agg(F.count("*").alias("n_violations")).select(F.lit(name).alias("check_name"), "n_violations") for name, df in checks.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
