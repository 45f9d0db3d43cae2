"""Connected components of a graph given as edges, by rounds of large and small stars.

A round makes each vertex's neighbours point at the smallest of them: first the larger ones (large star),
then the smaller ones (small star). Edges only ever get shorter to the smallest vertex, rounds grow with
the logarithm of the longest path, and every round is written to the shared folder. A star's rows are
aggregated before they move, and what is joined to them is a written table, so that both sides of a join
come from a shuffle and Spark can split the rows of a vertex with very many neighbours over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.llm.common import drop_written, written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """v and root (the smallest vertex of its component) for every vertex of edges (u, v: bigint) that
    isn't a root itself. Loops and repeated edges don't matter; null ends are ignored. Fails where rounds
    haven't settled after ``most_rounds``, which paths of some 2**60 vertices would need."""
    now = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        # large star: each neighbour greater than a vertex points at the least of the vertex and its neighbours
        both = _both(now)
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = written(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "large")
        # small star: a vertex and its lesser neighbours point at the least of them
        lesser = written(large.groupBy("u").agg(F.min("v").alias("m")), "lesser")
        small = large.join(lesser, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        last, now = now, written(small, "edges")
        size = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v") % F.lit(1 << 40)), F.lit(0))).first()
        drop_written(last, least, large, lesser)
        if size == before:
            break
        before = size
    else:
        raise RuntimeError(f"components haven't settled after {most_rounds} rounds")
    return now.select(F.col("u").alias("v"), F.col("v").alias("root"))
