"""Connected components of an edge table by alternating large-star and small-star.

Each step is a minimum per vertex (partly aggregated before the shuffle) joined back
to the edges, so a vertex with very many edges is one aggregate row and a join that
adaptive execution can split; nothing is collected. The joins are never broadcasts:
Spark sizes the edges by their files, where repeated components take next to nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("h"),
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component): every vertex of ``edges`` (u, v) with the smallest vertex it reaches."""
    stars = saved(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before = _mark(stars)
    while before[0]:
        stars = saved(_small_star(_large_star(stars)), "stars")
        now = _mark(stars)
        if now == before:
            break
        before = now
    return (
        stars.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        .union(stars.select(F.col("v").alias("vertex"), F.col("v").alias("component")))
        .distinct()
    )
