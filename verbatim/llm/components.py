"""Connected components of a large graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatim.llm.common import Tables


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())


def stars(edges: DataFrame, tables: Tables) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)`` that is not its component's least.

    The number of rounds grows with the logarithm of the graph; each round writes its edges
    to the shared folder and the last but one is deleted.  Nothing is gathered by node: a
    node's neighbours are only reduced to their minimum and joined back.
    """
    seen, i = None, 0
    edges = tables.put(edges, "edges0")
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64(F.greatest("u", "v"), F.least("u", "v")))).first()
        if now[0] == 0 or now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, i = now, i + 1
        edges = tables.put(_small_star(_large_star(edges)), f"edges{i}")
        if i > 1:
            tables.drop(f"edges{i - 2}")
