"""Connected components by alternating large-star and small-star steps.

Each step is a grouping by node with a partial minimum and a join back, so a node with
very many neighbours needs no list of them; adaptive execution splits its join. The
edges between steps are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b), both bigint; the component
    is its smallest node."""
    edges = materialise(_oriented(edges))
    before = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = _oriented(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = materialise(_oriented(small))
        now = edges.agg(F.count(F.lit(1)), F.expr("coalesce(sum(cast(xxhash64(a, b) as decimal(20,0))), 0)")).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node, without loops."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
