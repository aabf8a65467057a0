"""Connected components of a graph given as an edge table.

Alternating large-star and small-star steps: every node's neighbours are
hooked to the smallest of them until only stars are left. Each round is two
aggregations joined back to the edges; a node with very many neighbours is a
skewed join with a unique side, which adaptive execution splits. Edges are
written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recprep.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a > b)."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    joined = both.join(least, both["a"] == least["n"])
    if large:
        # neighbours above the node go to the least of node and neighbours
        out = joined.where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.least("m", F.col("n")).alias("b"))
    else:
        # neighbours below the node, and the node itself, go to the least one
        out = joined.where(F.col("b") != F.col("m")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node
    of its component. Loops, repeats, nulls and both directions are allowed;
    no edges give an empty table."""
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    e = staged(e.where(F.col("a") != F.col("b")).distinct(), "edges")

    def state(df: DataFrame):
        return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                      .alias("h")).first()

    before = state(e)
    while before["n"]:
        e = staged(_star(_star(e, True), False), "edges")
        after = state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
