"""Connected components of a graph of links, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from basketry.llm.common import counted, written


def _follow(rows: DataFrame, column: str, forest: DataFrame) -> DataFrame:
    """`column` replaced by its parent where it has one."""
    parents = forest.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    met = rows.join(parents, F.col(column) == F.col("_node"), "left")
    return met.withColumn(column, F.coalesce("_root", column)).drop("_node", "_root")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that is not the root of its component; `links` is (a, b) of any type with an order.

    Each round hooks every node to its least smaller neighbour, shortens the paths to their roots, and replaces links by
    links between roots, of which at least all locally greatest nodes are gone. Grouping combines before it shuffles and
    a node with very many links is a join key that adaptive execution splits.
    """
    ends = links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges, left = counted(ends.distinct(), "edges")
    found = edges.select(F.col("b").alias("node"), F.col("a").alias("root")).limit(0)
    while left:
        forest = written(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "hooks")
        moved = 1
        while moved:
            further = _follow(_follow(forest.withColumn("before", F.col("root")), "root", forest), "root", forest)
            seen = Observation()
            forest = written(further.observe(seen, F.count_if(F.col("before") != F.col("root")).alias("moved")).drop("before"), "hooks")
            moved = seen.get["moved"]
        found = written(_follow(found, "root", forest).union(forest), "roots")
        joined = _follow(_follow(edges, "a", forest), "b", forest).where(F.col("a") != F.col("b"))
        edges, left = counted(joined.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return found


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """`components` of `links` and of all those that gave `roots`, which are not read again: links are moved to the roots of
    their ends, and what these join is followed by the nodes known before."""
    joined = components(_follow(_follow(links, "a", roots), "b", roots))
    return written(_follow(roots, "root", joined).union(joined), "roots")
