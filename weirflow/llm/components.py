"""Connected components of a graph given as a table of edges.

Large-star and small-star steps: each vertex hands its neighbours to its smallest neighbour until every component
is a star. Each step is a grouped minimum and a join, so no neighbourhood is ever gathered in one task, and the
number of edges never grows. The edges are written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import saved


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each vertex's larger neighbours to the smallest of its neighbours and itself."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each vertex and its smaller neighbours to the smallest of them. Edges point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
    return moved.select("e.*").where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``edges`` (a, b): root is the smallest vertex of its component.

    Self-links and repeated links do no harm; links with a null end are left out. An empty table gives an empty one.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = saved(edges, "edges")
    while True:
        after = saved(_small_star(_large_star(edges)), "edges")
        # A round that changes nothing has the same set of edges; both are sets, so equal size and no row apart.
        if after.count() == edges.count() and after.join(edges, ["a", "b"], "left_anti").isEmpty():
            break
        edges = after
    roots = after.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    return after.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(roots)
