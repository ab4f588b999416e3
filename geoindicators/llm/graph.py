"""Connected components of an edge list, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.llm.common import table


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): comp is the least node of the component; edges (a, b) of any comparable type.

    Alternates large-star and small-star steps until the edges no longer change: the number of rounds grows with the
    logarithm of the longest path.  A step takes the least neighbour of each node (aggregated map-side), writes it and joins it back.
    It is written because the exchange of an aggregate would serve the join too, and AQE splits only a join's own exchanges: so
    a node with very many neighbours is split.
    Null ends and loops don't count; without edges there are no rows.
    """
    edges = table(edges.where("a is not null and b is not null and a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    size = _shape(edges)
    while True:
        edges = table(_small_star(_large_star(edges)), "edges")
        if (now := _shape(edges)) == size:
            break
        size = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def _shape(edges: DataFrame) -> tuple:
    """Equal before and after a round only if the round changed nothing: both steps only ever lower ends."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of itself and its neighbours."""
    both = edges.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(edges.select(F.col("b").alias("n"), F.col("a").alias("m")))
    least = table(both.groupBy("n").agg(F.min("m").alias("l")).select("n", F.least("n", "l").alias("l")), "least")
    return both.join(least, "n").where("m > n and m != l").select(F.col("m").alias("a"), F.col("l").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of them; edges hold a > b."""
    least = table(edges.groupBy("a").agg(F.min("b").alias("l")), "least")
    moved = edges.join(least, "a").where("b != l").select(F.col("b").alias("a"), F.col("l").alias("b"))
    return moved.unionByName(least.select("a", F.col("l").alias("b"))).distinct()
