"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampliframe.session import materialise


def _lean(links: DataFrame) -> DataFrame:
    """Links (u, v) with u > v, each once."""
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return ordered.filter("u > v").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    linked = both.join(least, both["u"] == least["w"]).filter("v > u")
    return _lean(linked.select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
    linked = links.join(least, links["u"] == least["w"])
    moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _lean(moved.unionByName(linked.select("u", F.col("m").alias("v"))))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that a link between two different nodes holds.

    The component is the least node reachable. Nodes are numbers or texts; links with a null are
    left out, repeated and reversed ones count once. Every node's links are moved to its least
    neighbour, first those to greater nodes, then those to smaller ones, until nothing changes;
    the rounds grow with the logarithm of the largest component. Each round is stored in the
    checkpoint folder; a node with very many links is spread by the joins, never gathered.
    """
    named = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    now = materialise(_lean(named))

    def state(df: DataFrame):
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    seen = state(now)
    while seen[0]:
        now = materialise(_small_star(_large_star(now)))
        before, seen = seen, state(now)
        if before == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
