"""Connected components of a link table, by alternating stars.

Large star: every neighbour above a node is linked to the node's least neighbour. Small star: the same for the
neighbours below it. Links keep their number or shrink; after a few rounds each node is linked to the least
node of its component. Only joins and minima, combined before the shuffle; no component is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.session import written


def _star(links: DataFrame) -> DataFrame:
    """``links(u, v)``: each v is linked to the least of u and u's v's instead; u itself likewise.

    The least nodes are written first: a join of two plain tables is one whose hot keys (the hub of a large
    component has most of its links) adaptive execution splits; of an aggregate's output it can't.
    """
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return links.join(written(least, "least-nodes"), "u")


def _large(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    found = _star(links)
    pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
    return found.select(F.explode(pairs).alias("p")).select("p.*").filter("u > v")


def _are_stars(links: DataFrame) -> bool:
    """Whether each u has one v and no v is a u. As v is below u, each v then is the least of its component."""
    several = links.groupBy("u").count().filter("count > 1")
    inner = links.select("v").join(links.select(F.col("u").alias("v")), "v", "left_semi")
    return not several.limit(1).count() and not inner.limit(1).count()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: root is the least node reachable.

    Links to itself, repeated and reversed links are allowed; rows with a null are no links. Each round is
    written to the shared folder, so lost executors cost at most the round.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = written(ordered.distinct(), "links")
    while not _are_stars(current):
        wide = written(_large(current).distinct(), "links")
        current = written(_small(wide).distinct(), "links")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
