"""Connected components of a link table, in Spark (alternating large and small stars).

Every round joins links with the smallest neighbour of each node, so a node's links are
never gathered in one place, and writes its links to the shared folder.  The number of
rounds grows with the logarithm of the longest chain.

Defined results: self-links and repeated links change nothing; links with a null end are
ignored; an empty table has no components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventfeat.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    """Each neighbour larger than the node is tied to the node's smallest neighbour."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a"), F.least("a", "m").alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """``e`` has a > b: the node and its smaller neighbours are tied to the smallest."""
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    ties = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return ties.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of ``links(a, b)``."""
    e = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    e = written(e, "links")
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    before = e.select(mark).first()
    while True:
        e = written(_small_star(_large_star(e)), "links")
        after = e.select(mark).first()
        if after == before:
            break
        before = after
    # now every node is tied to its component's smallest node, and to nothing else
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
