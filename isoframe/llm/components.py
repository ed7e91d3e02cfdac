"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoframe.llm.scratch import written
from isoframe.llm.skew import dealt_join


def _large_star(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the node's least neighbour."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return dealt_join(both.where("b > a"), least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = dealt_join(down, least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.union(least.select("a", F.col("m").alias("b"))).where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """node, component for each node of ``links`` (columns a, b).

    The component is the least node that can be reached.  Links of a node to
    itself are ignored, as are nulls.  The links are distinct rows written to
    the shared folder in each round; rounds grow with the logarithm of the
    number of nodes.  Links of a node that has many are dealt over tasks.
    """
    now = written(links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    while True:
        # Order-free digest of the links: they are stable once it repeats.
        digest = now.select(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).head()
        if digest == before:
            break
        before = digest
        large = written(_large_star(now).distinct(), "links")
        now = written(_small_star(large).distinct(), "links")
    heads = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(heads)
