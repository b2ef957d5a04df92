"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlark.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not the least of its component.

    Each round points every neighbour above a node to the least node that it sees, then every
    neighbour below it; both are joins on the node, so a node with very many links is spread
    over tasks.  It ends when a round changes nothing: every component is then a star.
    """
    up = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = scratch.keep(links.filter("a <> b").select(*up).distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), "m").distinct()
        least = large.groupBy("u").agg(F.min("m").alias("m"))
        small = large.withColumnRenamed("m", "v").join(least, "u").filter("v <> m").select("v", "m")
        after = scratch.keep(small.union(least).toDF("u", "v").distinct())
        scratch.drop(edges)
        edges, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    return edges.toDF("node", "root")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
