"""Connected components of an undirected graph, as rounds of small Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import written


def _both(edges: DataFrame) -> DataFrame:
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return edges.unionByName(back)


def _sign(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (u, v); the root is its component's least node.

    Large and small stars by turns: every node hands its neighbours on to the least of
    them.  Neighbours' minima are reduced before the shuffle, and a hub's rows are split
    by Spark's skew join, so no task holds a hub's whole list.  Each round is written, so
    the next starts from files; the rounds grow with the logarithm of the component size.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = written(edges.distinct(), "components")
    sign = _sign(edges)
    while True:
        both = _both(edges)
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v")
        edges = written(small.distinct(), "components")
        before, sign = sign, _sign(edges)
        if sign == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(tops).distinct()
