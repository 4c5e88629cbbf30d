"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import stash, unstash


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _star(pairs: DataFrame, centre_too: bool) -> DataFrame:
    """Link every neighbour v of u (and u itself, if centre_too) to the smallest of them; pairs holds (u, v).

    The minima are written first, so that both sides of the join are plain shuffles and a u with very many neighbours can be split.
    """
    least = stash(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "star-minima")
    linked = pairs.join(least, "u")
    if centre_too:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = linked.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    out = stash(out.where("a <> b").distinct(), "star-links")
    unstash(least)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is the smallest node that can be reached.

    Null ends and loops are ignored; repeated and reversed edges are one edge. It runs until nothing changes, which
    takes about log(size) rounds; only counts and a checksum reach the driver.
    """
    now = stash(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _star(both, centre_too=False)
        small = _star(large.select(F.col("a").alias("u"), F.col("b").alias("v")), centre_too=True)
        unstash(now)
        unstash(large)
        now, before = small, mark
        mark = _mark(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
