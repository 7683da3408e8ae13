"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def _lowest(links: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, the node itself included; combined before the shuffle, so a hub is one row a task."""
    return links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame) -> DataFrame:
    """Every (a, b) of ``links`` becomes (smallest neighbour of a, b); the join's large side can be split where a hub is hot."""
    return links.join(_lowest(links), "a")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a long, b long); component is the smallest node reachable.

    Links to oneself, repeats and either direction are allowed; nulls are ignored. Each round is settled in the checkpoint
    folder; the number of rounds grows with the logarithm of the longest chain.
    """
    links = settled(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        around = _star(_both_ways(links))
        large = around.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        down = _star(large.where("a > b").distinct())
        small = down.select(F.col("b").alias("a"), F.col("low").alias("b")).union(down.select("a", F.col("low").alias("b")))
        links = settled(small.where("a > b").distinct())
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
