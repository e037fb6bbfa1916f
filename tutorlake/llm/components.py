"""Connected components of a graph given as a table of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlake.sources.tables import settle


def _towards_least(pairs: DataFrame) -> DataFrame:
    """Each ``(u, v)`` with the least of ``u`` and all its ``v``. A node with many links is only summed up."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return pairs.join(least.select(F.col("u").alias("node"), "least"), F.col("u") == F.col("node")).select(
        "u", "v", F.least("u", "least").alias("m")
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    starred = _towards_least(both)
    return starred.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _towards_least(down)
    moved = starred.select(F.col("v").alias("u"), F.col("m").alias("v")).union(starred.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, root)`` for every node with a link to another; the root is the least node it can reach.

    Links may repeat, point either way or to themselves; null ends are left out. Rounds grow with the
    logarithm of the graph's size. Every round is written to the shared folder, so a lost executor costs
    at most one round; the driver sees two numbers per round.
    """
    links = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").distinct()
    links = settle(links, "links")
    before = _state(links)
    while before[0]:
        links = settle(_small_star(_large_star(links)), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
