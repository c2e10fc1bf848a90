"""Connected components of link tables, as joins and groupings that end after a logarithmic number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for each node of ``links`` (columns ``a`` and ``b``, long): the smallest node reachable.

    Each round hangs all larger neighbours of a node on the smallest node it knows, then all smaller ones, until no
    link changes; the links are then stars around the smallest node. Every round is written to the checkpoint folder.
    No task holds the neighbours of a node: a hub's links are grouped with a map-side minimum, which is written, and
    joined by a plain equi-join whose sides both come from exchanges of their own, so that it can be split. Links with a null end, and links of a node to itself, join nothing.
    """
    links = settle(links.where(F.col("a") != F.col("b"))
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = mark(links)
    while True:
        links = settle(_small_star(_large_star(links)))
        after = mark(links)
        if after == before:
            break
        before = after
    members = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.union(centres)


def mark(links: DataFrame) -> tuple:
    """A fingerprint of a link table: its size and the sum of its rows' hashes."""
    return tuple(links.agg(F.count(F.lit(1)),
                           F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = settle(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    return (both.where(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    # Every link already points from the larger node to the smaller one.
    least = settle(links.groupBy("a").agg(F.min("b").alias("m")))
    moved = links.join(least, "a")
    hung = moved.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", F.col("m").alias("b"))).distinct()
