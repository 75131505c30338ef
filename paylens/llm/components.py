"""Connected components of a link table by alternating star rounds.

Every round replaces links by links to smaller ids (large star, then small
star) until nothing changes; then each node links straight to the smallest id
of its component.  The smallest neighbour is an aggregate with map-side partial
results, so a hub never gathers its neighbours in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.scratch import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node link to the smallest of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.join(least, "a").filter("b > a")
            .select(F.col("m").alias("a"), "b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node (b) and its smaller neighbours (a) link to the smallest of these."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = (links.join(least, "b").filter("a != m")
             .select(F.col("m").alias("x"), F.col("a").alias("y")))
    return (moved.unionByName(least.select(F.col("m").alias("x"), F.col("b").alias("y")))
            .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())


def connected_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, component) of every node with a link; ``links`` has bigint columns a, b.

    Self links and nulls are ignored.  The component is its smallest id.
    """
    current = scratch.settle(
        links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(), f"{name}-links0")
    before, turn = None, 0
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first()
        if state == before or not state[0]:
            break
        before, turn = state, turn + 1
        following = scratch.settle(_small_star(_large_star(current)), f"{name}-links{turn}")
        scratch.drop(f"{name}-links{turn - 1}")
        current = following
    return current.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(
        current.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())
