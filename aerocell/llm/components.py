"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocell.session import discard, materialise

# Of up to so many links the least neighbours, twice as many at most, are broadcast.
FEW_LINKS = 100_000


def _both_ways(links: DataFrame) -> DataFrame:
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.union(back)


def _stars(links: DataFrame, large: bool, few: bool) -> DataFrame:
    """Link every neighbour of a node to the least of its neighbourhood, with repeats.

    The large star moves the neighbours above a node, the small star the node
    and those below it; neither changes the components, and the large one has as
    many links as before. Each node's least neighbour is one row: of a ``few``
    links these are broadcast, so the links stay where they are; else a node
    with many links joins as a skewed side that Spark may split.
    """
    if large:
        around = _both_ways(links)
    else:
        around = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("_least"))
    moved = around.join(F.broadcast(least) if few else least, "a")
    if large:
        out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        own = least.select("a", F.col("_least").alias("b"))
        out = moved.select(F.col("b").alias("a"), F.col("_least").alias("b")).union(own)
    return out.filter("a <> b")


def _mark(links: DataFrame) -> tuple:
    """A summary that two tables of distinct links share only if they are the same."""
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(mixed).alias("s"), F.bit_xor(F.xxhash64("b", "a")).alias("x")).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node that has a link; the root is the least node of its component.

    ``links`` has columns ``a`` and ``b`` of one ordered type, in any order and
    with repeats; links with a null end or of a node to itself say nothing.
    Every round is written to the shared folder and read back, so a lost
    executor costs one round, and removed after the next; the number of rounds
    grows with the logarithm of the longest path. Nothing but a count and two checksums reaches the driver.
    """
    kept = links.select("a", "b").filter("a <> b").distinct()
    now = materialise(kept, "links")
    mark = _mark(now)
    while mark[0]:
        few = mark[0] <= FEW_LINKS
        moved = _stars(_stars(now, large=True, few=few), large=False, few=few)
        last, now = now, materialise(moved.distinct(), "links")
        before, mark = mark, _mark(now)
        discard(last)
        if mark == before:
            break
    roots = now.groupBy("a").agg(F.min("b").alias("b"))
    every = roots.select(F.col("a").alias("node"), F.col("b").alias("root"))
    own = roots.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return every.union(own)
