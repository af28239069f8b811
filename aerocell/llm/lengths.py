"""Exact length histogram: what any context limit keeps, from one pass over the lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Lengths are summed in blocks first, so no task orders the whole histogram.
BLOCK = 1024


def length_histogram(lengths: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``by..., length, n_docs``: documents of each encoded length.

    ``lengths`` has ``n_tokens``; a null length is an empty text's, 0. Counted
    before the shuffle, so a source with a third of all rows sends as little as
    any other.
    """
    length = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long").alias("length")
    return lengths.select(*by, length).groupBy(*by, "length").agg(F.count(F.lit(1)).alias("n_docs"))


def context_limits(histogram: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """What each distinct length keeps when it is the context limit.

    Per group ``by`` and ``length``: ``n_docs`` of that length, ``docs_within``
    (at most that long), ``docs_longer``, ``tokens_within``, ``tokens_longer``
    (untruncated), ``truncated_tokens`` (each document cut to the limit),
    ``lost_tokens`` (what the cut drops) and ``quantile``, the share of
    documents within. Any limit between two lengths keeps what the lower one
    keeps, plus the difference for each longer document; see ``at_limit``.

    Suffix sums run in two levels: inside blocks of lengths, and over the few
    block totals. An empty histogram gives no rows; a null group is a group.
    """
    blocks = histogram.select(
        *by,
        "length",
        "n_docs",
        F.floor(F.col("length") / BLOCK).alias("_block"),
        (F.col("length") * F.col("n_docs")).alias("_tokens"),
    )
    after = Window.partitionBy(*by).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    sums = blocks.groupBy(*by, "_block").agg(F.sum("n_docs").alias("_docs"), F.sum("_tokens").alias("_sum"))
    above = sums.select(
        *by,
        "_block",
        F.coalesce(F.sum("_docs").over(after), F.lit(0)).alias("_docs_above"),
        F.coalesce(F.sum("_sum").over(after), F.lit(0)).alias("_tokens_above"),
        F.sum("_docs").over(whole).alias("_all_docs"),
        F.sum("_sum").over(whole).alias("_all_tokens"),
    )
    longer = Window.partitionBy(*by, "_block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    inside = blocks.select(
        "*",
        F.coalesce(F.sum("n_docs").over(longer), F.lit(0)).alias("_docs_in"),
        F.coalesce(F.sum("_tokens").over(longer), F.lit(0)).alias("_tokens_in"),
    )
    same = F.lit(True)
    for column in (*by, "_block"):
        same = same & F.col(f"a.{column}").eqNullSafe(F.col(f"b.{column}"))
    joined = inside.alias("a").join(above.alias("b"), same).select(
        *(F.col(f"a.{c}").alias(c) for c in (*by, "length", "n_docs")),
        (F.col("_docs_in") + F.col("_docs_above")).alias("docs_longer"),
        (F.col("_tokens_in") + F.col("_tokens_above")).alias("tokens_longer"),
        "_all_docs",
        "_all_tokens",
    )
    kept = F.col("_all_tokens") - F.col("tokens_longer") + F.col("length") * F.col("docs_longer")
    within = F.col("_all_docs") - F.col("docs_longer")
    return joined.select(
        *by,
        "length",
        "n_docs",
        within.alias("docs_within"),
        "docs_longer",
        (F.col("_all_tokens") - F.col("tokens_longer")).alias("tokens_within"),
        "tokens_longer",
        kept.alias("truncated_tokens"),
        (F.col("_all_tokens") - kept).alias("lost_tokens"),
        (within / F.col("_all_docs")).alias("quantile"),
    )


def at_limit(limits: DataFrame, limit: int, by: tuple[str, ...] = ()) -> DataFrame:
    """``by..., context, docs_within, docs_longer, truncated_tokens`` for any one limit."""
    below = limits.filter(F.col("length") <= limit)
    shorter = below.groupBy(*by).agg(F.max_by(F.struct("*"), "length").alias("at"))
    every = limits.groupBy(*by).agg(F.max(F.col("docs_within")).alias("_all"))
    same = F.lit(True)
    for column in by:
        same = same & F.col(f"a.{column}").eqNullSafe(F.col(f"b.{column}"))
    # With no document this short, every one is cut to the limit.
    joined = every.alias("b").join(shorter.alias("a"), same, "left")
    longer = F.coalesce(F.col("at.docs_longer"), F.col("_all"))
    return joined.select(
        *(F.col(f"b.{c}").alias(c) for c in by),
        F.lit(limit).cast("long").alias("context"),
        (F.col("_all") - longer).alias("docs_within"),
        longer.alias("docs_longer"),
        (F.coalesce(F.col("at.tokens_within"), F.lit(0)) + limit * longer).alias("truncated_tokens"),
    )


def length_quantiles(limits: DataFrame, shares: tuple[float, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """``by..., share, length``: the least length that covers each share of the documents."""
    asked = F.explode(F.array(*(F.lit(float(s)) for s in shares))).alias("share")
    reached = limits.select(*by, "length", "quantile", asked).filter(F.col("quantile") >= F.col("share"))
    return reached.groupBy(*by, "share").agg(F.min("length").alias("length"))
