"""Joining reports, whose keys may be hot, to a side with one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left`` joined to ``right`` on ``keys``, safe for keys that hold a large share of ``left``.

    Where Spark's size check allows, the right side is broadcast and nothing is
    shuffled. Beyond that it is a sort-merge join, and AQE splits the
    partitions of hot keys - but only if both inputs come straight from an
    exchange. A right side that was just aggregated by the same keys would
    reuse its partitioning and switch that off, so the keys' hash is joined on
    as well: it changes no match and makes the (small) right side exchange again.
    A hash depends on the type, so the right side takes the types of the left.
    """
    match = F.xxhash64(*keys).alias("_match")
    right = right.withColumns({k: F.col(k).cast(left.schema[k].dataType) for k in keys})
    joined = left.select("*", match).join(right.select("*", match), [*keys, "_match"], how)
    return joined.drop("_match")
