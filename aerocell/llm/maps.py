"""Bit maps of sets of hashes, which rule out pairs that cannot be similar and lose none that is."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bit_maps(hashed: DataFrame, by: list[str], words: int) -> DataFrame:
    """``by``, ``_s0...`` and ``_bits``: a map of ``words`` (a power of two) of 64 bits in which each hash sets one, and how many are set.

    A row of ``hashed`` has one hash or more, in the columns whose names begin with ``_h``.
    """
    hashes = [c for c in hashed.columns if c.startswith("_h")]
    bits = [F.expr(f"shiftleft(1L, CAST({c} & 63 AS INT))").alias(f"_bit{i}") for i, c in enumerate(hashes)]
    places = [F.shiftrightunsigned(c, 6).bitwiseAND(F.lit(words - 1)).alias(f"_word{i}") for i, c in enumerate(hashes)]
    placed, none = hashed.select(*by, *bits, *places), F.lit(0).cast("long")

    def word(w: int) -> Column:
        own = [F.when(F.col(f"_word{i}") == w, F.col(f"_bit{i}")).otherwise(none) for i in range(len(hashes))]
        return reduce(Column.bitwiseOR, own)

    maps = [F.bit_or(word(w)) for w in range(words)]
    # Counted with the sums: a long sum in a projection would be copied into every condition on it while Spark plans.
    set_bits = reduce(add, map(F.bit_count, maps)).alias("_bits")
    return placed.groupBy(*by).agg(*(m.alias(f"_s{w}") for w, m in enumerate(maps)), set_bits)


def allows(similarity: float, words: int, x: str, y: str) -> Column:
    """Whether the sizes and maps of two sets, columns with these prefixes, allow the Jaccard similarity.

    ``_n`` is the most and ``_least`` the least number of hashes a set can have.
    A similar pair is never left out. Every bit in which two maps differ is set
    by a hash that only one of the sets has. Of two sets of that similarity s
    with n hashes in all, each counted where it stands, at most
    n (1 - s) / (1 + s) are such.
    """
    differ = reduce(add, (F.bit_count(F.col(f"{x}_s{i}").bitwiseXOR(F.col(f"{y}_s{i}"))) for i in range(words)))
    most = (F.col(f"{x}_n") + F.col(f"{y}_n")) * ((1 - similarity) / (1 + similarity)) + 1e-6
    wide = F.col(f"{x}_n") >= similarity * F.col(f"{y}_least") - 1e-6
    return wide & (F.col(f"{y}_n") >= similarity * F.col(f"{x}_least") - 1e-6) & (differ <= most)
