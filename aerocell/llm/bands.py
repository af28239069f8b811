"""MinHash bands: signatures of sets of hashes, and links checked against each band's most frequent member."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from aerocell.llm.components import components
from aerocell.session import discard, materialise, runtime_conf

# At similarity 0.8 a pair shares a band with probability 1 - (1 - 0.8^3)^10 = 0.9992.
BANDS = 10
ROWS = 3
# Minima are taken in 2^5 parts of the hash range, one per permutation.
_PREFIX_BITS = 5
_REST = 64 - _PREFIX_BITS
# Hashes kept per part: a part of a large set is empty with probability e^-7.
_PER_PART = 7
# Sides up to this many rows and bytes, as they lie in memory, are broadcast, larger ones shuffled.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32_000_000

# Of a row in a table that is broadcast, beside its columns.
_ROW_BYTES = 40

# Bands of up to so many nodes are checked pair by pair at once.
SMALL = 16
# Rounds of checks against members of a band's largest component, and members a round.
ROUNDS = 8
PIVOTS = 3
# Pairs for each node that are compared, by what rules most out, without a round.
_FEW = 128
# A round is followed by another if no more than this share of the nodes stays apart.
_HELPED = 0.9

# Members more frequent than this rank alike.
_RANKED = (1 << 22) - 1


def bounded(df: DataFrame) -> DataFrame:
    """``df``, a written table of numbers, to be broadcast if it is small, else to be merged.

    Left to itself Spark would go by the size of the files, which are packed.
    """
    row = _ROW_BYTES + sum(8 * (BANDS if isinstance(f.dataType, ArrayType) else 1) for f in df.schema.fields)
    small = df.count() <= min(BROADCAST_ROWS, BROADCAST_BYTES // row)
    return F.broadcast(df) if small else df.hint("merge")


def largest_hash(n: Column) -> Column:
    """Of a set of ``n`` hashes, the most that the lower bits of a part's least one are taken to be."""
    share = F.least(F.lit(1.0), F.lit(float(_PER_PART * (1 << _PREFIX_BITS))) / n)
    return (share * float((1 << _REST) - 1024)).cast("long")


def signatures(hashed: DataFrame, minima: int) -> DataFrame:
    """``node, n, m0...``: the number of a node's first rows, and the least hash under each permutation.

    ``hashed`` has ``node, _first`` and one hash or more, in the columns whose
    names begin with ``_h``; null hashes only count. Permutation k flips the
    leading bits of a hash so that part k of the range comes first; when a node
    has none there, the next part by the flipped bits decides. With ``_most``,
    a row's hash too large to be the least of its part is left out before the
    sums: on average ``_PER_PART`` of each part stay.
    """
    if minima > 1 << _PREFIX_BITS:
        raise ValueError("more minima than parts of the hash range")
    hashes = [c for c in hashed.columns if c.startswith("_h")]
    if "_most" in hashed.columns:
        hashed = hashed.filter(F.col("_first") | (F.col("_h").bitwiseAND(F.lit((1 << _REST) - 1)) <= F.col("_most")))

    def least(k: int) -> Column:
        flip = k << _REST
        flipped = [F.col(c).bitwiseXOR(F.lit(flip - (1 << 64) if flip >> 63 else flip)) for c in hashes]
        return F.min(flipped[0] if len(flipped) == 1 else F.least(*flipped)).alias(f"m{k}")

    return hashed.groupBy("node").agg(F.count_if("_first").alias("n"), *map(least, range(minima)))


def band_members(signed: DataFrame, bands: int, rows: int) -> DataFrame:
    """``_key, node, n, _size``: the nodes of every band that has several, and how many it has.

    Counted before the shuffle, so a band that a third of all nodes share
    arrives as a few rows; its members are then found by a join that Spark can
    split.
    """
    keys = [F.xxhash64(F.lit(b), *(F.col(f"m{b * rows + i}") for i in range(rows))) for b in range(bands)]
    # One row for each node; the keys are dealt out when they are read.
    keyed = materialise(signed.select("node", "n", F.array(*keys).alias("_keys")), "bands")
    spread = keyed.select("node", "n", F.explode("_keys").alias("_key"))
    shared = spread.groupBy("_key").agg(F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    shared = materialise(shared, "shared")
    members = materialise(spread.join(bounded(shared), "_key").select("_key", "node", "n", "_size"), "members")
    # The keys of all nodes are many times the members'.
    discard(keyed)
    discard(shared)
    return members


class Rule(NamedTuple):
    """What rules pairs out: ``facts`` makes a table ``node, ...`` for some nodes, ``fit`` takes its columns with two prefixes.

    ``fit`` must hold for every pair that is a link.
    """

    facts: Callable[[DataFrame], DataFrame]
    fit: Callable[[str, str], Column]


def linked(members: DataFrame, verified: Callable[..., DataFrame], narrow: Rule, wide: Rule) -> DataFrame:
    """``node, root`` of every node that ``verified``, which keeps the true ones of pairs ``a, b``, links to another.

    All pairs of a band of up to ``SMALL`` nodes that ``narrow`` allows are
    checked at once. Each node of a larger band is checked against its most
    frequent one. Where that leaves a band in several components, the nodes
    outside its largest one are checked against a few members of that, other
    ones in each round, as long as this connects many. What is still apart is
    checked against all nodes of other components, so no verified link between
    two components of a band is missed, yet a large group of near copies is not
    compared pair by pair. The join of that last check keeps only pairs that
    ``wide`` allows. So what is handed on grows with the links; the comparisons
    inside the joins are as many as such pairs, spread over tasks and held by none.

    With its first and last pairs, which fit, ``verified`` gets the nodes of these and of
    large bands; pairs between are of the latter and may not fit.
    """
    large = _large(members)
    pairs = _compared(_first_pairs(members, large, narrow), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    links = verified(pairs, nodes.union(large.select("node")).distinct())
    roots = materialise(components(links), "roots")
    discard(links)
    if not large.head(1):
        return roots
    before = None
    for number in range(ROUNDS + 1):
        parted = _parted(large, roots, number)
        size = parted.agg(F.sum("_all"), F.sum("_apart"), F.sum(F.col("_apart") * F.col("_all"))).first()
        if not size[0]:
            discard(parted)
            return roots
        opened = _opened(large, roots, parted)
        discard(parted)
        # Few pairs are compared at once; so are many, where the last round has not helped.
        if number == ROUNDS or size[2] <= _FEW * size[0] or (before and size[1] > _HELPED * before):
            break
        before = size[1]
        tried = opened.filter("_label <> _main").select(F.col("node").alias("a"), F.explode("_pivots").alias("b"))
        more = verified(tried)
        old, known = roots, roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = materialise(components(known.union(more)), "roots")
        for past in (old, more, opened):
            discard(past)
    last = _compared(_across(opened, wide).distinct(), "across")
    more = verified(last, opened.select("node").distinct())
    discard(last)
    if not more.head(1):
        return roots
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))


def _compared(pairs: DataFrame, name: str) -> DataFrame:
    """``pairs``, written; a join whose rule makes a method that the JVM would never compile is split into smaller ones."""
    with runtime_conf(pairs.sparkSession, "spark.sql.codegen.hugeMethodLimit", "8000"):
        return materialise(pairs, name)


def _large(members: DataFrame) -> DataFrame:
    """``_key, node, rep`` of the bands of more than ``SMALL`` nodes, with the most frequent of them.

    That is likely the one the others are copies of. Counted before the shuffle.
    """
    many = members.filter(F.col("_size") > SMALL)
    # Frequent first, then by hash: one number, so that the sums stay in fixed-width rows.
    rank = F.shiftleft(-F.least(F.col("n"), F.lit(_RANKED)), 40) + F.col("node").bitwiseAND(F.lit((1 << 40) - 1))
    first = materialise(many.groupBy("_key").agg(F.min_by("node", rank).alias("rep")), "reps")
    return materialise(many.join(bounded(first), "_key").select("_key", "node", "rep"), "large")


def _told(pairs: DataFrame, facts: DataFrame, side: str, prefix: str) -> DataFrame:
    """Rows with a node ``side``, with its facts under a prefix."""
    names = [F.col(c).alias(prefix + c) for c in facts.columns if c != "node"]
    return pairs.join(facts.select(F.col("node").alias(side), *names), side)


def _first_pairs(members: DataFrame, large: DataFrame, rule: Rule) -> DataFrame:
    """``a, b``: the pairs of small bands, and of the nodes of large ones with their most frequent one, that fit."""
    facts = rule.facts(members.select("node").distinct())
    small = members.filter(F.col("_size") <= SMALL).select("_key", "node").join(facts, "node")
    one, two = small.alias("x"), small.alias("y")
    met = (F.col("x._key") == F.col("y._key")) & (F.col("x.node") < F.col("y.node")) & rule.fit("x.", "y.")
    within = one.join(two, met).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    stars = large.filter("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()
    stars = _told(_told(stars, facts, "a", "x"), facts, "b", "y").filter(rule.fit("x", "y")).select("a", "b")
    return within.union(stars).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _labels(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").select("_key", "node", "rep", F.coalesce("root", "node").alias("_label"))


def _parted(members: DataFrame, roots: DataFrame, number: int) -> DataFrame:
    """``_key, _main, _pivots, _all, _apart`` of each band in several components.

    The main one has the most nodes; ``_pivots`` are some of them, by the number
    of the round. Counted before the shuffles, first by component.
    """
    seeds = [F.lit(number * PIVOTS + i) for i in range(PIVOTS)]
    some = [F.min_by("node", F.xxhash64(seed, "node")).alias(f"_p{i}") for i, seed in enumerate(seeds)]
    per_label = _labels(members, roots).groupBy("_key", "_label").agg(F.count(F.lit(1)).alias("_n"), *some)
    main = F.max(F.struct("_n", "_label", *(f"_p{i}" for i in range(PIVOTS)))).alias("_most")
    per_key = per_label.groupBy("_key").agg(main, F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_labels"))
    pivots = F.array_distinct(F.array(*(f"_most._p{i}" for i in range(PIVOTS)))).alias("_pivots")
    apart = (F.col("_all") - F.col("_most._n")).alias("_apart")
    several = per_key.filter("_labels > 1").select("_key", F.col("_most._label").alias("_main"), pivots, "_all", apart)
    return materialise(several, "parted")


def _opened(members: DataFrame, roots: DataFrame, parted: DataFrame) -> DataFrame:
    """``_key, node, rep, _label, _main, _pivots``: the nodes of the bands in several components."""
    of_band = parted.select("_key", "_main", "_pivots")
    return materialise(_labels(members, roots).join(bounded(of_band), "_key"), "opened")


def _across(opened: DataFrame, rule: Rule) -> DataFrame:
    """``a, b``: each node outside the main component of its band with the nodes of other components there.

    A pair meets in the first of the bands that both are in; if one of them is
    the frequent node there, the two were compared already.
    """
    apart = opened.filter("_label <> _main").select("_key", F.col("node").alias("a"), F.col("_label").alias("_la"))
    # The frequent node was compared already; two nodes outside the main component meet once.
    others = opened.filter("node <> rep").select("_key", F.col("node").alias("b"), F.col("_label").alias("_lb"), "_main")
    wanted = (F.col("_la") != F.col("_lb")) & ((F.col("_lb") == F.col("_main")) | (F.col("a") < F.col("b")))
    keys = materialise(opened.groupBy("node").agg(F.collect_set("_key").alias("_keys")), "asked")
    facts = bounded(materialise(rule.facts(keys.select("node")).join(keys, "node"), "facts"))
    first = F.col("one._key") == F.array_min(F.array_intersect("x_keys", "y_keys"))
    one, two = _told(apart, facts, "a", "x").alias("one"), _told(others, facts, "b", "y").alias("two")
    return one.join(two, (F.col("one._key") == F.col("two._key")) & wanted & rule.fit("x", "y") & first).select("a", "b")
