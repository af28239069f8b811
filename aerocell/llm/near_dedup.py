"""Near duplicates by SimHash, found through deletion variants of fingerprint segments.

With ``s`` segments, two fingerprints that differ in at most ``2 s - 1`` bits
have a segment in which they differ in at most one. So each segment is indexed
as it is and once with every bit left out, and an equality join finds all pairs
within that radius; the full distance is checked inside the join.

Where a similarity is asked, fingerprints and bands of minima of the shingles
that it is measured on both give candidates, and their exact similarity decides.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocell.llm.bands import BANDS, ROWS, Rule, band_members, bounded, largest_hash, linked, signatures
from aerocell.llm.components import components
from aerocell.llm.maps import allows, bit_maps
from aerocell.llm.votes import as_hex, ascii_lower, fingerprints, hamming, place_of_terms, words_of
from aerocell.session import materialise

# Segments of a word of 64 bits; a segment has at most half of them.
PARTS = 2
_WORD = 64
# In a key, the bits of a segment lie below its number and the place left out.
_BELOW = 32
# The place that stands for "no bit left out".
_WHOLE = 32
# Fingerprints beside the bands of minima: words of their shingles, and the radius.
PRINT_WORDS = 3
PRINT_RADIUS = 3
# Words of 64 bits of the map that rules out pairs of texts; a power of two.
MAP_WORDS = 32


def _segments(words: list[str], parts: int) -> list[tuple[Column, int]]:
    """``(bits, width)`` of every segment."""
    edges = [_WORD * i // parts for i in range(parts + 1)]
    return [
        (F.shiftrightunsigned(F.col(word), first).bitwiseAND(F.lit((1 << (end - first)) - 1)), end - first)
        for word in words
        for first, end in zip(edges, edges[1:])
    ]


def _variants(prints: DataFrame, words: list[str], parts: int, bit: int, told: list[str]) -> DataFrame:
    """One side of the index: each segment as it is, and without each bit that is ``bit``.

    Two segments that differ in exactly one bit meet once, under that bit, with
    1 on one side and 0 on the other; equal segments meet once as they are.
    """
    rows = []
    for number, (segment, width) in enumerate(_segments(words, parts)):
        for p in range(width):
            rest = segment.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << p)))
            rows.append(F.when(F.shiftrightunsigned(segment, p).bitwiseAND(F.lit(1)) == bit, _key(number, p, rest)))
        rows.append(_key(number, _WHOLE, segment))
    spread = prints.select(*words, *told, F.explode(F.array(*rows)).alias("_key"))
    return spread.filter(F.col("_key").isNotNull())


def _key(number: int, place: int, rest: Column) -> Column:
    """Segment number, place of the bit left out and the other bits in one number."""
    return rest.bitwiseOR(F.lit((number * (_WHOLE + 1) + place) << _BELOW))


def _node(words: list[str], side: str) -> Column:
    """A fingerprint as one value: its number, or its digits when it has several words."""
    own = [F.col(f"{side}.{w}") for w in words]
    return own[0] if len(own) == 1 else F.concat(*map(as_hex, own))


def near_links(
    prints: DataFrame, words: list[str], radius: int, parts: int = PARTS, apart: str | None = None
) -> DataFrame:
    """``a, b``: pairs of distinct fingerprints at most ``radius`` bits apart, as nodes, with repeats.

    ``prints`` holds distinct fingerprints in the columns ``words`` of 64 bits,
    each cut into ``parts``. All pairs are found up to ``guaranteed(words, parts)``.
    With ``apart`` only pairs that differ in that column are, each with its two
    values (``a_`` and ``b_`` and the name without leading lines); a fingerprint may then have several.
    The sides are merged: Spark sizes a side as if nothing were listed many times, and would broadcast it.
    """
    told = [apart] if apart else []
    a, b = _variants(prints, words, parts, 0, told).alias("a"), _variants(prints, words, parts, 1, told).alias("b")
    distance = reduce(lambda x, y: x + y, (hamming(F.col(f"a.{w}"), F.col(f"b.{w}")) for w in words))
    # Equal segments list a pair in both orders; one of them is enough.
    place = F.shiftrightunsigned(F.col("a._key"), _BELOW) % (_WHOLE + 1)
    once = (place != _WHOLE) | (F.struct(*(F.col(f"a.{w}") for w in words)) < F.struct(*(F.col(f"b.{w}") for w in words)))
    wanted = (distance <= radius) & once
    if apart:
        wanted = wanted & (F.col(f"a.{apart}") != F.col(f"b.{apart}"))
    met = a.join(b.hint("merge"), (F.col("a._key") == F.col("b._key")) & wanted)
    values = [F.col(f"{side}.{c}").alias(f"{side}_{c.lstrip('_')}") for side in "ab" for c in told]
    return met.select(_node(words, "a").alias("a"), _node(words, "b").alias("b"), *values)


def guaranteed(words: int, parts: int) -> int:
    """The radius within which every pair has a segment that differs in at most one bit."""
    return 2 * words * parts - 1


def _sequences(docs: DataFrame) -> DataFrame:
    """``doc_id, node, _words``: the words of every text; a node is the hash of their sequence."""
    split = docs.select("doc_id", words_of(ascii_lower(F.col("text"))).alias("_words"))
    return split.select("doc_id", _sequence(F.col("_words")).alias("node"), "_words")


def _sequence(words: Column) -> Column:
    """Hash of the words in their order."""
    return F.xxhash64(F.concat_ws(" ", words))


def _shingle(words: str, place: Column, size: int) -> Column:
    """Hash of the shingle at ``place``, from 1; fewer words are one shingle."""
    return F.xxhash64(F.concat_ws(" ", *(F.get(words, place + (i - 1)) for i in range(size))))


def _word_signatures(texts: DataFrame, size: int, minima: int) -> DataFrame:
    """``node, n, m0...`` of the texts with words: see ``signatures``."""
    placed = texts.select("node", "_words", place_of_terms(F.col("_words"), size).alias("_at")).filter("_at IS NOT NULL")
    most = largest_hash(F.greatest(F.size("_words") - (size - 1), F.lit(1)))
    hashed = placed.select(
        "node", (F.col("_at") == 1).alias("_first"), most.alias("_most"), _shingle("_words", F.col("_at"), size).alias("_h")
    )
    return signatures(hashed, minima)


def _alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose ``sets`` (``node, _n, _set``) have that Jaccard similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("_n").alias("_na"), F.col("_set").alias("_one"))
    two = sets.select(F.col("node").alias("b"), F.col("_n").alias("_nb"), F.col("_set").alias("_two"))
    both = F.size(F.array_intersect("_one", "_two")).alias("_both")
    met = pairs.join(one, "a").join(two, "b").select("a", "b", "_na", "_nb", both)
    return met.filter(F.col("_both") >= similarity * (F.col("_na") + F.col("_nb") - F.col("_both"))).select("a", "b")


def _of_like_size(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The distinct pairs of sets whose sizes allow that similarity, so that others are not moved."""
    sizes = sets.select("node", "_n")
    sized = (
        pairs.select("a", "b").distinct()
        .join(sizes.select(F.col("node").alias("a"), F.col("_n").alias("_na")), "a")
        .join(sizes.select(F.col("node").alias("b"), F.col("_n").alias("_nb")), "b")
    )
    fit = sized.filter(F.least("_na", "_nb") >= similarity * F.greatest("_na", "_nb"))
    return materialise(fit.select("a", "b"), "pairs")


def _maps(sets: DataFrame) -> DataFrame:
    """``node, _n, _least, _s0...``: the number of shingles, as the most and the least, and their map."""
    mapped = bit_maps(sets.select("node", "_n", F.explode("_set").alias("_h")), ["node", "_n"], MAP_WORDS)
    return mapped.drop("_bits").withColumn("_least", F.col("_n"))


def _sets(texts: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node, _n, _set``: the distinct shingles of some nodes."""
    wanted = materialise(nodes.select("node").distinct(), "wanted")
    found = texts.join(bounded(wanted), "node").select("node", "_words").distinct()
    places = F.sequence(F.lit(1), F.greatest(F.size("_words") - (size - 1), F.lit(1)))
    terms = F.array_distinct(F.transform(places, lambda i: _shingle("_words", i, size)))
    return materialise(found.select("node", terms.alias("_set")), "sets").select("node", F.size("_set").alias("_n"), "_set")


def _as_links(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _similar_texts(docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """``node, root`` of every word sequence that is similar to another one; those of one root are connected.

    Candidates come from bands of minima, and from fingerprints that are equal or
    that the deletion variants find near; of the latter only those that the
    former have not connected.
    """
    texts = _sequences(docs)
    members = band_members(_word_signatures(texts, size, BANDS * ROWS), BANDS, ROWS)
    prints = materialise(_node_prints(docs), "prints")
    alike = prints.groupBy("f0").agg(F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    one = F.lit(1).cast("long").alias("n")
    members = members.unionByName(prints.join(alike, "f0").select(F.col("f0").alias("_key"), "node", one, "_size"))
    sets = _sets(texts, members, size)
    maps = materialise(_maps(sets), "maps")

    def verified(pairs: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
        fit = pairs if nodes is not None else _of_like_size(pairs, sets, similarity)
        return materialise(_alike(fit, sets, similarity), "links")

    rule = Rule(lambda nodes: maps, partial(allows, similarity, MAP_WORDS))
    roots = materialise(linked(members, verified, rule, rule), "roots")
    labelled = prints.join(roots, "node", "left").select("node", "f0", F.coalesce("root", "node").alias("_root"))
    pairs = materialise(_near_pairs(materialise(labelled, "labelled")), "near")
    if not pairs.head(1):
        return roots
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    sets = _sets(texts, ends, size)
    more = materialise(_alike(_of_like_size(pairs, sets, similarity), sets, similarity), "links")
    return components(_as_links(roots).union(more)) if more.head(1) else roots


def _node_prints(docs: DataFrame) -> DataFrame:
    """``node, f0``: the fingerprint of every word sequence that has words, as ``op5_simhash_near_dedup`` takes it."""
    words = words_of(ascii_lower(F.col("text")))
    spoken = docs.select(_sequence(words).alias("node"), "text", F.get(words, F.lit(0)).alias("_first"))
    return fingerprints(spoken.filter("_first <> ''"), ["node"], F.col("text"), PRINT_WORDS).select("node", "f0")


def _near_pairs(labelled: DataFrame) -> DataFrame:
    """``a, b``: nodes of different roots whose fingerprints are at most ``PRINT_RADIUS`` bits apart.

    ``labelled`` has ``node, f0, _root``. Fingerprints meet once for each root,
    so what is connected already is neither listed nor handed on.
    """
    near = near_links(labelled.select("f0", "_root").distinct(), ["f0"], PRINT_RADIUS, apart="_root").distinct()
    one = labelled.select(F.col("node").alias("x"), F.col("f0").alias("a"), F.col("_root").alias("a_root"))
    two = labelled.select(F.col("node").alias("y"), F.col("f0").alias("b"), F.col("_root").alias("b_root"))
    met = near.join(one, ["a", "a_root"]).join(two, ["b", "b_root"])
    return met.select(F.col("x").alias("a"), F.col("y").alias("b"))


def similar_documents(docs: DataFrame, similarity: float = 0.8, size: int = 5) -> DataFrame:
    """``doc_id, node, component_id`` of every row of ``docs``, by the exact Jaccard similarity of shingles.

    Texts are linked whose shingles of ``size`` words have that similarity;
    ``component_id`` is the smallest ``doc_id`` that links reach. Candidates
    have SimHash fingerprints within a radius, found by deletion variants, or
    share a band of minima of these shingles, whatever kind of edit parts them:
    at 0.8 a pair does with a probability of 0.9992. Texts with the same words
    in the same order are one ``node``; all texts without words are.
    """
    rows = materialise(_sequences(docs).select("doc_id", "node"), "nodes")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("_least"))
    return rows.join(_least_ids(_similar_texts(docs, size, similarity), nodes), "node")


def _least_ids(rooted: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, component_id`` of all ``nodes`` (``node, _least``): the least id under a node's root."""
    rooted = rooted.join(nodes, "node")
    least = rooted.groupBy("root").agg(F.min("_least").alias("component_id"))
    of_linked = rooted.join(least, "root").select("node", "component_id")
    return nodes.join(of_linked, "node", "left").select("node", F.coalesce("component_id", "_least").alias("component_id"))


def near_duplicates(
    docs: DataFrame,
    size: int = 3,
    radius: int = 3,
    words: int = 1,
    parts: int = PARTS,
    distinct_words: bool = False,
    similarity: float = 0.0,
    similarity_words: int = 5,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every whole text, one row per row of ``docs``.

    The fingerprint (hexadecimal) is the unweighted SimHash of the shingles of
    ``size`` words, in ``words`` times 64 bits; documents at most ``radius`` bits
    apart are linked, and ``component_id`` is the smallest ``doc_id`` that links
    reach. With ``similarity``, links are those of ``similar_documents`` with
    shingles of ``similarity_words`` words instead, whatever the fingerprints:
    equal ones of different texts link nothing unseen, and no radius hides a pair.

    Documents with one fingerprint, or with ``similarity`` with the same words in
    the same order, are one node, so exact copies cost nothing. Fewer words than
    a shingle make one shingle; texts without words (null ones, too) have
    fingerprint 0 and are linked like any other. Repeated rows give repeated
    rows. A null ``doc_id`` is a document, but never the smallest id unless its
    component has no other. Other columns are ignored.
    """
    if not similarity and radius > guaranteed(words, parts):
        raise ValueError("this radius needs more segments")
    names = [f"f{i}" for i in range(words)]
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))
    keys = ["doc_id", "_text"]
    if similarity:
        keyed, keys = keyed.withColumn("_sequence", _sequence(words_of(ascii_lower(F.col("text"))))), [*keys, "_sequence"]
    prints = fingerprints(keyed, keys, F.col("text"), size, words, distinct_words)
    prints = materialise(prints, "fingerprints")
    node = F.col("_sequence") if similarity else _node(names, "a")
    if similarity:
        nodes = prints.groupBy(node.alias("node")).agg(F.min("doc_id").alias("_least"))
        rooted = _similar_texts(docs, similarity_words, similarity)
    else:
        groups = prints.groupBy(*names).agg(F.min("doc_id").alias("_least"))
        nodes = groups.alias("a").select(node.alias("node"), "_least")
        rooted = components(near_links(groups.select(*names), names, radius, parts))
    all_nodes = _least_ids(rooted, nodes)
    shown = F.concat(*(as_hex(F.col(n)) for n in names)).alias("fingerprint")
    rows = prints.alias("a").select("doc_id", "n_rows", shown, node.alias("node")).join(all_nodes, "node")
    out = rows.select("doc_id", "fingerprint", "component_id", "n_rows")
    # Repeated rows were counted, not kept; few texts have any.
    many = out.filter("n_rows > 1").select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n_rows")))
    columns = ["doc_id", "fingerprint", "component_id"]
    return out.filter("n_rows = 1").select(*columns).union(many.select(*columns))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stand for their group of near duplicates, all columns as they were.

    Each component keeps the document whose id is the component's; of repeated
    rows with that id all stay, as an id is taken to name one document. With a
    ``similarity`` groups are those of ``similar_documents``, without fingerprints.
    """
    if options.get("similarity"):
        found = similar_documents(docs, options["similarity"], options.get("similarity_words", 5))
    else:
        found = near_duplicates(docs, **options)
    found = found.select("doc_id", "component_id").distinct()
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept"))
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")
