"""Fuzzy line dedup: MinHash of character shingles, banding, exact check, connected components."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocell.llm.bands import BANDS, ROWS, Rule, band_members, bounded, linked, signatures
from aerocell.llm.maps import allows, bit_maps
from aerocell.session import discard, materialise

SHINGLE = 7
SIMILARITY = 0.8

# Words of 64 bits of the map that rules out pairs; a power of two. 270 characters
# set a quarter of its bits, so it tells pairs below a similarity of some 0.73 apart.
WORDS = 16
# Lines of so many shingles fill most of their map and have their distinct ones counted.
COUNTED_FROM = 1200
# Shingles that one row of the loop over a line takes, to be combined before the sums.
CHUNK = 4

_WIDTH = 4  # bytes of a character in UTF-32


def _line_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, _text, _no, _line, node``: every line that is not blank; a node is a line's hash."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("_text"), F.posexplode(F.split("text", "\n")).alias("_no", "_line"))
    return lines.filter(F.trim("_line", F.lit(" \t\r\x0b\f")) != "").select("*", F.xxhash64("_line").alias("node"))


def _encoded(line: Column) -> Column:
    """Every character in four bytes, so that a shingle is cut without a search."""
    return F.encode(line, "UTF-32")


def _n_shingles(encoded: Column, size: int) -> Column:
    return F.greatest(F.octet_length(encoded) / _WIDTH - (size - 1), F.lit(1)).cast("int")


def _shingle(encoded: Column, place: Column, size: int) -> Column:
    """Hash of the shingle at ``place``, from 0; a shorter line is its own shingle."""
    return F.xxhash64(F.substring(encoded, place * _WIDTH + 1, F.lit(size * _WIDTH)))


def _chunks(texts: DataFrame, keep: list[str], number: str, size: int) -> DataFrame:
    """``keep..., _at, _h0...``: the hashes of ``CHUNK`` shingles from each ``CHUNK``-th place of ``_bytes`` on.

    The last shingle of a line is repeated until its chunk is full, which
    changes no least hash and no map.
    """
    each = texts.select(*keep, number, "_bytes", F.explode(F.sequence(F.lit(0), F.col(number) - 1, F.lit(CHUNK))).alias("_at"))
    places = [F.least(F.col("_at") + i, F.col(number) - 1) for i in range(CHUNK)]
    hashes = [_shingle(F.col("_bytes"), place, size).alias(f"_h{i}") for i, place in enumerate(places)]
    return each.select(*keep, "_at", *hashes)


def _signatures(lines: DataFrame, size: int, minima: int) -> DataFrame:
    """``node, n, m0...``: the number of such lines, and the least hash under each permutation."""
    encoded = lines.select("node", _encoded(F.col("_line")).alias("_bytes"))
    counted = encoded.select("*", _n_shingles(F.col("_bytes"), size).alias("_n"))
    return signatures(_chunks(counted, ["node"], "_n", size).withColumn("_first", F.col("_at") == 0), minima)


def _mapped(texts: DataFrame, size: int, words: int = WORDS) -> DataFrame:
    """``node, _n, _exact, _s0..., _bits``: the number of shingles, and a map of ``words`` of 64 bits in which each sets one.

    Of a line that would fill its map the distinct shingles are counted, of a
    shorter one all, as its map tells how many are distinct at least.
    """
    shingles = _n_shingles(F.col("_bytes"), size)
    counted = texts.select("node", "_bytes", shingles.alias("_all"), (shingles >= COUNTED_FROM).alias("_exact"))
    number = F.when(F.col("_exact"), F.size(_hashes("_bytes", size))).otherwise(F.col("_all")).alias("_n")
    counted = counted.select("node", "_bytes", "_all", "_exact", number)
    keys = ["node", "_n", "_exact"]
    return bit_maps(_chunks(counted, keys, "_all", size), keys, words)


def _sized(maps: DataFrame) -> DataFrame:
    """``node, _n, _least, _s0...``: the maps with the most and the least number of distinct shingles.

    A line has at most ``_n`` distinct shingles, and at least that many or as
    many as its map has bits.
    """
    names = [c for c in maps.columns if c.startswith("_s")]
    return maps.select("node", "_n", F.when(F.col("_exact"), F.col("_n")).otherwise(F.col("_bits")).alias("_least"), *names)


def _promising(pairs: DataFrame, maps: DataFrame, similarity: float) -> DataFrame:
    """The distinct pairs whose sizes and maps allow the similarity; a similar pair is never left out."""
    sized = _sized(maps)
    columns = [c for c in sized.columns if c != "node"]
    one = sized.select(F.col("node").alias("a"), *(F.col(c).alias("x" + c) for c in columns))
    two = sized.select(F.col("node").alias("b"), *(F.col(c).alias("y" + c) for c in columns))
    met = pairs.select("a", "b").distinct().join(one, "a").join(two, "b")
    return met.filter(allows(similarity, WORDS, "x", "y")).select("a", "b")


def _scored(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """``a, b, score``: the exact Jaccard similarity of each pair's shingles.

    ``texts`` stores the lines encoded: an encoding made here could be moved
    into the loop over the shingles and repeated for each of them.
    """
    one = texts.select(F.col("node").alias("a"), F.col("_bytes").alias("_one"))
    two = texts.select(F.col("node").alias("b"), F.col("_bytes").alias("_two"))
    met = pairs.join(one, "a").join(two, "b")
    sets = met.select("a", "b", _hashes("_one", size).alias("_x"), _hashes("_two", size).alias("_y"))
    sized = sets.select(
        "a", "b", F.size(F.array_intersect("_x", "_y")).alias("_both"), (F.size("_x") + F.size("_y")).alias("_n")
    )
    return sized.select("a", "b", (F.col("_both") / (F.col("_n") - F.col("_both"))).alias("score"))


def _hashes(line: str, size: int) -> Column:
    """The distinct shingles of a line.

    The line is handed to the inner loop as a variable of an outer one: read
    from the row, it would be copied whole for every shingle.
    """

    def distinct(whole: Column) -> Column:
        places = F.sequence(F.lit(0), _n_shingles(whole, size) - 1)
        return F.array_distinct(F.transform(places, lambda i: _shingle(whole, i, size)))

    return F.get(F.transform(F.array(F.col(line)), distinct), F.lit(0))


def _texts(lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, _bytes``: the lines of some nodes, encoded, once for each place."""
    return lines.join(bounded(nodes), "node").select("node", _encoded(F.col("_line")).alias("_bytes"))


def similar_lines(
    docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``node, root`` of every distinct line that is similar to another one; lines of one root are connected.

    The lines of a band are linked as ``linked`` says. Sizes and maps of the
    shingles rule out most pairs that are far from similar, and none that is
    similar, before their shingles are compared.
    """
    lines = _line_rows(docs)
    members = band_members(_signatures(lines, size, bands * rows), bands, rows)
    asked = materialise(members.select("node").distinct(), "asked")
    maps = materialise(_mapped(_texts(lines, asked), size), "maps")
    discard(asked)
    stored = []

    def texts_of(nodes: DataFrame) -> DataFrame:
        # All that are asked for at first, those of large bands among them, are all that are ever asked for.
        if not stored:
            wanted = materialise(nodes, "wanted")
            stored.append(materialise(_texts(lines, wanted).distinct(), "texts"))
            discard(wanted)
        return stored[0]

    def verified(pairs: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
        promising = pairs
        if nodes is None:
            promising = materialise(_promising(pairs, maps, similarity), "promising")
        scored = _scored(promising, texts_of(nodes), size)
        links = materialise(scored.filter(F.col("score") >= similarity).select("a", "b"), "links")
        discard(promising)
        return links

    rule = Rule(lambda nodes: _sized(maps), partial(allows, similarity, WORDS))
    return linked(members, verified, rule, rule)


def duplicate_lines(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, _text, n_lines, dropped``: the numbers (from 0) of the lines a document loses.

    Of all lines that are equal or connected by similarity, the first stays: by
    ``doc_id`` (null last), then by number. Lines end at a line feed; blank
    lines are never duplicates. A null text has no lines, an empty one a blank
    line. Rows that repeat an id and a text are one document, whose hash is
    ``_text``; other columns are ignored. Two different lines count as equal if
    their 64-bit hashes are.
    """
    rooted = similar_lines(docs, **options)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_text", "_no").alias("_place")
    rows = materialise(_line_rows(docs).select("doc_id", "_text", "_no", "node"), "rows")
    placed = rows.select("node", place)
    firsts = materialise(placed.groupBy("node").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")), "firsts")
    labelled = rooted.join(firsts, "node").select("node", "root", "_first")
    kept = labelled.groupBy("root").agg(F.min("_first").alias("_kept"))
    linked = labelled.join(kept, "root").select("node", "_kept")
    equal = firsts.filter("_n > 1").join(linked.select("node"), "node", "left_anti").select("node", F.col("_first").alias("_kept"))
    keepers = materialise(linked.union(equal), "keepers")
    lost = placed.join(bounded(keepers), "node").filter(~F.col("_place").eqNullSafe(F.col("_kept")))
    per_text = lost.groupBy(F.col("_place.doc_id").alias("doc_id"), F.col("_place._text").alias("_text")).agg(
        F.array_sort(F.collect_set("_place._no")).alias("dropped")
    )
    counted = docs.select(
        "doc_id", F.xxhash64("text").alias("_text"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"),
        F.col("text").isNull().alias("_none"),
    ).distinct()
    counted = counted.select("doc_id", "_text", F.when(F.col("_none"), 0).otherwise(F.col("n_lines")).alias("n_lines"))
    same = F.col("c.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("c._text") == F.col("p._text"))
    none = F.array().cast("array<int>")
    return counted.alias("c").join(per_text.alias("p"), same, "left").select(
        "c.doc_id", "c._text", "n_lines", F.coalesce("dropped", none).alias("dropped")
    )


def without_duplicate_lines(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with the duplicate lines taken out of ``text``, all other columns as they were.

    A document whose lines all stand elsewhere stays, with an empty text.
    """
    lost = duplicate_lines(docs, **options).filter(F.size("dropped") > 0)
    lost = lost.select(F.col("doc_id").alias("_lost_id"), F.col("_text").alias("_lost_text"), F.col("dropped").alias("_dropped"))
    same = F.col("doc_id").eqNullSafe(F.col("_lost_id")) & (F.xxhash64("text") == F.col("_lost_text"))
    joined = docs.join(lost, same, "left").withColumn("_lines", F.split("text", "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    kept = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    text = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(kept).alias("text")
    return joined.select(*(text if c == "text" else F.col(c) for c in docs.columns))
