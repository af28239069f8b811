"""Document fingerprints: weighted SimHash, and Hamming search in permuted block tables."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerocell.llm.votes import ascii_lower, hamming, majority, place_of_terms, vote_sums, words_of
from aerocell.session import materialise

BITS = 64
TERM_WORDS = 3
RADIUS = 3
BLOCKS = 6


def weighted_fingerprints(texts: DataFrame, keys: list[str], text: str = "text", size: int = TERM_WORDS) -> DataFrame:
    """``keys..., n_rows, fingerprint``: SimHash by the shingles of ``size`` words.

    Each occurrence of a term votes with the term's length in bytes on the 64
    bits of its XXH64; a bit is 1 if more than half of the weight has it. Texts
    without words have fingerprint 0. ``keys`` must fix the text; votes are
    summed before the shuffle.
    """
    split = texts.select(*keys, words_of(ascii_lower(F.col(text))).alias("_words"))
    placed = split.select(*keys, "_words", place_of_terms(F.col("_words"), size).alias("_at"))
    term = F.concat_ws(" ", *(F.get("_words", F.col("_at") + (i - 1)) for i in range(size)))
    known = placed.select(*keys, "_at", F.when(F.col("_at").isNotNull(), term).alias("_term"))
    first = F.coalesce(F.col("_at"), F.lit(1)) == 1
    term_hash = F.when(F.col("_term").isNotNull(), F.xxhash64("_term"))
    hashed = known.select(*keys, first.alias("_first"), term_hash.alias("_h"), F.octet_length("_term").cast("long").alias("_weight"))
    sums = hashed.groupBy(*keys).agg(F.count_if("_first").alias("n_rows"), *vote_sums([F.col("_h")], F.col("_weight")))
    return sums.select(*keys, "n_rows", majority().alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the bits in which two fingerprints agree."""
    return 1 - hamming(a, b) / F.lit(float(BITS))


def _block_edges(blocks: int) -> list[tuple[int, int]]:
    """``(first bit, width)`` of nearly equal blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def block_tables(prints: DataFrame, fingerprint: str, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Every row once per table: ``_table`` and ``_key``, the fingerprint with the table's blocks in front.

    Two fingerprints at most ``radius`` bits apart agree in at least ``blocks -
    radius`` blocks, so in all blocks of some choice of that many; each choice
    is a table, keyed by its blocks moved together.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("there must be more blocks than the radius")
    edges = _block_edges(blocks)
    rows = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key, at = F.lit(0).cast("long"), 0
        for block in chosen:
            first, width = edges[block]
            part = F.shiftrightunsigned(F.col(fingerprint), first).bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1))
            key = key.bitwiseOR(F.shiftleft(part, at))
            at += width
        rows.append(F.struct(F.lit(number).alias("table"), key.alias("key")))
    spread = prints.withColumn("_entry", F.explode(F.array(*rows)))
    return spread.select("*", F.col("_entry.table").alias("_table"), F.col("_entry.key").alias("_key")).drop("_entry")


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``query, found``: all pairs of a fingerprint of ``queries`` and one of ``prints`` within the radius.

    Both have a column ``fingerprint``; repeated ones count once and null ones
    not at all, so copies cost nothing here: join them back by fingerprint.
    """
    a = block_tables(queries.select("fingerprint").dropna().distinct(), "fingerprint", radius, blocks).alias("a")
    b = block_tables(prints.select("fingerprint").dropna().distinct(), "fingerprint", radius, blocks).alias("b")
    near = hamming(F.col("a.fingerprint"), F.col("b.fingerprint")) <= radius
    met = a.join(b, (F.col("a._table") == F.col("b._table")) & (F.col("a._key") == F.col("b._key")) & near)
    return met.select(F.col("a.fingerprint").alias("query"), F.col("b.fingerprint").alias("found")).distinct()


def next_ids(ids: DataFrame) -> DataFrame:
    """``doc_id, next_id``: the largest smaller id, and the largest of all after the smallest.

    Ids are dealt out by range, each range is ordered by itself, and only one
    row per range goes through a common window.
    """
    distinct = ids.select("doc_id").dropna().distinct()
    ranged = distinct.repartitionByRange("doc_id").select("doc_id", F.spark_partition_id().alias("_range"))
    ranged = materialise(ranged, "ranges")
    tops = ranged.groupBy("_range").agg(F.max("doc_id").alias("_top"))
    down = Window.orderBy(F.desc("_range"))
    below = tops.select("_range", F.lead("_top").over(down).alias("_below"), F.max("_top").over(Window.orderBy(F.lit(1))).alias("_all"))
    inside = Window.partitionBy("_range").orderBy(F.desc("doc_id"))
    own = ranged.select("doc_id", "_range", F.lead("doc_id").over(inside).alias("_next"))
    joined = own.join(below, "_range")
    return joined.select("doc_id", F.coalesce("_next", "_below", "_all").alias("next_id"))


def edited_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_chars, edited, _text``: each text with its second half taken from the next document.

    The last ``floor(n_chars / 2)`` code points are replaced by the first as many
    (or all) of the document with the next smaller id, after the smallest by
    those of the largest. Null texts are empty. Where rows share an id, the row
    whose text has the least hash lends its beginning; a null id has no next
    document and keeps its first half alone. ``_text`` is a hash of the text.
    """
    whole = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", whole.alias("text"), F.xxhash64(whole).alias("_text"), F.char_length(whole).alias("_n"))
    half = F.floor(F.col("_n") / 2).cast("int")
    facts = rows.groupBy("doc_id").agg(
        F.min("_text").alias("_lends"), F.count(F.lit(1)).alias("_rows"), F.max(half).alias("_take")
    )
    facts = materialise(facts, "facts")
    after = materialise(next_ids(facts), "next")
    # For each id: which document it lends its beginning to, and how much.
    lends = (
        after.join(facts.select("doc_id", "_take"), "doc_id")
        .select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("_to"), "_take")
        .join(facts.select("doc_id", "_lends", "_rows"), "doc_id")
    )
    # Both joins take the same rows with the same columns, so that Spark deals out the texts once.
    named = rows.filter(F.col("doc_id").isNotNull())
    # Written as a difference, the second condition does not become a second key of the join.
    lent = named.join(lends, "doc_id").filter(F.col("_text").bitwiseXOR(F.col("_lends")) == 0)
    lent = lent.select(F.col("_to").alias("doc_id"), F.left("text", F.least("_take", "_n")).alias("_head"), "_rows")
    # Rows repeated under one id lend the same text; one of them is enough.
    heads = lent.filter("_rows = 1").select("doc_id", "_head").union(
        lent.filter("_rows > 1").groupBy("doc_id").agg(F.first("_head").alias("_head"))
    )
    joined = named.join(heads, "doc_id", "left")
    nameless = rows.filter(F.col("doc_id").isNull()).withColumn("_head", F.lit(None).cast("string"))
    joined = joined.union(nameless)
    kept = F.left("text", F.col("_n") - half)
    edited = F.concat(kept, F.coalesce(F.left("_head", half), F.lit("")))
    return joined.select("doc_id", "text", F.col("_n").cast("long").alias("n_chars"), edited.alias("edited"), "_text")


def document_fingerprints(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, ask_every: int = 20) -> DataFrame:
    """Fingerprints of every whole text and of its edited text.

    Per row of ``docs``: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint`` (numbers), ``next_fingerprint`` and, for the ids that
    ``ask_every`` divides, ``n_near``: how many rows lie within the radius, the
    row itself included. Equal texts have equal fingerprints. See
    ``edited_texts`` for nulls and shared ids; repeated rows give repeated rows.
    """
    rows = edited_texts(docs)
    keys = ["doc_id", "_text", "n_chars", "edited_sha256", "_side"]
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")),
    )
    spread = rows.select("doc_id", "_text", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.explode(sides).alias("_one"))
    spread = spread.select(*keys[:-1], F.col("_one.side").alias("_side"), F.col("_one.text").alias("text"))
    prints = weighted_fingerprints(spread, keys)
    both = prints.groupBy(*keys[:-1]).agg(
        F.max("n_rows").alias("n_rows"),
        F.max(F.when(F.col("_side") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("_side") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    both = materialise(both, "fingerprints")
    own = both.groupBy("doc_id").agg(F.min_by("fingerprint", "_text").alias("_own")).dropna()
    after = next_ids(own).join(own.select(F.col("doc_id").alias("next_id"), F.col("_own").alias("next_fingerprint")), "next_id")
    asked = both.filter(F.col("doc_id") % ask_every == 0)
    number = both.groupBy("fingerprint").agg(F.sum("n_rows").alias("_rows"))
    pairs = within_radius(asked, number, radius, blocks)
    near = (
        pairs.join(number, pairs["found"] == number["fingerprint"])
        .groupBy("query")
        .agg(F.sum("_rows").alias("n_near"))
        .select(F.col("query").alias("_asked"), "n_near")
    )
    joined = both.join(after.select("doc_id", "next_fingerprint"), "doc_id", "left")
    asks = F.when(F.col("doc_id") % ask_every == 0, F.col("fingerprint"))
    joined = joined.withColumn("_ask", asks).join(near, F.col("_ask") == F.col("_asked"), "left")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint", "n_near"]
    many = joined.filter("n_rows > 1").select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n_rows")))
    return reduce(DataFrame.union, [joined.filter("n_rows = 1").select(*names), many.select(*names)])
