"""Benchmark decontamination: item-sized windows around shared shingles, exact similarity.

A window can only be similar to an item if they share a shingle, so the windows
are those of an item's size around the shingles that the document shares with
an item of that size. Each is compared with all items of its size that it
shares a shingle with, by the exact similarity of the shingles, weighted by how
often each occurs; nothing is ruled out by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerocell.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
# The shingle index of the benchmark is broadcast up to this many rows (of some
# 50 bytes); a larger one is joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def normal_words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingle_hash(words: Column, place: Column) -> Column:
    """Of the shingle that starts at ``place``, from 0."""
    return F.xxhash64(F.concat_ws(" ", *(F.get(words, place + i) for i in range(SHINGLE))))


def _places(first: Column, words_in_window: Column) -> Column:
    """Where the shingles of a window start."""
    return F.sequence(first, first + words_in_window - SHINGLE)


def _window_shingles(windows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., shingles`` of windows ``keys..., _words, _first, _size``.

    Rows repeated whole are one: each place gives its shingle once.
    """
    placed = windows.select(*keys, "_words", F.explode_outer(_places(F.col("_first"), F.col("_size"))).alias("_at"))
    hashed = placed.select(*keys, "_at", _shingle_hash(F.col("_words"), F.col("_at")).alias("_h"))
    each = F.collect_set(F.struct("_at", "_h"))
    return hashed.groupBy(*keys).agg(F.transform(each, lambda x: x["_h"]).alias("shingles"))


def items_of(benchmark: DataFrame) -> DataFrame:
    """``item_id, length, _words`` of the items with at least one shingle; rows with equal words of one item once."""
    words = benchmark.select("item_id", normal_words(F.col("text")).alias("_words"))
    return words.select("item_id", F.size("_words").alias("length"), "_words").filter(F.col("length") >= SHINGLE).distinct()


def shared_places(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, _text, _n, _at, length, _from, _context``: where a document has a shingle of an item of that length.

    ``_context`` holds the words from ``_from`` on that windows of this length
    over the shingle can reach, so that texts need not be moved or split again.
    An index too large to broadcast is joined to bare places first.
    """
    shingles = items.select("length", "_words", F.explode(_places(F.lit(0), F.col("length"))).alias("_at"))
    index = shingles.select(_shingle_hash(F.col("_words"), F.col("_at")).alias("_h"), "length")
    index = materialise(index.groupBy("_h").agg(F.collect_set("length").alias("_lengths")), "index")
    keys = ["doc_id", "_text"]
    words = docs.select("doc_id", F.xxhash64("text").alias("_text"), normal_words(F.col("text")).alias("_words"))
    sized = words.select("*", F.size("_words").alias("_n"))
    last = F.when(F.col("_n") >= SHINGLE, _places(F.lit(0), F.col("_n")))
    placed = sized.select(*keys, "_n", "_words", F.explode_outer(last).alias("_at")).filter(F.col("_at").isNotNull())
    hashed = placed.select("*", _shingle_hash(F.col("_words"), F.col("_at")).alias("_h"))
    if index.count() <= BROADCAST_ROWS:
        met = hashed.join(F.broadcast(index), "_h").select(*keys, "_n", "_words", "_at", "_lengths")
    else:
        bare = hashed.select(*keys, "_at", "_h").join(index, "_h")
        found = bare.groupBy(*keys).agg(F.collect_set(F.struct("_at", "_lengths")).alias("_found"))
        same = F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("s._text") == F.col("f._text"))
        both = sized.alias("s").join(found.alias("f"), same)
        each = both.select("s.doc_id", "s._text", "_n", "_words", F.explode("_found").alias("_one"))
        met = each.select(*keys, "_n", "_words", "_one._at", "_one._lengths")
    spread = met.select(*keys, "_n", "_words", "_at", F.explode("_lengths").alias("length"))
    start = F.greatest(F.col("_at") + SHINGLE - F.col("length"), F.lit(0))
    placed = spread.withColumn("_from", start)
    context = F.slice("_words", F.col("_from") + 1, F.col("_at") + F.col("length") - F.col("_from"))
    return placed.select(*keys, "_n", "_at", "length", "_from", context.alias("_context"))


def item_windows(shared: DataFrame) -> DataFrame:
    """``doc_id, _text, length, first_word, _words``: every window of an item's size over a shared shingle, once.

    A window belongs to its first shared shingle, so each shingle opens those
    windows that begin after the one before; a repeated row opens none. Shorter
    documents are one window.
    """
    order = Window.partitionBy("doc_id", "_text", "length").orderBy("_at")
    opens = shared.withColumn("_before", F.coalesce(F.lag("_at").over(order), F.lit(-1)))
    end = F.greatest(F.col("_n") - F.col("length"), F.lit(0))
    low = F.greatest(F.col("_before") + 1, F.col("_from"))
    high = F.least(F.col("_at"), end)
    # The last windows begin before a shared shingle near the end of the text.
    starts = F.when(low <= high, F.sequence(low, high))
    found = opens.select("*", F.explode(starts).alias("first_word"))
    words = F.slice("_context", F.col("first_word") - F.col("_from") + 1, F.least("length", "_n"))
    return found.select("doc_id", "_text", "length", "first_word", words.alias("_words"))


def _numbered(shingles: Column) -> Column:
    """The k-th occurrence of a shingle as an element of its own, so that sets count occurrences."""
    repeats = F.transform(
        shingles, lambda x, i: F.xxhash64(x, F.size(F.filter(F.slice(shingles, 1, i), lambda y: y == x)))
    )
    single = F.transform(shingles, lambda x: F.xxhash64(x, F.lit(0)))
    return F.when(F.size(F.array_distinct(shingles)) == F.size(shingles), single).otherwise(repeats)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, item_id, similarity, first_word, n_windows``: the items that a document repeats.

    ``similarity`` is that of the most similar window (ties: the first), the
    weight of the shared shingles of five words over that of all, each weighing
    its occurrences; ``first_word`` is where it begins, and ``n_windows`` how
    many windows are as similar as asked. Words are runs of letters and digits,
    lower-cased.

    Null and empty texts repeat nothing, nor does an item of fewer than five
    words. Items with the same text each give a row, repeated items and
    documents one; null ids are ids; other columns are ignored.
    """
    items = materialise(items_of(benchmark), "items")
    windows = item_windows(shared_places(docs, items))
    sized = windows.select("*", F.lit(0).alias("_first"), F.size("_words").alias("_size"))
    own = _window_shingles(sized, ["doc_id", "_text", "length", "first_word"])
    # Windows with the same shingles have the same answer; repeated passages are looked up once.
    keys = own.select("*", F.xxhash64(F.array_sort("shingles")).alias("_same"))
    keys = materialise(keys, "windows")
    asked = keys.groupBy("length", "_same").agg(F.first("shingles").alias("shingles"))
    numbered = items.select("item_id", "length", "_words", F.lit(0).alias("_first"), F.col("length").alias("_size"))
    known = _window_shingles(numbered, ["item_id", "length"])
    a = asked.select("length", "_same", F.size("shingles").alias("_na"), F.explode(_numbered(F.col("shingles"))).alias("_h"))
    b = known.select("length", "item_id", F.size("shingles").alias("_nb"), F.explode(_numbered(F.col("shingles"))).alias("_h"))
    b = materialise(b, "numbered")
    # An index that fits is broadcast: most shingles of a window are no item's and need not be moved.
    b = F.broadcast(b) if b.count() <= BROADCAST_ROWS else b
    both = a.join(b, ["length", "_h"]).groupBy("length", "_same", "item_id", "_na", "_nb").agg(F.count(F.lit(1)).alias("_both"))
    scored = both.select(
        "length", "_same", "item_id", (F.col("_both") / (F.col("_na") + F.col("_nb") - F.col("_both"))).alias("similarity")
    ).filter(F.col("similarity") >= similarity)
    found = keys.join(scored, ["length", "_same"])
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("_back"))).alias("_best")
    rows = found.groupBy("doc_id", "item_id").agg(best, F.count(F.lit(1)).alias("n_windows"))
    return rows.select(
        "doc_id", "item_id", "_best.similarity", (-F.col("_best._back")).cast("long").alias("first_word"), "n_windows"
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that repeat no item, all columns as they were."""
    hit = contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("_hit")).distinct()
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("_hit")), "left_anti")
