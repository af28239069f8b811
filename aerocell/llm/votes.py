"""SimHash votes as DataFrame sums: one row per term, two counters in every number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bit k of a hash is counted in the low half of sum k, bit k + 32 in the high half.
_LANES = 0x0000000100000001
_HALF = 32
_LOW = 0xFFFFFFFF

# Blank and the control characters that part words.
BLANKS = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; plain ASCII takes the quick way to the same."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words_of(text: Column) -> Column:
    """Words between blanks; a null or blank text has one empty word."""
    return F.split(F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS)), r"[\x20\x09-\x0D]+")


def place_of_terms(words: Column, size: int) -> Column:
    """Generator of the places (from 1) where shingles of ``size`` words start.

    Fewer words make one shingle of all of them, no word gives a null place.
    """
    last = F.greatest(F.size(words) - (size - 1), F.lit(1))
    return F.explode_outer(F.when(F.get(words, F.lit(0)) != "", F.sequence(F.lit(1), last)))


def vote_sums(term_hashes: list[Column], weight: Column | None = None) -> list[Column]:
    """The aggregates of a group of terms: ``_w`` of the weights, ``_v<i>_<k>`` of the bits of hash i."""
    weight = F.lit(1).cast("long") if weight is None else weight
    sums = [F.coalesce(F.sum(F.when(term_hashes[0].isNotNull(), weight)), F.lit(0)).alias("_w")]
    for i, term_hash in enumerate(term_hashes):
        for k in range(_HALF):
            lanes = F.shiftrightunsigned(term_hash, k).bitwiseAND(F.lit(_LANES))
            sums.append(F.sum(lanes * weight).alias(f"_v{i}_{k}"))
    return sums


def majority(i: int = 0) -> Column:
    """Word i of the fingerprint: a bit is 1 if more than half of the weight has it."""
    total = F.col("_w")
    bits = []
    for k in range(_HALF):
        votes = F.coalesce(F.col(f"_v{i}_{k}"), F.lit(0).cast("long"))
        low, high = votes.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(votes, _HALF)
        top = 1 << (k + _HALF)
        for lane, bit in ((low, 1 << k), (high, top - (1 << 64) if top >> 63 else top)):
            bits.append(F.when(lane * 2 > total, F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
    # A balanced tree keeps the generated expression shallow.
    while len(bits) > 1:
        bits = [reduce(lambda a, b: a.bitwiseOR(b), bits[j : j + 2]) for j in range(0, len(bits), 2)]
    return bits[0]


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def as_hex(fingerprint: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def fingerprints(
    df: DataFrame, keys: list[str], text: Column, size: int, words: int = 1, distinct_words: bool = False
) -> DataFrame:
    """``keys..., n_rows, f0...``: fingerprints of texts by shingles of ``size`` words, unweighted.

    ``keys`` must fix the text; rows that agree in all of them are one row with
    their number. A fingerprint has ``words`` columns of 64 bits: the first by
    the XXH64 of a term (seed 42), the others by hashes of that. Votes are summed before the shuffle, so a
    text of any length sends one row.
    """
    split = words_of(ascii_lower(text))
    split = F.array_distinct(split) if distinct_words else split
    placed = df.select(*keys, split.alias("_words")).select(*keys, "_words", place_of_terms(F.col("_words"), size).alias("_at"))
    term = F.concat_ws(" ", *(F.get("_words", F.col("_at") + (i - 1)) for i in range(size)))
    first_hash = F.when(F.col("_at").isNotNull(), F.xxhash64(term))
    hashed = placed.select(*keys, F.coalesce(F.col("_at"), F.lit(1)).alias("_at"), first_hash.alias("_h"))
    hashes = [F.col("_h"), *(F.when(F.col("_h").isNotNull(), F.xxhash64("_h", F.lit(i))) for i in range(1, words))]
    sums = hashed.groupBy(*keys).agg(F.count_if(F.col("_at") == 1).alias("n_rows"), *vote_sums(hashes))
    return sums.select(*keys, "n_rows", *(majority(i).alias(f"f{i}") for i in range(words)))
