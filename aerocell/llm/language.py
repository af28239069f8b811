"""Language mixtures: expectation-maximisation over words, languages chosen by penalised likelihood.

A text is a bag of words, each written in one language or in none (noise); a
word's likelihood under a language is that of its byte trigrams. EM estimates
the share of each language, and the number of languages is the one that gains
more likelihood than its penalty.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocell.llm.batches import flat, map_texts, per_text, pieces

BITS = 16
BUCKETS = 1 << BITS
# The model is languages x buckets numbers, whatever the number of documents.
MAX_LANGUAGES = 128
SMOOTHING = 0.5
ROUNDS = 15
# Weight of the penalty of half a logarithm of the words per further language.
PENALTY = 2.0
# A text with more noise than this is in no known language; a short note with
# a long key in it still is.
MOST_NOISE = 0.8

UNKNOWN = "und"
RESULT = "lang_pred string, score double, languages array<struct<lang string, share double>>, noise double"

# Letters, lower-cased in ASCII; every byte above ASCII counts as a letter.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


@dataclass(frozen=True)
class LanguageModel:
    """Logarithms of trigram likelihoods: one row per language, the last for noise."""

    languages: tuple[str, ...]
    table: np.ndarray


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(buckets, first, row)``: the trigram around each letter, where words begin in it, and whose they are."""
    rows = len(offsets) - 1
    padded = np.full(len(data) + rows + 1, 0x20, np.uint8)
    shift = np.repeat(np.arange(1, rows + 1), np.diff(offsets))
    padded[np.arange(len(data)) + shift] = _FOLD[data]
    letter = padded[1:-1] != 0x20
    begins = letter & (padded[:-2] == 0x20)
    at = np.flatnonzero(letter)
    code = padded[at].astype(np.uint32)
    for step in (1, 2):
        code = code << np.uint32(8) | padded[at + step]
    buckets = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    starts = np.flatnonzero(begins)
    first = np.searchsorted(at, starts)
    # Position p of the letters is position p + 1 of the padded text.
    row = np.searchsorted(offsets + np.arange(rows + 1), starts + 1, "right") - 1
    return buckets, first, row


def train(labelled: DataFrame) -> LanguageModel:
    """Trigram counts per language over all rows of ``labelled`` (``text, lang``).

    Counted in each task and summed by a shuffle of counts; rows without a
    language or a text teach nothing. More than MAX_LANGUAGES distinct
    languages are refused.
    """
    known = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    languages = sorted(r.lang for r in known.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                names = np.array(piece.column("lang").to_pylist(), object)
                for name in sorted(set(names)):
                    rows = pa.array(np.flatnonzero(names == name))
                    buckets = _trigrams(*flat(piece.column("text").take(rows)))[0]
                    own = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
                    own += np.bincount(buckets, minlength=BUCKETS)
        for name, own in counts.items():
            some = np.flatnonzero(own)
            columns = [pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(own[some])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

    counted = known.mapInArrow(count, "lang string, bucket int, n long")
    sums = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(languages), BUCKETS))
    found = sums.toPandas()
    place = {name: i for i, name in enumerate(languages)}
    counts[found["lang"].map(place).to_numpy(int), found["bucket"].to_numpy(int)] = found["n"].to_numpy(float)
    likely = np.log(counts + SMOOTHING) - np.log(counts.sum(1, keepdims=True) + SMOOTHING * BUCKETS)
    noise = np.full((1, BUCKETS), -np.log(BUCKETS))
    return LanguageModel(tuple(languages), np.concatenate([likely, noise]).astype(np.float32))


def _shares(ratio: np.ndarray, first: np.ndarray, share: np.ndarray) -> np.ndarray:
    """EM from a start; a share of 0 stays 0, so the start also selects the languages."""
    counts = np.diff(np.append(first, len(ratio)))
    text_of = np.repeat(np.arange(len(first)), counts)
    for _ in range(ROUNDS):
        part = ratio * share[text_of]
        part /= part.sum(1, keepdims=True)
        new = np.add.reduceat(part, first, axis=0) / counts[:, None].astype(np.float32)
        moved = np.abs(new - share).max(initial=0)
        share = new
        if moved < 1e-3:
            break
    return share


def _penalised(ratio: np.ndarray, first: np.ndarray, share: np.ndarray, size: int) -> np.ndarray:
    counts = np.diff(np.append(first, len(ratio)))
    fit = np.log((ratio * np.repeat(share, counts, axis=0)).sum(1))
    return np.add.reduceat(fit.astype(np.float64), first) - PENALTY * 0.5 * (size - 1) * np.log(counts + 1)


def _mixtures(model: LanguageModel, buckets: np.ndarray, words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Shares (texts x languages and noise) of texts whose words begin at ``words``."""
    n = len(model.languages)
    fit = np.stack([np.add.reduceat(row[buckets], words) for row in model.table], axis=1)
    ratio = np.maximum(np.exp(fit - fit.max(1, keepdims=True)), np.float32(1e-30))
    full = _shares(ratio, first, np.full((len(first), n + 1), 1 / (n + 1), np.float32))
    order = np.argsort(-full[:, :n], axis=1, kind="stable")

    def chosen(texts: np.ndarray, size: int) -> np.ndarray:
        start = np.zeros((len(texts), n + 1), np.float32)
        np.put_along_axis(start, order[texts, :size], np.float32(1 / (size + 1)), axis=1)
        start[:, n] = 1 / (size + 1)
        return start

    counts = np.diff(np.append(first, len(ratio)))
    active = np.arange(len(first))
    best = _shares(ratio, first, chosen(active, 1))
    value = _penalised(ratio, first, best, 1)
    for size in range(2, n + 1):
        wanted = np.zeros(len(first), bool)
        wanted[active] = True
        own = ratio[np.repeat(wanted, counts)]
        begins = np.cumsum(counts[active]) - counts[active]
        share = _shares(own, begins, chosen(active, size))
        gain = _penalised(own, begins, share, size)
        better = gain > value[active]
        active, share, gain = active[better], share[better], gain[better]
        if not len(active):
            break
        best[active], value[active] = share, gain
    return best


def _infer(model: LanguageModel, texts: pa.Array) -> list[tuple[str, float, list[dict], float]]:
    """``(language, score, languages, noise)`` of each text."""
    data, offsets = flat(texts)
    lettered = per_text(np.cumsum((_FOLD[data] != 0x20) & (data < 0x80)), offsets) > 0
    for row in np.flatnonzero(~lettered & (np.diff(offsets) > 0)):
        lettered[row] = any(c.isalpha() for c in texts[int(row)].as_py())
    out: list[tuple[str, float, list[dict], float]] = [(UNKNOWN, 0.0, [], 1.0)] * len(texts)
    buckets, words, row_of = _trigrams(data, offsets)
    if not len(words) or not model.languages:
        return out
    rows, first = np.unique(row_of, return_index=True)
    shares = _mixtures(model, buckets, words, first).astype(float)
    for row, share in zip(rows, np.clip(shares, 0, 1)):
        if not lettered[row]:
            continue
        by_share = sorted(zip(model.languages, share), key=lambda x: (-x[1], x[0]))
        found = [{"lang": name, "share": part} for name, part in by_share if part > 0]
        out[row] = (by_share[0][0], by_share[0][1], found, share[-1])
    return out


def infer(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The languages of every whole text: ``doc_id, lang_pred, score, languages, noise``.

    ``languages`` holds the selected languages by share, ``lang_pred`` the first
    of them (ties: by name) and ``score`` its share of the words; ``noise`` is
    the share of words that fit no language. A null text, one without a letter,
    or a model without languages gives ``und``, score 0 and noise 1. Null and
    repeated ids keep their rows; other columns are ignored.
    """
    columns = pa.struct([("lang", pa.string()), ("share", pa.float64())])

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = _infer(model, piece.column("text"))
        names, scores, languages, noise = map(list, zip(*found))
        parts = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(languages, pa.list_(columns))]
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), *parts, pa.array(noise, pa.float64())],
            names=["doc_id", "lang_pred", "score", "languages", "noise"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), "text", work, f"doc_id {kind}, {RESULT}")


def in_known_language(docs: DataFrame, model: LanguageModel, most_noise: float = MOST_NOISE) -> DataFrame:
    """The rows of ``docs`` whose text is in the model's languages, all columns as they were.

    Rejected: texts that are ``und``, and those with a larger share of noise.
    """

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        kept = [name != UNKNOWN and noise <= most_noise for name, _, _, noise in _infer(model, piece.column("text"))]
        return piece.filter(pa.array(kept, pa.bool_()))

    return map_texts(docs, "text", work, docs.schema)


def remainder(doc_id: str = "doc_id", parts: int = 3) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def train_on_rest(docs: DataFrame, held_out: int = 1, parts: int = 3) -> LanguageModel:
    """The model of all labelled documents that are not held out."""
    return train(docs.filter(remainder(parts=parts) != held_out))


def accuracy(predicted: DataFrame, docs: DataFrame, columns: Sequence[str] = ("lang_pred", "lang")) -> DataFrame:
    """Share of the documents whose predicted language is the given one."""
    got, given = columns
    both = predicted.join(docs.select("doc_id", given), "doc_id")
    return both.agg(F.avg((F.col(got) == F.col(given)).cast("double")).alias("accuracy"))
