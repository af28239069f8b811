"""Text quality without hand labels: a model of weak labellers trains a hashed linear scorer.

Heuristic labellers call a text good or bad, or abstain. Expectation-
maximisation estimates how often each is right from how they agree, and the
posterior of each text's votes is the label that the scorer learns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocell.llm.batches import flat, map_texts, per_text

BAD, GOOD, ABSTAIN = 0, 1, 2
N_VOTES = 3
# The scorer is fitted on about this many texts, picked by a hash of their
# content; votes, their counts and all scores cover every text.
SAMPLE_ROWS = 4000
FEATURES = 1 << 12
# Texts whose features are in memory at a time.
CHUNK = 256

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[ord(c) for c in ".,;:!?'\"()-"]] = True
_SIGN = ~(_BLANK | _LETTER | _DIGIT | _PLAIN)

_MIX = np.random.default_rng(20).integers(1, 2**63, (64, 256), dtype=np.uint64)


@dataclass(frozen=True)
class Labeller:
    """A vote for texts whose measures all reach (bad) or keep below (good) their bounds; else it abstains."""

    vote: int
    bounds: tuple[tuple[str, float], ...]
    # A text of fewer words says too little.
    least_words: int = 3


LABELLERS = (
    Labeller(BAD, (("signs", 0.06),)),
    Labeller(BAD, (("sign_ends", 0.15),)),
    Labeller(BAD, (("bars", 0.15),)),
    Labeller(BAD, (("capitals", 0.5),)),
    Labeller(BAD, (("shouts", 0.2),)),
    Labeller(BAD, (("repeats", 0.3),)),
    Labeller(BAD, (("echoes", 0.3),)),
    # One trait can spoil a text, so these ask for several at once.
    Labeller(GOOD, (("signs", 0.03), ("capitals", 0.3), ("shouts", 0.1), ("repeats", 0.15), ("bars", 0.05))),
    Labeller(GOOD, (("sign_ends", 0.05), ("capitals", 0.3), ("echoes", 0.2), ("bars", 0.05))),
    Labeller(GOOD, (("signs", 0.03), ("shouts", 0.1), ("echoes", 0.2), ("repeats", 0.15))),
)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, text)`` of every run without blanks."""
    rows = len(offsets) - 1
    padded = np.full(len(data) + rows + 1, 0x20, np.uint8)
    padded[np.arange(len(data)) + np.repeat(np.arange(1, rows + 1), np.diff(offsets))] = data
    word = ~_BLANK[padded]
    start = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    end = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    row = np.searchsorted(offsets + np.arange(rows + 1), start, "right") - 1
    return start - row - 1, end - row - 1, row


def _same_as_before(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, back: int = 1) -> np.ndarray:
    """Whether each word repeats the one ``back`` places before it in its text."""
    if len(start) <= back:
        return np.zeros(len(start), bool)
    lengths = end - start
    opens = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(opens, lengths)
    mixed = _MIX[place & 63, data[place + np.repeat(start, lengths)]]
    value = np.add.reduceat(mixed, opens) ^ lengths.astype(np.uint64)
    same = (value[back:] == value[:-back]) & (row[back:] == row[:-back])
    return np.concatenate((np.zeros(back, bool), same))


def _measures(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The measures of every text, and its number of words."""
    rows = len(offsets) - 1
    start, end, row = _words(data, offsets)
    words = np.bincount(row, minlength=rows)

    def count(table: np.ndarray) -> np.ndarray:
        return per_text(np.cumsum(table[data]), offsets)

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row[mask], minlength=rows)

    some = np.maximum(words, 1)
    letters = np.maximum(count(_LETTER), 1)
    filled = np.maximum(np.diff(offsets) - count(_BLANK), 1)
    bar = np.zeros(256, bool)
    bar[ord("|")] = True
    shout = np.zeros(256, bool)
    shout[ord("!")] = True
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    return {
        "signs": count(_SIGN) / filled,
        "sign_ends": of_words(_SIGN[last]) / some,
        "bars": count(bar) / some,
        "capitals": count(_UPPER) / letters,
        "shouts": count(shout) / some,
        "repeats": of_words(_same_as_before(data, start, end, row)) / some,
        "echoes": of_words(_same_as_before(data, start, end, row, 2)) / some,
    }, words


def _votes(data: np.ndarray, offsets: np.ndarray, labellers: tuple[Labeller, ...]) -> tuple[np.ndarray, np.ndarray]:
    """texts x labellers of votes, and the number of words."""
    measures, words = _measures(data, offsets)
    votes = np.full((len(words), len(labellers)), ABSTAIN, np.int64)
    for i, labeller in enumerate(labellers):
        fires = words >= labeller.least_words
        for measure, bound in labeller.bounds:
            value = measures[measure]
            fires &= value >= bound if labeller.vote == BAD else value <= bound
        votes[fires, i] = labeller.vote
    return votes, words


def _pattern(votes: np.ndarray) -> np.ndarray:
    return votes @ N_VOTES ** np.arange(votes.shape[1])


def _unpacked(patterns: np.ndarray, n: int) -> np.ndarray:
    return patterns[:, None] // N_VOTES ** np.arange(n) % N_VOTES


@dataclass(frozen=True)
class LabelModel:
    """Share of good texts, and each labeller's accuracy when it votes."""

    prior: float
    accuracy: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance that a text with these votes is good; who abstains says nothing."""
        weight = np.log(self.accuracy) - np.log1p(-self.accuracy)
        side = (votes == GOOD).astype(float) - (votes == BAD)
        fit = side @ weight + np.log(self.prior) - np.log1p(-self.prior)
        return 1 / (1 + np.exp(-np.clip(fit, -500, 500)))


def fit_labellers(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation over the distinct vote patterns and their numbers of texts.

    Each labeller starts as mostly right, so that "good" keeps its meaning, and
    as much evidence as 19 right votes and a wrong one is added to each, so that
    a labeller that hardly speaks stays near its start.
    """
    right_votes, all_votes = 19, 20
    model = LabelModel(0.5, np.full(votes.shape[1], right_votes / all_votes))
    for _ in range(rounds):
        belief = model.posterior(votes)
        right = (votes == GOOD) * belief[:, None] + (votes == BAD) * (1 - belief)[:, None]
        spoken = (votes != ABSTAIN) * counts[:, None]
        accuracy = ((right * counts[:, None]).sum(0) + right_votes) / (spoken.sum(0) + all_votes)
        prior = ((belief * counts).sum() + 1) / (counts.sum() + 2)
        moved = np.abs(accuracy - model.accuracy).max(initial=0)
        model = LabelModel(float(prior), accuracy)
        if moved < 1e-7:
            break
    return model


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """texts x FEATURES: square roots of the shares of hashed byte trigrams and repeated words."""
    rows = len(offsets) - 1
    text_of = np.repeat(np.arange(rows), np.diff(offsets))
    code = data.astype(np.uint32)
    at = np.arange(max(len(data) - 2, 0))
    inside = text_of[at] == text_of[at + 2] if len(at) else np.zeros(0, bool)
    at = at[inside]
    gram = code[at] << np.uint32(16) | code[at + 1] << np.uint32(8) | code[at + 2]
    bucket = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 12)
    start, end, row = _words(data, offsets)
    again = _same_as_before(data, start, end, row).astype(np.int64)
    # The last two features count words that repeat the one before, and others.
    found = np.bincount(text_of[at] * FEATURES + bucket.astype(np.int64) % (FEATURES - 2), minlength=rows * FEATURES)
    found = found + np.bincount(row * FEATURES + FEATURES - 1 - again, minlength=rows * FEATURES)
    matrix = found.reshape(rows, FEATURES).astype(np.float32)
    return np.sqrt(matrix / np.maximum(matrix.sum(1, keepdims=True), 1))


def _chunks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for start in range(0, len(texts), CHUNK):
        yield flat(texts.slice(start, CHUNK))


@dataclass(frozen=True)
class Scorer:
    """Weights of the hashed features and a constant."""

    weights: np.ndarray
    constant: float

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights + self.constant, -60, 60).astype(float)))


def fit_scorer(features: np.ndarray, labels: np.ndarray, rounds: int = 200, decay: float = 1e-4) -> Scorer:
    """Logistic regression on soft labels, both classes weighing the same; accelerated gradient steps."""
    weight = labels / max(labels.sum(), 1e-9) + (1 - labels) / max((1 - labels).sum(), 1e-9)
    weight = weight / weight.sum()
    centre = (weight[:, None] * features).sum(0) if len(features) else np.zeros(features.shape[1])
    x = (features - centre).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    ahead, ahead_b = w, b
    # Rows have unit length, so this rate is below the inverse of the curvature.
    rate = 3.0
    for t in range(rounds):
        miss = weight * (1 / (1 + np.exp(-(x @ ahead + ahead_b))) - labels)
        new, new_b = ahead - rate * (x.T @ miss.astype(np.float32) + decay * ahead), ahead_b - rate * miss.sum()
        push = t / (t + 3)
        ahead, ahead_b = new + push * (new - w), new_b + push * (new_b - b)
        w, b = new, new_b
    return Scorer(w, float(b - centre @ w))


@dataclass(frozen=True)
class QualityModel:
    labellers: tuple[Labeller, ...]
    labels: LabelModel
    scorer: Scorer


def train(docs: DataFrame, labellers: tuple[Labeller, ...] = LABELLERS, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Label model over the votes on all texts, scorer over a sample of about ``sample_rows``.

    The driver sees one count per vote pattern (at most 3 to the number of
    labellers) and the sample's features; texts without words take no part.
    """

    def vote(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat(batch.column("text"))
        votes, words = _votes(data, offsets, labellers)
        return pa.RecordBatch.from_arrays([pa.array(_pattern(votes)[words > 0], pa.int64())], names=["pattern"])

    texts = docs.select("text")
    counted = map_texts(texts, "text", vote, "pattern long").groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    table = counted.orderBy("pattern").toPandas()
    patterns, counts = table["pattern"].to_numpy(np.int64), table["n"].to_numpy(float)
    labels = fit_labellers(_unpacked(patterns, len(labellers)), counts)
    parts = 1 << 30
    share = min(1.0, sample_rows / max(counts.sum(), 1))
    picked = texts.filter(F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(parts)) < F.lit(int(share * parts)))
    # Copies of a picked text teach once, so a large group of them costs no memory.
    picked = picked.distinct()

    def learn(batch: pa.RecordBatch) -> pa.RecordBatch:
        beliefs, rows = [], []
        for data, offsets in _chunks(batch.column("text")):
            votes, words = _votes(data, offsets, labellers)
            beliefs += list(labels.posterior(votes)[words > 0])
            rows += [row.astype("<f4").tobytes() for row in _features(data, offsets)[words > 0]]
        return pa.RecordBatch.from_arrays([pa.array(beliefs, pa.float64()), pa.array(rows, pa.binary())], names=["belief", "row"])

    sample = map_texts(picked, "text", learn, "belief double, row binary").orderBy(F.xxhash64("row")).collect()
    matrix = np.frombuffer(b"".join(r.row for r in sample), "<f4").reshape(-1, FEATURES)
    scorer = fit_scorer(matrix, np.array([r.belief for r in sample]))
    return QualityModel(labellers, labels, scorer)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score, weak_label, votes`` of every whole text.

    ``score`` is the scorer's chance that the text is good, ``weak_label`` the
    label model's, ``votes`` one letter per labeller (b, g, or - to abstain).
    A text without words, a null one too, scores 0 with weak label 0. Null and
    repeated ids keep their rows; other columns are ignored.
    """

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        scores, beliefs, shown = [], [], []
        for data, offsets in _chunks(piece.column("text")):
            votes, words = _votes(data, offsets, model.labellers)
            scores.append(np.where(words > 0, model.scorer.score(_features(data, offsets)), 0.0))
            beliefs.append(np.where(words > 0, model.labels.posterior(votes), 0.0))
            shown += ["".join("bg-"[v] for v in row) for row in votes]
        columns = [pa.array(np.concatenate(x), pa.float64()) for x in (scores, beliefs)]
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns, pa.array(shown, pa.string())], names=names)

    names = ["doc_id", "score", "weak_label", "votes"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), "text", work, f"doc_id {kind}, score double, weak_label double, votes string")
