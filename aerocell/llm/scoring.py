"""Language-model scores: a log-bilinear model of word classes, trained by noise-contrastive estimation.

The most frequent words are classes of their own and the others share classes by
their ending. The network gives the probability of a class after the two classes
before it; counts over the whole corpus give that of a word in its class. Every
context is normalised exactly, by matrix products over all classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocell.llm.batches import flat, pieces
from aerocell.llm.language import remainder
from aerocell.session import materialise

# Words with a class of their own, and classes that the others share. The
# network has this size at any size of the corpus; the counts grow with it.
OWN_CLASSES, SHARED_CLASSES = 768, 255
CLASSES = OWN_CLASSES + SHARED_CLASSES + 1
END = CLASSES - 1
WIDTH = 24
# Words whose counts every task holds; the counts of all others are joined.
# Longer words are joined too, so that the table is bounded in bytes.
HELD_WORDS, HELD_BYTES = 65_536, 64

NOISE = 48
BATCH = 512
RATE = 0.05
# A share of the corpus trains first, for a common start of all tasks.
FIRST_SHARE = 16
# Models that one task averages.
FAN_IN = 64
_TOKENS_AT_ONCE = 1 << 16
_COUNT_BYTES = 8 << 20
# Logarithm of the chance of a class that no word has.
_NEVER = -1e4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

_BLOB = "part long, weight double, params binary"
_SCORED = (
    "doc_id {id}, held_out boolean, n_tokens long, n_held long, log_counts double, log_classes double, others array<string>"
)


@dataclass
class Words:
    """The words of a piece of texts, one after the other, and how many each text has."""

    words: pa.Array
    per_text: np.ndarray
    ending: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        data, offsets = flat(texts)
        data = _LOWER[data]
        letter = ~_BLANK[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        starts, ends = letter.copy(), letter.copy()
        starts[1:] &= ~letter[:-1] | edge[1:-1]
        ends[:-1] &= ~letter[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
        bounds = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts + 1, out=bounds[1:])
        words = pa.Array.from_buffers(
            pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[letter])]
        )
        last = data[ends].astype(np.int32)
        before = data[np.maximum(ends - 1, 0)] if len(data) else data
        ending = (np.where(ends > starts, before, 0).astype(np.int32) * 256 + last) % SHARED_CLASSES
        return cls(words, np.diff(np.searchsorted(starts, offsets)), ending)

    def classes(self, held: np.ndarray) -> np.ndarray:
        """Class of each word by its place among the held words (-1: not held)."""
        own = (held >= 0) & (held < OWN_CLASSES)
        return np.where(own, held, OWN_CLASSES + self.ending)

    def contexts(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each token, an end after each text included, the two before it, and where texts begin among them."""
        n = len(self.per_text)
        padded = np.full(len(classes) + 3 * n, END, np.int32)
        begins = np.cumsum(self.per_text + 3) - self.per_text - 3
        text_of = np.repeat(np.arange(n), self.per_text)
        padded[np.arange(len(classes)) + 3 * text_of + 2] = classes
        taken = np.ones(len(padded), bool)
        taken[begins] = taken[begins + 1] = False
        at = np.flatnonzero(taken)
        return padded[at], padded[at - 1], padded[at - 2], np.cumsum(self.per_text + 1) - self.per_text - 1


def class_shares(counts: np.ndarray) -> np.ndarray:
    """Smoothed shares of the classes; one of its own that no word has taken gets none."""
    smooth = np.where((counts > 0) | (np.arange(CLASSES) >= OWN_CLASSES), counts + 1, 0)
    return smooth / smooth.sum()


@dataclass
class Network:
    """Vectors of classes as context and as prediction, a matrix for each place before, and biases."""

    context: np.ndarray
    target: np.ndarray
    places: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, counts: np.ndarray) -> Network:
        rng = np.random.default_rng(13)
        some = [rng.normal(0, 0.1, (CLASSES, WIDTH)) for _ in range(2)]
        places = np.stack([np.eye(WIDTH), 0.5 * np.eye(WIDTH)])
        share = class_shares(counts)
        bias = np.where(share > 0, np.log(np.maximum(share, 1e-300)), _NEVER)
        return cls(*(a.astype(np.float32) for a in (*some, places, bias)))

    def arrays(self) -> list[np.ndarray]:
        return [self.context, self.target, self.places, self.bias]

    def pack(self) -> bytes:
        return b"".join(a.tobytes() for a in self.arrays())

    @classmethod
    def unpack(cls, data: bytes | np.ndarray) -> Network:
        whole = np.frombuffer(data, np.float32) if isinstance(data, bytes) else data.astype(np.float32)
        shapes = [(CLASSES, WIDTH), (CLASSES, WIDTH), (2, WIDTH, WIDTH), (CLASSES,)]
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        return cls(*(a.reshape(s).copy() for a, s in zip(np.split(whole, ends[:-1]), shapes)))

    def log_totals(self, second: np.ndarray) -> np.ndarray:
        """Normalisers of all contexts with these classes two before: ``(len(second), CLASSES)``."""
        near, far = self.context @ self.places[0], self.context @ self.places[1]
        out = np.empty((len(second), CLASSES), np.float32)
        for i, c in enumerate(second.tolist()):
            scores = (near + far[c]) @ self.target.T + self.bias
            most = scores.max(axis=1, keepdims=True)
            out[i] = most[:, 0] + np.log(np.exp(scores - most).sum(axis=1, dtype=np.float64))
        return out


def _summed(places: np.ndarray, rows: np.ndarray, into: np.ndarray) -> None:
    """Add each row to its place."""
    order = np.argsort(places, kind="stable")
    sorted_places = places[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_places[1:] != sorted_places[:-1])))
    into[sorted_places[first]] += np.add.reduceat(rows[order], first, axis=0)


class Trainer:
    """Noise-contrastive estimation in mini-batches, with step sizes by past gradients."""

    def __init__(self, network: Network, counts: np.ndarray, seed: int):
        self.network, self.rng, self.weight = network, np.random.default_rng(seed), 0
        share = class_shares(counts)
        self.steps = np.cumsum(share)
        self.log_noise = np.log(np.maximum(NOISE * share, 1e-30)).astype(np.float32)
        self.squares = [np.full_like(a, 1e-6) for a in network.arrays()]

    def learn(self, tokens: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        for start in range(0, len(tokens), BATCH):
            cut = slice(start, start + BATCH)
            self._step(tokens[cut], first[cut], second[cut])
        self.weight += len(tokens)

    def _step(self, token: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        net, size = self.network, np.float32(1 / len(token))
        noise = np.minimum(np.searchsorted(self.steps, self.rng.random(NOISE)), CLASSES - 1)
        one, two = net.context[first], net.context[second]
        guess = one @ net.places[0] + two @ net.places[1]
        wanted, others = net.target[token], net.target[noise]
        # Of each token and of the shared noise: how far the data's odds are off.
        right = np.einsum("ij,ij->i", guess, wanted) + net.bias[token] - self.log_noise[token]
        wrong = guess @ others.T + (net.bias[noise] - self.log_noise[noise])
        right = (1 / (1 + np.exp(-right)) - 1) * size
        wrong = size / (1 + np.exp(-wrong))
        back = right[:, None] * wanted + wrong @ others
        gradients = [np.zeros_like(a) for a in net.arrays()]
        _summed(token, np.concatenate([right[:, None] * guess, right[:, None]], axis=1), joined := np.zeros((CLASSES, WIDTH + 1), np.float32))
        _summed(noise, np.concatenate([wrong.T @ guess, wrong.sum(axis=0)[:, None]], axis=1), joined)
        gradients[1], gradients[3] = joined[:, :WIDTH], joined[:, WIDTH]
        _summed(first, back @ net.places[0].T, gradients[0])
        _summed(second, back @ net.places[1].T, gradients[0])
        gradients[2] = np.stack([one.T @ back, two.T @ back])
        for array, gradient, square in zip(net.arrays(), gradients, self.squares):
            square += gradient * gradient
            array -= RATE * gradient / np.sqrt(square)


@dataclass
class ScoringModel:
    """A trained model: what every task holds, and the table of all counts."""

    held: list[str]
    held_counts: np.ndarray
    class_totals: np.ndarray
    network: Network
    log_totals: np.ndarray
    counts: DataFrame
    n_tokens: int
    n_distinct: int
    n_texts: int


def count_words(docs: DataFrame) -> DataFrame:
    """``word, ending, n`` over all rows of ``docs`` (``text``); null texts have no words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text", _COUNT_BYTES):
                found = Words.of(piece.column("text"))
                coded = found.words.dictionary_encode()
                places = coded.indices.to_numpy()
                n = np.bincount(places, minlength=len(coded.dictionary))
                ending = np.zeros(len(coded.dictionary), np.int32)
                ending[places] = found.ending
                columns = [coded.dictionary.cast(pa.string()), pa.array(ending), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "ending", "n"])

    counted = docs.select("text").mapInArrow(count, "word string, ending int, n long")
    return counted.groupBy("word", "ending").agg(F.sum("n").alias("n"))


def _averaged(blobs: DataFrame, parts: int) -> np.ndarray | None:
    """The mean of the models by their weights, a few dozen at a time, so that no task holds many."""

    def mean(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, weight = 0.0, 0.0
        for batch in batches:
            for w, params in zip(batch.column("weight").to_pylist(), batch.column("params").to_pylist()):
                whole, weight = whole + w * np.frombuffer(params, np.float32).astype(np.float64), weight + w
        params = (whole / weight).astype(np.float32).tobytes()
        yield pa.RecordBatch.from_pydict({"part": [key[0].as_py()], "weight": [weight], "params": [params]})

    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        grouped = blobs.withColumn("part", F.col("part") % parts).groupBy("part")
        blobs = materialise(grouped.applyInArrow(mean, _BLOB), "models")
    rows = blobs.select("weight", "params").collect()
    if not rows:
        return None
    weights = np.array([r.weight for r in rows])
    return sum(r.weight * np.frombuffer(r.params, np.float32).astype(np.float64) for r in rows) / weights.sum()


def _trained(docs: DataFrame, network: Network, held: list[str], class_counts: np.ndarray) -> Network:
    """One pass over ``docs``: every task trains on its own texts, then the models are averaged."""
    shared = docs.sparkSession.sparkContext.broadcast((network.pack(), held, class_counts))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, words, counts = shared.value
        part = TaskContext.get().partitionId()
        trainer, known = Trainer(Network.unpack(start), counts, part), pa.array(words, pa.large_string())
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = Words.of(piece.column("text"))
                tokens, first, second, _ = found.contexts(found.classes(_held(found.words, known)))
                trainer.learn(tokens, first, second)
        if trainer.weight:
            packed = trainer.network.pack()
            yield pa.RecordBatch.from_pydict({"part": [part], "weight": [float(trainer.weight)], "params": [packed]})

    texts = docs.select("text")
    blobs = materialise(texts.mapInArrow(train, _BLOB), "models")
    mean = _averaged(blobs, texts.rdd.getNumPartitions())
    shared.unpersist()
    return network if mean is None else Network.unpack(mean)


def _held(words: pa.Array, known: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)


def _normalisers(spark: SparkSession, network: Network) -> np.ndarray:
    """Logarithms of the totals of all contexts, by class two before and class before."""
    shared = spark.sparkContext.broadcast(network.pack())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network.unpack(shared.value)
        for batch in batches:
            rows = net.log_totals(batch.column("id").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["id", "row"])

    tasks = max(spark.sparkContext.defaultParallelism, 1)
    rows = spark.range(0, CLASSES, 1, tasks).mapInArrow(work, "id long, row binary").collect()
    shared.unpersist()
    return np.stack([np.frombuffer(r.row, np.float32) for r in sorted(rows, key=lambda r: r.id)])


def train(docs: DataFrame) -> ScoringModel:
    """Learn from all rows of ``docs`` (``text``; a null text is empty); no row teaches a uniform model.

    Counts cover every word and are summed before and by the shuffle; what a
    task or the driver holds is the network and the counts of at most
    HELD_WORDS words. Training goes over a sixteenth of the texts first and then
    over all of them; each task trains on its own share, from the same start,
    and the average of their networks by tokens is the next one.
    """
    counts = materialise(count_words(docs), "counts")
    texts = docs.count()
    short = counts.filter(F.octet_length("word") <= HELD_BYTES)
    top = short.orderBy(F.desc("n"), "word").limit(HELD_WORDS).select("word", "n").toArrow()
    held, held_counts = top.column("word").to_pylist(), top.column("n").to_numpy().astype(np.float64)
    sums = {r.ending: r for r in counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    totals = np.array([[sums[e].n, sums[e].v] if e in sums else [0, 0] for e in range(SHARED_CLASSES)], np.float64)
    n_words, n_distinct = int(totals[:, 0].sum()), int(totals[:, 1].sum()) + (texts > 0)
    # Words with a class of their own leave the one of their ending.
    for ending, n in zip(Words.of(pa.array(held[:OWN_CLASSES], pa.string())).ending, held_counts):
        totals[ending] -= (n, 1)
    class_counts = np.zeros(CLASSES)
    own = held_counts[:OWN_CLASSES]
    class_counts[: len(own)], class_counts[OWN_CLASSES:END], class_counts[END] = own, totals[:, 0], texts
    network = Network.start(class_counts)
    first = F.pmod(F.xxhash64("text"), F.lit(FIRST_SHARE)) == 0
    for part in (docs.filter(first), docs):
        network = _trained(part, network, held, class_counts)
    # An unknown word of each ending is one word more.
    class_totals = totals.sum(axis=1) + 1
    log_totals = _normalisers(docs.sparkSession, network)
    return ScoringModel(held, held_counts, class_totals, network, log_totals, counts, n_words + texts, n_distinct, texts)


def score_texts(docs: DataFrame, model: ScoringModel, held_out: Column | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    Tokens are the words of the text, A-Z lower-cased, and one end; null and
    empty texts have the end alone. ``base_score`` is the sum of the decimal
    logarithms of (c + 1) / (N + V + 1); ``score`` is the model's decimal
    logarithm of the text's probability. Repeated rows and ids each give a row,
    null ids too; other columns are ignored. ``held_out`` is only passed on.

    Texts are read in pieces of two megabytes; a longer one goes whole, its
    tokens in runs. Words beyond the held ones are looked up by a join, one row
    per word of a text; such words are rare, or unknown, and AQE splits one that
    is not.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(
        (model.held, model.held_counts, model.class_totals, model.network.pack(), model.log_totals, model.n_texts)
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_counts, class_totals, packed, log_totals, texts = shared.value
        net, known = Network.unpack(packed), pa.array(held, pa.large_string())
        near, far = (net.context @ place @ net.target.T for place in net.places)
        log_held = np.append(np.log10(held_counts + 1), 0.0)
        # What a class of one ending costs each of its words; own classes cost nothing.
        inside = np.concatenate([np.zeros(OWN_CLASSES), np.log10(class_totals), [0.0]])
        for batch in batches:
            for piece in pieces(batch, "text"):
                found = Words.of(piece.column("text"))
                at = _held(found.words, known)
                classes = found.classes(at)
                tokens, first, second, begins = found.contexts(classes)
                logs = np.empty(len(tokens))
                for start in range(0, len(tokens), _TOKENS_AT_ONCE):
                    cut = slice(start, start + _TOKENS_AT_ONCE)
                    t, f, s = tokens[cut], first[cut], second[cut]
                    logs[cut] = near[f, t] + far[s, t] + net.bias[t] - log_totals[s, f]
                log_classes = np.add.reduceat(logs, begins) / np.log(10) if len(begins) else logs
                bounds = np.concatenate(([0], np.cumsum(found.per_text)))

                def summed(values):
                    whole = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
                    return whole[bounds[1:]] - whole[bounds[:-1]]

                own = (at >= 0) & (at < OWN_CLASSES)
                log_counts = summed(log_held[at])
                log_classes += summed(np.where(own, 0.0, log_held[at]) - inside[classes])
                other = at < 0
                places = np.concatenate(([0], np.cumsum(other)))[bounds].astype(np.int32)
                others = found.words.filter(pa.array(other)).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("held_out"),
                        pa.array(found.per_text + 1),
                        pa.array(found.per_text - np.diff(places) + (texts > 0)),
                        pa.array(log_counts + np.log10(texts + 1)),
                        pa.array(log_classes),
                        pa.ListArray.from_arrays(pa.array(places), others),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_held", "log_counts", "log_classes", "others"],
                )

    held_out = F.lit(None).cast("boolean") if held_out is None else held_out
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    schema = _SCORED.format(id=rows.schema["doc_id"].dataType.simpleString())
    scored = rows.mapInArrow(score, schema).withColumn("_row", F.monotonically_increasing_id())
    scored = materialise(scored, "scored")
    words = scored.select("_row", F.explode("others").alias("word"))
    counts = model.counts.select("word", "n")
    looked_up = words.join(counts, "word", "left").groupBy("_row").agg(
        F.sum(F.log10(F.coalesce(F.col("n"), F.lit(0)) + 1)).alias("_logs"), F.count("n").alias("_known")
    )
    per_token = float(np.log10(model.n_tokens + model.n_distinct + 1))
    logs = F.coalesce(F.col("_logs"), F.lit(0.0))
    return scored.drop("others").join(looked_up, "_row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_held") + F.coalesce(F.col("_known"), F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + logs - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("log_classes") + logs).alias("score"),
    )


def train_on_rest(docs: DataFrame, held_out: int = 2, parts: int = 7) -> ScoringModel:
    """The model of all documents that are not held out."""
    return train(docs.filter(remainder(parts=parts) != held_out))
