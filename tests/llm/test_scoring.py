import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from small import AWKWARD, docs_of, prose, saved

from aerocell.llm import scoring
from aerocell.llm.queries import QUERIES
from aerocell.llm.scoring import CLASSES, END, OWN_CLASSES, SHARED_CLASSES, Network, Trainer, Words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens_of(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)) + [None]


def brute(texts):
    """``(held_out, n_tokens, n_known, train_tokens, base_score)`` of every text."""
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    counts = Counter(t for text, h in zip(texts, held) if not h for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for text, h in zip(texts, held):
        own = tokens_of(text)
        base = math.fsum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        out.append((h, len(own), sum(counts[t] > 0 for t in own), n, base))
    return out


def two_languages(number, words=60):
    """Texts of two vocabularies that share no word: the last words tell much about the next."""
    own = [[f"{c}{i}{'ab' if c == 'x' else 'yz'}" for i in range(300)] for c in "xw"]
    pick = random.Random(5)
    return [" ".join(pick.choices(own[i % 2], k=words)) for i in range(number)]


TEXTS = AWKWARD + ["İstanbul ÄÖ ABC abc", "x" * 70 + " once", "x" * 70] + [prose(i, i * 3 % 80) for i in range(200)] + two_languages(60)


@pytest.mark.parametrize("held_words", [scoring.HELD_WORDS, 40])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, held_words):
    monkeypatch.setattr(scoring, "HELD_WORDS", held_words)
    rows = {r.doc_id: r for r in QUERIES["op13_lm_scoring"](spark, saved(spark, tmp_path, TEXTS)).collect()}
    assert len(rows) == len(TEXTS)
    for i, (held_out, n_tokens, n_known, n, base) in enumerate(brute(TEXTS)):
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n_tokens, n_known, n), i
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0


@pytest.fixture(scope="module")
def model(spark):
    return scoring.train(docs_of(spark, two_languages(3000)))


def test_probabilities_of_a_context_sum_to_one(spark, model):
    known = {r.word: r for r in model.counts.collect()}
    context = ["x1ab x2ab", "w5yz", "", "never seen", "x7ab w8yz never"]
    # An unknown word of every ending.
    some = [c for c in map(chr, range(1, 0x250)) if not "A" <= c <= "Z" and c not in " \t\n\x0b\x0c\r"]
    pairs = [a + b for a in some for b in some]
    unknown = list({int.from_bytes(p.encode()[-2:], "big") % SHARED_CLASSES: p for p in pairs}.values())
    assert len(unknown) == SHARED_CLASSES
    for before in context:
        words = [*known, *unknown]
        texts = [f"{before} {w}" for w in words] + [before]
        rows = {r.doc_id: r.score for r in scoring.score_texts(docs_of(spark, texts), model).collect()}
        # Of a text and its own beginning, an end apart: the probability of the next word.
        ends = scoring_of_end(model, texts)
        ended = ends.pop()
        total = sum(10 ** (rows[i] - e - (rows[len(words)] - ended)) for i, e in enumerate(ends))
        assert total + 10**ended == pytest.approx(1, rel=1e-3)


def scoring_of_end(model, texts):
    """Logarithm of the end of each text after its last two words, straight from the network."""
    found = Words.of(pa.array(texts))
    classes = found.classes(scoring._held(found.words, pa.array(model.held, pa.large_string())))
    tokens, first, second, begins = found.contexts(classes)
    net, out = model.network, []
    for at in np.flatnonzero(tokens == END):
        guess = net.context[first[at]] @ net.places[0] + net.context[second[at]] @ net.places[1]
        scores = (net.target @ guess + net.bias).astype(np.float64)
        out.append((scores[END] - np.log(np.exp(scores).sum())) / np.log(10))
    return out


def test_held_out_texts_are_likelier_than_by_counts(spark, model):
    rows = scoring.score_texts(docs_of(spark, two_languages(3040)[3000:]), model).agg(F.sum("score"), F.sum("base_score")).first()
    # Of two vocabularies one is left: log10(2) a token at most, and a good part of it after one pass.
    assert rows[0] > rows[1] + 0.12 * 40 * 61


def test_training_finds_what_follows():
    counts = np.zeros(CLASSES)
    counts[:8] = 1000
    trainer = Trainer(Network.start(counts), counts, 1)
    cycle = np.tile(np.arange(8), 4000)
    for _ in range(4):
        trainer.learn(cycle[2:], cycle[1:-1], cycle[:-2])
    totals = trainer.network.log_totals(np.arange(8))
    net = trainer.network
    for c in range(8):
        guess = net.context[(c + 1) % 8] @ net.places[0] + net.context[c] @ net.places[1]
        likely = np.exp(net.target @ guess + net.bias - totals[c, (c + 1) % 8])
        assert likely.sum() == pytest.approx(1, rel=1e-4) and likely[(c + 2) % 8] > 0.9


def test_averages_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(scoring, "FAN_IN", 3)
    own = np.random.default_rng(1)
    arrays = [own.normal(size=5).astype(np.float32) for _ in range(20)]
    blobs = spark.createDataFrame([(i, float(i % 4 + 1), a.tobytes()) for i, a in enumerate(arrays)], scoring._BLOB)
    want = np.average(arrays, axis=0, weights=[i % 4 + 1 for i in range(20)])
    assert np.allclose(scoring._averaged(blobs, 20), want, atol=1e-6)
    assert scoring._averaged(blobs.limit(0), 20) is None


def test_no_rows_and_clashing_columns(spark):
    docs = docs_of(spark, ["a b", None]).selectExpr("*", "1 AS word", "2 AS n", "3 AS others", "4 AS _row")
    none = docs.filter("false")
    model = scoring.train(none)
    rows = {r.doc_id: r for r in scoring.score_texts(docs, model).collect()}
    assert rows[0].n_tokens == 3 and rows[0].n_known == 0 and rows[0].train_tokens == 0 and rows[0].base_score == 0
    assert math.isfinite(rows[0].score) and rows[0].held_out is None
    assert scoring.score_texts(none, scoring.train(docs)).collect() == []
    twice = docs.union(docs).withColumn("doc_id", F.lit(None).cast("long"))
    scores = [r.score for r in scoring.score_texts(twice, scoring.train(docs)).collect()]
    assert len(scores) == 4 and len(set(scores)) == 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \t\n\x0b\x1c\x85　ß漢", max_size=9)), max_size=6))
def test_words(texts):
    found = Words.of(pa.array(texts, pa.string()))
    want = [tokens_of(t)[:-1] for t in texts]
    assert found.words.to_pylist() == [w for ws in want for w in ws]
    assert found.per_text.tolist() == [len(ws) for ws in want]
    for word, ending in zip(found.words.to_pylist(), found.ending.tolist()):
        data = word.encode()[-2:]
        assert ending == int.from_bytes(data, "big") % SHARED_CLASSES
    tokens, first, second, begins = found.contexts(np.arange(len(found.words), dtype=np.int64) % OWN_CLASSES)
    at = 0
    for i, words in enumerate(want):
        assert begins[i] == at
        own = [END, END, *range(sum(map(len, want[:i])), sum(map(len, want[: i + 1]))), END]
        for j in range(2, len(own)):
            assert (tokens[at], first[at], second[at]) == (own[j], own[j - 1], own[j - 2])
            at += 1
    assert at == len(tokens)


def test_a_text_of_three_megabytes(spark, monkeypatch):
    monkeypatch.setattr(scoring, "_TOKENS_AT_ONCE", 1000)
    texts = [prose(1, 500_000, 3000), "x" * 3_000_000, prose(2, 50)]
    docs = docs_of(spark, texts)
    rows = {r.doc_id: r for r in scoring.score_texts(docs, scoring.train(docs)).collect()}
    counts = Counter(t for text in texts for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    for i, text in enumerate(texts):
        own = tokens_of(text)
        assert (rows[i].n_tokens, rows[i].n_known, rows[i].train_tokens) == (len(own), len(own), n)
        assert rows[i].base_score == pytest.approx(math.fsum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own), rel=1e-9)
        assert math.isfinite(rows[i].score)
