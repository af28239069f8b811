import base64
import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from small import AWKWARD, docs_of, prose, saved

from aerocell.llm import bpe
from aerocell.llm.lengths import at_limit, context_limits, length_histogram, length_quantiles
from aerocell.llm.queries import QUERIES, VOCABULARY

PATTERN = public_tokenizers.PATTERN
TEXTS = AWKWARD + [
    prose(1, 400),
    "I'll don't we've  12 345 ½ Ⅷ    tabs\t\tand   spaces ",
    "<|endoftext|> ▁▁ Ġ Āā",
    "日本語のテキスト и русский עברית",
    "a" * 3001,
    "ab" * 20_000,
]


@pytest.fixture(scope="module")
def exact():
    lines = [x.split() for x in open(VOCABULARY, "rb") if x.strip()]
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_equals_tiktoken(spark, tmp_path, exact):
    rows = {r.doc_id: r for r in QUERIES["op9_byte_bpe"](spark, saved(spark, tmp_path, TEXTS)).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = exact.encode_ordinary(text or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest() and rows[i].whole


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.load(VOCABULARY, PATTERN)


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_any_text(exact, tokenizer, text):
    (packed,) = tokenizer.encode_packed([text])
    ids = list(struct.unpack(f"<{len(packed) // 4}I", packed))
    assert ids == exact.encode_ordinary(text) and tokenizer.decode(ids) == text.encode()


def test_table_that_starts_anew(exact, tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_MATCHES", 50)
    monkeypatch.setattr(tokenizer, "known", {})
    texts = [prose(i, 60) for i in range(20)]
    for text in texts + texts:
        (packed,) = tokenizer.encode_packed([text])
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == exact.encode_ordinary(text)
        assert len(tokenizer.known) <= 50


def test_sparse_ranks(tmp_path):
    ranks = {bytes([b]): 3 * b for b in range(256)} | {b"ab": 1000, b"abc": 5000, b"bc": 900}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    exact = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokenizer = bpe.load(str(path), PATTERN)
    for text in ["abc", "abcabc", "xabcx bc", "ab"]:
        (packed,) = tokenizer.encode_packed([text])
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == exact.encode_ordinary(text)


def test_encode_then_decode(spark, exact):
    docs = docs_of(spark, TEXTS).selectExpr("*", "0 AS ids", "'x' AS data")
    ids = bpe.encode(docs, VOCABULARY, PATTERN)
    assert {r.doc_id: list(r.ids) for r in ids.collect()} == {i: exact.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    back = {r.doc_id: bytes(r.data).decode() for r in bpe.decode(ids, VOCABULARY, PATTERN).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    assert bpe.encode(docs.limit(0), VOCABULARY, PATTERN).collect() == []


def test_limits_equal_brute_force(spark, tmp_path, exact):
    texts = TEXTS + [prose(i, i * 7 % 90) for i in range(60)]
    lengths = [len(exact.encode_ordinary(t or "")) for t in texts]
    rows = QUERIES["op2_token_counts"](spark, saved(spark, tmp_path, texts)).collect()
    assert sorted(r.length for r in rows) == sorted(set(lengths))
    for r in rows:
        assert r.n_docs == lengths.count(r.length)
        assert r.docs_longer == sum(n > r.length for n in lengths) == len(lengths) - r.docs_within
        assert r.tokens_longer == sum(n for n in lengths if n > r.length) == sum(lengths) - r.tokens_within
        assert r.truncated_tokens == sum(min(n, r.length) for n in lengths) == sum(lengths) - r.lost_tokens
        assert r.quantile == r.docs_within / len(lengths)


def test_grouped_limits_and_quantiles(spark):
    rows = [("a", n) for n in (0, 3, 3, 5000, 70_000)] + [(None, n) for n in (2, 1025)] + [("b", None)]
    lengths = spark.createDataFrame(rows, "source string, n_tokens long")
    limits = context_limits(length_histogram(lengths, ("source",)), ("source",))
    groups = {g: [n or 0 for s, n in rows if s == g] for g, _ in rows}
    for limit in (0, 1, 4, 5000, 10**6):
        for r in at_limit(limits, limit, ("source",)).collect():
            own = groups[r.source]
            assert r.truncated_tokens == sum(min(n, limit) for n in own)
            assert r.docs_within == sum(n <= limit for n in own)
    got = {(r.source, r.share): r.length for r in length_quantiles(limits, (0.5, 1.0), ("source",)).collect()}
    assert got[("a", 0.5)] == 3 and got[("a", 1.0)] == 70_000 and got[(None, 0.5)] == 2 and got[("b", 1.0)] == 0
    assert context_limits(length_histogram(lengths.limit(0))).collect() == []
