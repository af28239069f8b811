import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from small import AWKWARD, docs_of, prose, saved

from aerocell.llm import pii
from aerocell.llm.pii_examples import EXAMPLES
from aerocell.llm.queries import QUERIES

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = AWKWARD + [
    "mail a.b@c.de, x@y, @z.com a@b@c.org, ü@ö.de p+q%r@s-t.u.v.",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 5500005555555559",
    "+1 (017) 555-7713 +49 30 1234567. + 1 555 +1 2 +12345678901234567 555-0188",
    "漢字 a@b.co \U0001f600 10.0.0.1 +1 (017) 555-7713",
    "token = \"2abc3ff2ca8fb1e4c565a0eb63815530a948bdde\" a1b2@c3.d4",
    "1" * 6000 + " " + "1." * 3000,
    "+1" + " " * 5000 + "+1-" * 2000,
    "x@" * 3000,
    "please call (212) 555-0188 or a@b.org\nher ssn is 078-05-1120",
    prose(5, 3000),
]


def brute(text):
    text = text or ""
    found = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip":
                ok = all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))
            elif kind == "card":
                ok = 12 <= len(digits) <= 19 and luhn(digits)
            else:
                ok = kind == "email" or 9 <= len(digits) <= 15
            if ok:
                found.append((m.start(), place, m.end(), kind))
    return sorted(found)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def test_query_equals_brute_force(spark, tmp_path):
    rows = {r.doc_id: r for r in QUERIES["op8_pii"](spark, saved(spark, tmp_path, TEXTS)).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        want = brute(text)
        shown = [f"{k}:{s}:{e}" for s, _, e, k in want]
        assert rows[i].base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest(), text
        assert [rows[i][f"n_{k}"] for k in PATTERNS] == [sum(x[3] == k for x in want) for k in PATTERNS]
        every = rows[i].spans.split(",") if rows[i].spans else []
        assert [x for x in every if x in shown] == shown
        assert every == sorted(every, key=lambda x: (int(x.split(":")[1]), pii.KINDS.index(x.split(":")[0])))
    more = rows[TEXTS.index(TEXTS[-2])].spans
    assert more == "phone:12:26,email:30:37,id:49:60"


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.-+ 19()_%0\né", max_size=60))
def test_base_spans_of_any_text(text):
    assert pii.base_spans(text) == [x[:3] for x in brute(text)]


@pytest.fixture(scope="module")
def field():
    return pii.train()


def added(field, text):
    piece = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([text])], names=["doc_id", "text"])
    return sorted((s, e, pii.KINDS[k]) for (s, k, e), base in pii._spans(piece, field)[0] if not base)


def test_field_knows_its_examples(field):
    for line in EXAMPLES:
        text, spans = pii._example(line)
        assert added(field, text) == sorted(spans), text


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("reach me by phone (646) 555-0177 tonight", "phone", "(646) 555-0177"),
        ("tel 030 5550 7788", "phone", "030 5550 7788"),
        ("his ssn: 123-45-6789, he said", "id", "123-45-6789"),
        ("contact erika.muster(at)firma.example now", "email", "erika.muster(at)firma.example"),
        ("on 2023-11-30 they sold 120 of 450 units", None, None),
        ("pages 10-12 and 300-310 of volume 2", None, None),
    ],
)
def test_field_on_unseen_lines(field, text, kind, part):
    want = [(text.index(part), text.index(part) + len(part), kind)] if part else []
    assert added(field, text) == want


def test_clean_documents_gain_nothing(spark, sf, field):
    found = pii.find_personal_data(spark.read.parquet(f"{sf}/documents.parquet"), field)
    assert found.selectExpr("size(filter(spans, x -> not x.base)) n").agg({"n": "sum"}).first()[0] == 0


def test_viterbi_equals_brute_force():
    random_ = np.random.default_rng(1)
    lengths, k = [1, 4, 2, 5, 1, 3], 3
    chain = np.repeat(np.arange(len(lengths)), lengths)
    emit, step = random_.normal(size=(len(chain), k)), random_.normal(size=(k, k))
    got = pii.viterbi(emit, chain, step)
    for c, n in enumerate(lengths):
        own = emit[chain == c]

        def score(path):
            return sum(own[i, y] for i, y in enumerate(path)) + sum(step[a, b] for a, b in zip(path, path[1:]))

        assert tuple(got[chain == c]) == max(itertools.product(range(k), repeat=n), key=score)


def test_words_and_hidden_columns(spark, field):
    docs = docs_of(spark, ["a@b.de", None]).selectExpr("*", "1 AS spans", "2 AS base_sha256", "3 AS kind")
    assert [len(r.spans) for r in pii.find_personal_data(docs, field).orderBy("doc_id").collect()] == [1, 0]
    assert pii.find_personal_data(docs.limit(0), field).collect() == []
    twice = spark.createDataFrame([(None, "a@b.de"), (1, "x"), (1, "x")], "doc_id long, text string")
    assert len(pii.find_personal_data(twice, field).collect()) == 3
