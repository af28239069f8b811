import random
import zlib

import numpy as np
import pytest
from small import AWKWARD, docs_of, saved

from aerocell.llm import language
from aerocell.llm.queries import QUERIES

SYLLABLES = {"en": "th er ing the and ly wh sh".split(), "de": "sch ung ein pf ück zu ver ä".split(), "fr": "eau oi ç ètre que aux é ment".split()}


def written(name, seed, words):
    pick = random.Random(f"{name}{seed}")
    return " ".join("".join(pick.choices(SYLLABLES[name], k=pick.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus():
    names = [sorted(SYLLABLES)[i % 3] for i in range(90)]
    return [written(n, i, 20 + i) for i, n in enumerate(names)], names


@pytest.fixture(scope="module")
def model(spark, corpus):
    return language.train(docs_of(spark, *corpus))


def test_query_on_held_out_documents(spark, tmp_path, corpus):
    texts, names = corpus
    rows = QUERIES["op1_language_id"](spark, saved(spark, tmp_path, texts + AWKWARD, names + [None] * len(AWKWARD))).collect()
    assert len(rows) == len(texts) + len(AWKWARD)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        if r.doc_id < len(names):
            assert r.lang_pred == names[r.doc_id] and r.languages == names[r.doc_id]
        else:
            text = AWKWARD[r.doc_id - len(names)]
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))


def test_real_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = QUERIES["op1_language_id"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 50 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_held_out_labels_teach_nothing(spark, corpus):
    texts, names = corpus
    docs = docs_of(spark, texts, names)
    lied = docs.withColumn("lang", language.F.when(language.remainder() == 1, "xx").otherwise(language.F.col("lang")))
    a, b = language.train_on_rest(docs), language.train_on_rest(lied)
    assert a.languages == b.languages and np.array_equal(a.table, b.table)


def test_counts_equal_brute_force(spark):
    texts = ["Ab, ab", "é", ""]
    model = language.train(docs_of(spark, texts, ["x", "x", "x"]))
    counts = np.zeros(language.BUCKETS)
    for text in texts:
        folded = b" " + bytes(language._FOLD[b] for b in text.encode()) + b" "
        for i in range(1, len(folded) - 1):
            if folded[i] != 0x20:
                counts[(int.from_bytes(folded[i - 1 : i + 2]) * 0x9E3779B1 % 2**32) >> (32 - language.BITS)] += 1
    want = np.log(counts + 0.5) - np.log(counts.sum() + 0.5 * language.BUCKETS)
    assert counts.sum() == 6 and np.allclose(model.table[0], want, atol=1e-4)


def test_mixtures(spark, model):
    texts = [
        written("en", "a", 300) + " " + written("de", "a", 100),
        written("fr", "b", 200),
        written("fr", "b", 90) + "\n" + written("de", "c", 90) + "\n" + written("en", "c", 90),
        "7 8 9 + 10",
    ]
    one, two, three, none = language.infer(docs_of(spark, texts), model).orderBy("doc_id").collect()
    assert [x.lang for x in one.languages] == ["en", "de"] and abs(one.score - 0.75) < 0.05
    assert [x.lang for x in two.languages] == ["fr"] and two.score > 0.95
    assert {x.lang for x in three.languages} == set(SYLLABLES) and abs(three.score - 1 / 3) < 0.07
    assert (none.lang_pred, none.score, none.noise) == ("und", 0, 1)


def test_shares_equal_brute_force_em():
    random_ = np.random.default_rng(3)
    ratio, first = random_.random((40, 3)).astype(np.float32) + 0.01, np.array([0, 5, 6, 30])
    got = language._shares(ratio, first, np.full((4, 3), 1 / 3, np.float32))
    for i, (a, b) in enumerate(zip(first, [5, 6, 30, 40])):
        share = np.full(3, 1 / 3)
        for _ in range(language.ROUNDS):
            part = ratio[a:b] * share
            share = (part / part.sum(1, keepdims=True)).mean(0)
        assert np.allclose(got[i], share, atol=0.02)


def test_rejecting_keeps_every_column(spark, model):
    docs = docs_of(spark, [written("en", 1, 30), None, "12 34", "中" * 60], [None] * 4).selectExpr("*", "1 AS score", "array(doc_id) AS languages")
    kept = language.in_known_language(docs, model)
    assert kept.columns == docs.columns and kept.filter("doc_id = 0").collect() == docs.filter("doc_id = 0").collect()
    assert 0 in [r.doc_id for r in kept.collect()] and not {1, 2} & {r.doc_id for r in kept.collect()}


def test_empty_tables(spark, model):
    empty = docs_of(spark, ["a"]).limit(0)
    nothing = language.train(empty)
    assert nothing.languages == () and language.infer(empty, model).collect() == []
    (row,) = language.infer(docs_of(spark, ["words"]), nothing).collect()
    assert (row.lang_pred, row.score) == ("und", 0)
    with pytest.raises(ValueError):
        language.train(docs_of(spark, ["a"] * 130, [f"l{i}" for i in range(130)]))
