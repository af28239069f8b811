import numpy as np
import pytest
from small import AWKWARD, docs_of, prose, saved

from aerocell.llm import quality
from aerocell.llm.queries import QUERIES


def junk(kind, seed):
    words = prose(seed, 40 + seed).split()
    if kind == 0:
        return " ".join(w + "#$%"[i % 3] * 3 for i, w in enumerate(words))
    if kind == 1:
        return " | ".join(words)
    if kind == 2:
        return " ".join(w.upper() + "!!" for w in words)
    return " ".join(w for w in words for _ in range(6))


def clean(seed):
    words = prose(seed, 60 + seed).split()
    return ". ".join(" ".join(words[i : i + 9]).capitalize() for i in range(0, len(words), 9)) + "."


TEXTS = [clean(i) for i in range(120)] + [junk(i % 4, i) for i in range(40)]


@pytest.fixture(scope="module")
def model(spark):
    return quality.train(docs_of(spark, TEXTS))


def test_query_separates_junk(spark, tmp_path):
    texts = TEXTS + AWKWARD
    rows = {r.doc_id: r for r in QUERIES["op3_quality"](spark, saved(spark, tmp_path, texts)).collect()}
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows.values())
    assert all(rows[i].keep == (i < 120) for i in range(160))
    for i in (160, 161, 162):  # null, empty and blank
        assert (rows[i].score, rows[i].weak_label, rows[i].keep) == (0, 0, False)


def test_accuracy_on_given_labels(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op3_quality"](spark, sf).join(labels, "doc_id").collect()
    assert len(rows) > 50 and np.mean([r.keep == (r.quality == 1) for r in rows]) > 0.95


def test_votes_equal_brute_force(spark, model):
    got = quality.score_quality(docs_of(spark, TEXTS + AWKWARD), model).collect()
    for r in got:
        text = (TEXTS + AWKWARD)[r.doc_id] or ""
        words = [w for w in quality.np.array(text.encode().translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" "), object) if w]
        n = max(len(words), 1)
        signs = [b for w in words for b in w if quality._SIGN[b]]
        measures = {
            "signs": len(signs) / max(sum(map(len, words)), 1),
            "sign_ends": sum(quality._SIGN[w[-1]] for w in words) / n,
            "bars": text.count("|") / n,
            "capitals": sum("A" <= c <= "Z" for c in text) / max(sum(quality._LETTER[b] for b in text.encode()), 1),
            "shouts": text.count("!") / n,
            "repeats": sum(a == b for a, b in zip(words, words[1:])) / n,
            "echoes": sum(a == b for a, b in zip(words, words[2:])) / n,
        }
        want = ""
        for x in quality.LABELLERS:
            if x.vote == quality.BAD:
                fires = all(measures[m] >= bound for m, bound in x.bounds)
            else:
                fires = all(measures[m] <= bound for m, bound in x.bounds)
            want += "bg"[x.vote] if fires and len(words) >= x.least_words else "-"
        assert r.votes == want, text[:80]


def test_label_model_finds_the_accuracies():
    random_ = np.random.default_rng(5)
    truth = random_.random(40_000) < 0.7
    accuracy, speaks = np.array([0.9, 0.75, 0.85, 0.65, 0.95]), np.array([0.8, 0.9, 0.5, 0.7, 0.3])
    right = random_.random((len(truth), 5)) < accuracy
    votes = np.where(random_.random(right.shape) < speaks, (right == truth[:, None]).astype(int), quality.ABSTAIN)
    patterns, counts = np.unique(quality._pattern(votes), return_counts=True)
    found = quality.fit_labellers(quality._unpacked(patterns, 5), counts)
    assert np.abs(found.accuracy - accuracy).max() < 0.03 and abs(found.prior - 0.7) < 0.02
    assert np.mean((found.posterior(votes) > 0.5) == truth) > 0.9


def test_scorer_generalises():
    random_ = np.random.default_rng(2)
    x = np.sqrt(random_.dirichlet(np.ones(50), 400)).astype(np.float32)
    goal = random_.normal(size=50)
    labels = (x @ goal > np.median(x @ goal)).astype(float)
    scorer = quality.fit_scorer(x[:300], labels[:300])
    assert np.mean((scorer.score(x[300:]) > 0.5) == labels[300:]) > 0.85


def test_same_model_for_any_partitioning(spark, model):
    other = quality.train(docs_of(spark, TEXTS).repartition(7))
    assert np.array_equal(other.labels.accuracy, model.labels.accuracy)
    assert np.allclose(other.scorer.weights, model.scorer.weights, atol=1e-5)


def test_sample_is_bounded_but_counts_are_not(spark):
    texts = TEXTS * 3 + [clean(200 + i) for i in range(200)]
    small = quality.train(docs_of(spark, texts), sample_rows=250)
    rows = quality.score_quality(docs_of(spark, TEXTS), small).collect()
    assert np.mean([(r.score > 0.5) == (r.doc_id < 120) for r in rows]) > 0.9


def test_empty_table_and_clashing_columns(spark, model):
    docs = docs_of(spark, ["some words here", None]).selectExpr("*", "1 AS score", "2 AS votes", "3 AS pattern")
    assert len(quality.score_quality(docs, model).collect()) == 2
    nothing = quality.train(docs.limit(0))
    assert quality.score_quality(docs.limit(0), nothing).collect() == []
    assert all(0 <= r.score <= 1 for r in quality.score_quality(docs, nothing).collect())
