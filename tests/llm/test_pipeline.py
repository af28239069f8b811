import base64
import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from small import AWKWARD, docs_of, prose
from test_decontaminate import brute as brute_items
from test_language import written
from test_lines import brute as brute_lines
from test_lines import edited
from test_near_dedup import grouped

import corpus_pipeline
from aerocell.session import collected, list_folder

ITEMS = [(0, prose(300, 30)), (1, prose(301, 24))]
LONG = prose(310, 200)
TEXTS = AWKWARD + [
    *(written("en", i, 60) for i in range(6)),
    LONG,
    "12345 67 ++",
    # Near copies whose lines are cut differently, so that line dedup leaves them.
    LONG.replace(" ", "\n", 1),
    *("\n".join(" ".join(edited(LONG, i, 2).split()[j : j + 40 + 3 * i]) for j in range(0, 200, 40 + 3 * i)) for i in range(3)),
    f"{prose(320, 40)} {ITEMS[0][1]} {prose(321, 40)}",
    f"{prose(322, 30)} {ITEMS[1][1]}",
    prose(330, 120),
    prose(330, 120),
    f"{prose(331, 50)}\n{prose(332, 50)}",
]


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(texts, known):
    # Which short texts count as noise is the language model's own decision.
    kept = {i: t for i, t in enumerate(texts) if i in known}
    lost = brute_lines([kept.get(i) for i in range(len(texts))])
    kept = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in lost[i]) for i, t in kept.items()}
    sets = {i: shingles(t) for i, t in kept.items()}
    links = [
        (i, j) for i in kept for j in kept
        if i < j and (len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    ]
    root = grouped(links, kept)
    kept = {i: t for i, t in kept.items() if root[i] == i}
    hit = {list(kept)[i] for i, _ in brute_items(list(kept.values()), ITEMS)}
    return {i: t for i, t in kept.items() if i not in hit}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs_of(spark, TEXTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_equals_brute_force(spark, folder):
    lines = [x.split() for x in open(corpus_pipeline.VOCABULARY, "rb") if x.strip()]
    exact = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN,
        mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines}, special_tokens={},
    )
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, folder).collect()}
    want = brute(TEXTS, known)
    assert {i for i, t in enumerate(TEXTS) if len(t or "") > 300 and i > 10} <= known and 18 not in known
    assert len(want) > 10 and set(got) == set(want)
    for i, text in want.items():
        ids = exact.encode_ordinary(text)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_keep_the_columns_and_survive_no_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, docs.limit(0), folder)
        assert nothing.collect() == []
        assert name == "byte_bpe" or nothing.columns == docs.columns


def test_a_stage_leaves_nothing_behind(spark, folder):
    """Intermediate tables are there until the next stage begins, and gone after the run."""
    def left(made):
        return [f for f in made if list_folder(spark, f)]

    with collected() as made:
        result = corpus_pipeline.run(spark, folder)
    assert result.count() > 0 and len(made) > 20 and len(left(made)) == 1
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    with collected() as made:
        kept = corpus_pipeline.line_dedup(spark, docs, folder)
        assert kept.count() == docs.count() and len(left(made)) > 2
        # A frame that reads intermediate tables keeps them.
        assert corpus_pipeline.near_dedup(spark, kept, folder).count() > 0
    corpus_pipeline._release(spark, docs)
    assert left(made) == []
