import math
import random
import re

import pytest
import xxhash
from small import AWKWARD, docs_of, prose, saved

import corpus_pipeline
from aerocell.llm import bands, near_dedup
from aerocell.llm.components import components
from aerocell.llm.near_dedup import near_duplicates, near_links, one_of_each
from aerocell.llm.queries import QUERIES


def edited(text, seed, edits):
    pick, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"new{pick.randrange(99)}"
    return " ".join(words)


LONG = prose(7, 600)
TEXTS = AWKWARD + [
    LONG,
    LONG.upper(),
    LONG + " tail",
    *(edited(LONG, i, 1 + i % 4) for i in range(12)),
    prose(8, 500),
    "ÄÖ Straße É one",
    "äÖ straße É one",
    "two words",
    "one",
    "ONE\x0b",
    "\x0c \x0b",
]


def simhash(text, size=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if sum(x >> k & 1 for x in h) * 2 > len(h))


def grouped(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_query_equals_brute_force(spark, tmp_path):
    rows = {r.doc_id: r for r in QUERIES["op5_simhash_near_dedup"](spark, saved(spark, tmp_path, TEXTS)).collect()}
    prints = [simhash(t) for t in TEXTS]
    n = range(len(TEXTS))
    links = [(i, j) for i in n for j in n if i < j and (prints[i] ^ prints[j]).bit_count() <= 3]
    want = grouped(links, n)
    assert len(links) > 40
    for i in n:
        assert (rows[i].fingerprint, rows[i].component_id) == (f"{prints[i]:016x}", want[i])


@pytest.mark.parametrize("radius, words, parts", [(3, 1, 2), (2, 1, 2), (0, 1, 2), (7, 2, 2), (11, 2, 3), (5, 1, 3)])
def test_all_pairs_within_the_radius(spark, radius, words, parts):
    pick = random.Random(radius)
    bits = 64 * words
    prints = [pick.getrandbits(bits) for _ in range(40)]
    for p in list(prints):
        for flips in range(1, radius + 3):
            prints.append(p ^ sum(1 << k for k in pick.sample(range(bits), flips)))
    prints += [0, (1 << bits) - 1, 1 << (bits - 1)]
    prints = sorted(set(prints))
    names = [f"f{i}" for i in range(words)]
    split = [[(p >> 64 * i) % 2**64 for i in range(words)] for p in prints]
    rows = [tuple(x - 2**64 if x >> 63 else x for x in part) for part in split]
    df = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))
    found = near_links(df, names, radius, parts).collect()

    def number(node):
        if words == 1:
            return node % 2**64
        return sum(int(node[16 * i : 16 * i + 16], 16) << 64 * i for i in range(words))

    got = {frozenset((number(r.a), number(r.b))) for r in found}
    want = {frozenset((a, b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= radius}
    assert got == want


def test_components_equal_union_find(spark):
    pick = random.Random(3)
    nodes = list(range(300))
    links = [(pick.choice(nodes), pick.choice(nodes)) for _ in range(170)]
    links += [(1000 + i, 1001 + i) for i in range(200)] + [(2000, 2001 + i) for i in range(100)] + [(5, 5), (7, None)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    real = [(a, b) for a, b in links if b is not None and a != b]
    want = grouped(real, {n for e in real for n in e})
    assert got == want
    assert components(df.limit(0)).collect() == []


def test_ids_rows_and_columns(spark):
    rows = [(None, "a b c d"), (4, "a b c d"), (2, "x y z"), (2, "x y z"), (None, "lonely words here"), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS f0", "2 AS n_rows", "'c' AS component_id")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in near_duplicates(docs).collect())
    assert got == [("2", "2"), ("2", "2"), ("4", "4"), ("9", "9"), ("None", "4"), ("None", "None")]
    assert near_duplicates(docs.limit(0)).collect() == []


def test_one_document_of_each_group_stays(spark):
    options = dict(size=1, words=2, parts=3, distinct_words=True, radius=24, similarity=0.8)
    docs = docs_of(spark, [LONG, LONG, edited(LONG, 1, 4), prose(8, 500), None, "", edited(prose(8, 500), 2, 60), "one two"])
    kept = one_of_each(docs, **options)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 6, 7]


def test_similarity_is_verified(spark):
    # The same words in another order have the same word set but share no shingle.
    words = prose(11, 200).split()
    other = words[::-1] + ["more"]
    docs = docs_of(spark, [" ".join(words), " ".join(other)])
    options = dict(size=1, words=2, parts=3, distinct_words=True, radius=11)
    assert len({r.component_id for r in near_duplicates(docs, **options).collect()}) == 1
    assert len({r.component_id for r in near_duplicates(docs, similarity=0.8, **options).collect()}) == 2


def block_edited(text, seed, similarity, kind):
    """``text`` with a new tail, without its tail or with a new block inside, at least as similar in five-word shingles."""
    words, fresh = text.split(), [f"{seed}x{i}" for i in range(len(text.split()))]
    n = len(words) - 4
    if kind == "appended":
        return " ".join(words + fresh[: int(n / similarity - n)])
    if kind == "truncated":
        return " ".join(words[: 4 + math.ceil(similarity * n)])
    # k new words inside spoil k + 4 shingles on either side.
    k = int(n * (1 - similarity) / (1 + similarity)) - 4
    return " ".join(words[:60] + fresh[:k] + words[60 + k :])


def word_shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_block_edits_are_found(spark):
    texts, seed = [], 0
    for kind in ("appended", "truncated", "replaced"):
        for similarity in (0.8, 0.85, 0.9, 0.95):
            for _ in range(12):
                seed += 1
                base = prose(seed, 204, 20000)
                texts += [base, block_edited(base, seed, similarity, kind)]
                a, b = map(word_shingles, texts[-2:])
                assert similarity <= len(a & b) / len(a | b) < similarity + 0.02
    kept = one_of_each(docs_of(spark, texts), similarity=0.8, similarity_words=5)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, len(texts), 2))


def test_stage_finds_block_edits(spark):
    texts = []
    for seed in range(40):
        base = prose(seed, 404, 20000)
        texts += [base, block_edited(base, seed, 0.8, "appended")]
    kept = corpus_pipeline.near_dedup(spark, docs_of(spark, texts), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 80, 2))


def test_equal_word_sets_are_verified(spark):
    words = prose(11, 200).split()
    shifted = words[100:] + words[:100]
    # The same word set throughout; the cyclic shift alone shares most shingles with the text.
    texts = [" ".join(words), " ".join(words[::-1]), " ".join(shifted), "yes no no", "no yes", "NO  yes"]
    options = dict(size=1, words=2, parts=3, distinct_words=True, radius=24, similarity=0.8)
    rows = {r.doc_id: r for r in near_duplicates(docs_of(spark, texts), **options).collect()}
    assert rows[0].fingerprint == rows[1].fingerprint and rows[3].fingerprint == rows[4].fingerprint
    assert [rows[i].component_id for i in range(6)] == [0, 1, 0, 3, 4, 4]
    kept = corpus_pipeline.near_dedup(spark, docs_of(spark, texts), "")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 3, 4]


def test_any_member_of_a_word_set_links(spark):
    # Texts 0 and 1 have one word set; only text 1, not the least id, is like text 2.
    words = prose(12, 200).split()
    texts = [" ".join(words[::-1]), " ".join(words), " ".join(words + ["more", "words"])]
    options = dict(size=1, words=2, parts=3, distinct_words=True, radius=24, similarity=0.8)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs_of(spark, texts), **options).collect()}
    assert got == {0: 0, 1: 1, 2: 1}


def test_stage_goes_through_deletion_variants(spark, monkeypatch):
    # Without any bands, near fingerprints alone bring texts that are 0.8-similar together, and only those.
    none = near_dedup.band_members
    monkeypatch.setattr(near_dedup, "band_members", lambda *a: none(*a).limit(0))
    base, other = prose(21, 900), prose(22, 300)
    near = [edited(base, i, 1) for i in range(12)]
    texts = [base, *near, other, "yes no no", "no yes", "NO  yes", " ".join(other.split()[::-1]), other + " " + other, None, ""]
    prints = [simhash(t) for t in texts]
    sets = [word_shingles((t or "").lower()) or {(t or "").lower()} for t in texts]
    n = range(len(texts))
    links = [
        (i, j) for i in n for j in n
        if i < j and (prints[i] ^ prints[j]).bit_count() <= 3 and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    ]
    want = grouped(links + [(15, 16), (len(texts) - 2, len(texts) - 1)], n)
    kept = corpus_pipeline.near_dedup(spark, docs_of(spark, texts), "")
    assert len(links) > 10 and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_near_links_of_different_groups(spark):
    rows = [(0, 1), (0, 2), (1, 1), (7, 3), (1 << 40, 2)]
    df = spark.createDataFrame(rows, "f0 long, _root long")
    got = {frozenset(((r.a, r.a_root), (r.b, r.b_root))) for r in near_links(df, ["f0"], 3, apart="_root").collect()}
    n = range(len(rows))
    want = {
        frozenset((rows[i], rows[j])) for i in n for j in n
        if i < j and rows[i][1] != rows[j][1] and 0 < (rows[i][0] ^ rows[j][0]).bit_count() <= 3
    }
    assert got == want


def test_a_large_group_of_far_copies_hands_few_pairs_on(spark, monkeypatch):
    # Texts that share bands with many others, and with none a similarity of 0.8.
    base, texts, made, across = prose(7, 300).split(), [], [], bands._across
    for i in range(60):
        pick, own = random.Random(i), list(base)
        for _ in range(12):
            own[pick.randrange(len(own))] = f"n{i}"
        texts.append(" ".join(own))

    def counted(*args):
        pairs = across(*args)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(bands, "_across", counted)
    assert one_of_each(docs_of(spark, texts), similarity=0.8).count() == 60
    assert made and sum(made) < 60


def test_listed_variants_are_never_broadcast(spark):
    # Some tens of keys for each fingerprint: Spark sizes them like the fingerprints alone.
    prints = spark.range(500).selectExpr("xxhash64(id) AS f0", "id AS _root")
    for links in (near_links(prints.select("f0"), ["f0"], 3), near_links(prints, ["f0"], 3, apart="_root")):
        plan = links._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
