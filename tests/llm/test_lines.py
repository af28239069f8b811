import pathlib
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F
from small import AWKWARD, docs_of, prose, saved

from aerocell.llm import bands, lines
from aerocell.llm.lines import duplicate_lines, without_duplicate_lines
from aerocell.llm.maps import bit_maps
from aerocell.llm.queries import QUERIES
from aerocell.session import materialise


def edited(line, seed, edits):
    pick, words = random.Random(seed), line.split()
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"n{seed}"
    return " ".join(words)


BASE, OTHER = prose(1, 60), prose(2, 40)
CHAIN = [" ".join(prose(5, 90).split()[i * 2 : i * 2 + 60]) for i in range(12)]
TEXTS = AWKWARD + [
    f"{BASE}\n{prose(3, 30)}\n\n{OTHER}",
    f"{prose(4, 20)}\n{edited(BASE, 1, 1)}\n{OTHER}\n{OTHER}",
    *(f"{edited(BASE, i, 1 + i % 3)}\n{prose(50 + i, 25)}" for i in range(8)),
    *CHAIN,
    "short\nshort\nshor\nab\nab",
    "漢字の行です。これは長い行です。\n漢字の行です。これは長い行です!",
    "  \n\t\n  ",
    prose(1, 60),
    f"{prose(60, 30)}\n{prose(61, 30)}",
]


def grams(line):
    return {line[i : i + 7] for i in range(len(line) - 6)} or {line}


def brute(texts):
    places = [(i, k, line) for i, t in enumerate(texts) if t is not None for k, line in enumerate(t.split("\n")) if line.strip(" \t\r\x0b\x0c")]
    distinct = sorted({line for _, _, line in places})
    root = {line: line for line in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {line: grams(line) for line in distinct}
    for a in distinct:
        for b in distinct:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[find(b)] = find(a)
    seen, dropped = set(), {i: [] for i in range(len(texts))}
    for i, k, line in places:
        if find(line) in seen:
            dropped[i].append(k)
        seen.add(find(line))
    return dropped


def test_query_equals_brute_force(spark, tmp_path):
    rows = {r.doc_id: r for r in QUERIES["op7_line_dedup"](spark, saved(spark, tmp_path, TEXTS)).collect()}
    want = brute(TEXTS)
    assert len(rows) == len(TEXTS) and sum(map(len, want.values())) > 20
    for i, text in enumerate(TEXTS):
        assert [int(x) for x in rows[i].dropped.split(",") if x] == want[i], i
        assert rows[i].n_dropped == len(want[i]) and rows[i].n_lines == (0 if text is None else text.count("\n") + 1)


def test_texts_without_duplicates(spark):
    docs = docs_of(spark, TEXTS).selectExpr("*", "1 AS node", "2 AS root", "3 AS n_lines", "array(4) AS dropped")
    kept = without_duplicate_lines(docs)
    assert kept.columns == docs.columns
    want = brute(TEXTS)
    for r in kept.collect():
        lines = None if TEXTS[r.doc_id] is None else TEXTS[r.doc_id].split("\n")
        assert r.text == (lines and "\n".join(x for k, x in enumerate(lines) if k not in want[r.doc_id]))
        assert r.node == 1 and r.dropped == [4]


@pytest.mark.parametrize("seed", range(2))
def test_many_near_copies(spark, seed):
    # One band holds all variants; they stay one component without all pairs.
    texts = [edited(prose(seed, 80), i, 1 + i % 2) for i in range(150)] + [prose(200 + i, 30) for i in range(50)]
    got = {r.doc_id: list(r.dropped) for r in duplicate_lines(docs_of(spark, texts)).collect()}
    assert got == brute(texts)


def test_ids_and_empty_tables(spark):
    rows = [(None, "a line that repeats"), (3, "a line that repeats"), (1, "x\na line that repeats"), (1, "x\na line that repeats")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), list(r.dropped)) for r in duplicate_lines(docs).collect())
    assert got == [("1", []), ("3", [0]), ("None", [0])]
    assert sorted((str(r.doc_id), r.text) for r in without_duplicate_lines(docs).collect()) == [
        ("1", "x\na line that repeats"), ("1", "x\na line that repeats"), ("3", ""), ("None", ""),
    ]
    assert duplicate_lines(docs.limit(0)).collect() == []


@pytest.mark.parametrize("length", [10, 18, 26])
def test_short_lines_with_a_tail(spark, length):
    # The longest tail that leaves a similarity of 0.8; random letters make no other pair similar.
    tail, pick, texts = (length - 6) // 4, random.Random(length), []
    for _ in range(400):
        line = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=length + tail))
        assert len(grams(line[:length])) >= 0.8 * len(grams(line))
        texts += [line[:length], line]
    got = {r.doc_id: list(r.dropped) for r in duplicate_lines(docs_of(spark, texts)).collect()}
    assert all(got[i] == [] for i in range(0, 800, 2))
    # The bands alone miss less than one pair in a thousand.
    assert sum(got[i] == [0] for i in range(1, 800, 2)) >= 399


def test_maps_leave_no_similar_pair_out(spark):
    """Pairs at and around the limit, from six shingles to beyond what a map tells apart."""
    pick, rows, pairs = random.Random(8), [], []
    for n in range(700):
        own = "".join(pick.choices("abcdefgh", k=12 + n * n // 300))
        for k in range(3):
            other = own + "".join(pick.choices("abcdefgh", k=max(1, len(own) * k // 8)))
            rows += [(6 * n + 2 * k, own), (6 * n + 2 * k + 1, other)]
            pairs.append((6 * n + 2 * k, 6 * n + 2 * k + 1))
    texts = spark.createDataFrame(rows, "node long, _line string").select("node", lines._encoded(F.col("_line")).alias("_bytes"))
    frame = spark.createDataFrame(pairs, "a long, b long")
    kept = {tuple(r) for r in lines._promising(frame, lines._mapped(texts, 7), 0.8).collect()}
    scored = lines._scored(frame, texts, 7).collect()
    similar = {(r.a, r.b) for r in scored if r.score >= 0.8}
    assert similar <= kept and 500 < len(similar) < len(pairs) - 500
    # Lines of up to some 200 characters: a longer one fills its map.
    far = frame.filter("a < 1500").select("a", ((F.col("b") + 601) % 1500).alias("b"))
    assert lines._promising(far, lines._mapped(texts, 7), 0.8).count() < 0.02 * far.count()


def star(n, dropped):
    """Lines that each differ from one line, and twice as much from each other."""
    base = "".join(random.Random(5).choices("abcdefghijklmnopqrstuvwxyz", k=400))
    variants = []
    for i in range(n):
        pick, letters = random.Random(100 + i), list(base)
        for _ in range(dropped):
            letters[pick.randrange(len(letters))] = pick.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
        variants.append("".join(letters))
    return variants


def test_a_large_group_of_far_copies_hands_few_pairs_on(spark, monkeypatch):
    # They share bands and no base; few are similar, and none of the links may be lost.
    texts, seen = star(150, 10), []
    verified = lines._promising

    def counted(pairs, maps, similarity):
        seen.append(pairs.distinct().count())
        return verified(pairs, maps, similarity)

    monkeypatch.setattr(lines, "_promising", counted)
    got = {r.doc_id: list(r.dropped) for r in duplicate_lines(docs_of(spark, texts)).collect()}
    assert got == brute(texts)
    assert sum(seen) < 150 * 149 / 2 / 4


def test_no_link_is_lost_after_rounds(spark, monkeypatch):
    # Rounds of checks from the first pair on, as in a band of a million nodes.
    monkeypatch.setattr(bands, "_FEW", 0)
    monkeypatch.setattr(bands, "_HELPED", 2.0)
    monkeypatch.setattr(bands, "ROUNDS", 1)
    texts = [edited(prose(9, 80), i, 3 + i % 5) for i in range(60)] + star(40, 7) + CHAIN
    got = {r.doc_id: list(r.dropped) for r in duplicate_lines(docs_of(spark, texts)).collect()}
    assert got == brute(texts)


def test_shuffle_files_go_with_the_write(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, local = spark.conf.get(name), spark.conf.get("spark.local.dir", tempfile.gettempdir())

    def kept():
        return {p for p in pathlib.Path(local).glob("blockmgr-*/*/shuffle_*.data")}

    old, until = kept(), time.monotonic() + 20
    materialise(spark.range(1000).repartition(7, "id"), "x")
    while kept() - old and time.monotonic() < until:
        time.sleep(0.2)
    assert not kept() - old and spark.conf.get(name) == before


def test_across_hands_a_pair_on_once(spark):
    # Nodes 1 to 40 share five bands and are apart; 0 is the frequent one of each.
    opened = spark.range(41).selectExpr("id AS node", "explode(array(11L, 12L, 13L, 14L, 15L)) AS _key")
    opened = opened.selectExpr("_key", "node", "0L AS rep", "node AS _label", "0L AS _main", "array(0L) AS _pivots")
    rule = bands.Rule(lambda nodes: nodes.selectExpr("node", "node % 2 AS _odd"), lambda x, y: F.col(f"{x}_odd") == F.col(f"{y}_odd"))
    got = [(r.a, r.b) for r in bands._across(opened, rule).collect()]
    assert sorted(got) == [(a, b) for a in range(1, 41) for b in range(a + 2, 41, 2)]


def test_a_small_band_is_settled_at_once(spark, monkeypatch):
    # No rounds: neither are the nodes told apart by component, nor are there reps.
    monkeypatch.setattr(bands, "_parted", None)
    texts = [edited(prose(1, 80), i, 1 + i % 2) for i in range(8)] + [prose(20 + i, 30) for i in range(5)]
    got = {r.doc_id: list(r.dropped) for r in duplicate_lines(docs_of(spark, texts)).collect()}
    assert got == brute(texts)


def test_chunks_of_shingles_change_nothing(spark):
    # Lengths around a chunk's end; the last shingle is repeated to fill a chunk.
    pick, words = random.Random(3), 2
    rows = [(n, "".join(pick.choices("abcdefgh漢é", k=n))) for n in range(1, 40)]
    texts = spark.createDataFrame(rows, "node long, _line string").select("node", lines._encoded(F.col("_line")).alias("_bytes"), "_line")
    each = spark.createDataFrame([(n, i == 0, g) for n, t in rows for i, g in enumerate(sorted(grams(t)))], "node long, _first boolean, g string")
    each = each.select("node", "_first", F.xxhash64(F.encode("g", "UTF-32")).alias("_h"))
    assert sorted(lines._signatures(texts, 7, 30).collect()) == sorted(bands.signatures(each, 30).collect())
    want = {r[0]: tuple(r[1:]) for r in bit_maps(each, ["node"], words).collect()}
    got = lines._mapped(texts, 7, words).select("node", *(f"_s{w}" for w in range(words)), "_bits").collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want
    assert all(r._bits == sum(bin(r[f"_s{w}"] & (1 << 64) - 1).count("1") for w in range(words)) for r in got)


def test_a_group_of_some_dozens_is_settled_without_rounds(spark, monkeypatch):
    # Their maps were compared in the join; they are not moved again for that.
    monkeypatch.setattr(lines, "_promising", None)
    texts = star(40, 10)
    got = {r.doc_id: list(r.dropped) for r in duplicate_lines(docs_of(spark, texts)).collect()}
    assert got == brute(texts)


def test_a_wide_table_is_broadcast_by_its_bytes(spark, monkeypatch):
    monkeypatch.setattr(bands, "BROADCAST_BYTES", 100 * 64)
    narrow, wide = spark.range(100), spark.range(100).selectExpr("id", "array(id) AS _keys")
    plans = [spark.range(9).join(bands.bounded(t), "id")._jdf.queryExecution().executedPlan().toString() for t in (narrow, wide)]
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]
