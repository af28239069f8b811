import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerocell.llm import negatives
from aerocell.llm.negatives import coarser, hard_negatives, segment_summaries
from aerocell.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=5):
    """The contract, pair by pair."""
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        kept.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for i, (anchor_id, label, own) in enumerate(kept):
        if anchor_id % 100:
            continue
        pairs = [(sum(a * b for a, b in zip(own, x)), v, y) for j, (v, y, x) in enumerate(kept) if j != i and len(x) == len(own)]
        pairs.sort(key=lambda p: (-p[0], p[1]))
        for score, positive_id, _ in [p for p in pairs if p[2] == label][:positives]:
            below = [p for p in pairs if p[2] != label and 80 * score <= 100 * p[0] <= 100 * score]
            out += [(anchor_id, positive_id, k + 1, p[1], score, p[0]) for k, p in enumerate(below[:negatives])]
    return sorted(out)


def answer(spark, tmp_path, rows):
    spark.createDataFrame(rows, VECTORS).withColumn("row", F.lit(0)).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(tuple(r) for r in QUERIES["op11_hard_negatives"](spark, str(tmp_path)).collect())


def vectors(number, dim, seed=1):
    pick = random.Random(seed)
    centres = [[pick.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [
        (i, [c + 0.7 * pick.gauss(0, 1) for c in centres[i % 6]], pick.choice([i % 6, i % 6, pick.randrange(10)]))
        for i in range(number)
    ]


def test_query_equals_brute_force(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = vectors(900, 19)
    rows += [(900 + i, v, 1) for i, v in enumerate([None, [], [nan] * 19, [inf] + [0.0] * 18, [None] * 19, [1.0] * 7, [1.0] * 7])]
    rows += [(1000, [], 1), (1001, [], 2), (1002, [], 1), (None, [1.0] * 19, 1), (1100, [1.0] * 7, None), (1200, [0.5] * 7, 1)]
    # A vector that is a third of all rows, rows given twice, an anchor given twice and only negative scores.
    rows += [(2000 + i, rows[100][1], i % 3) for i in range(450)] + rows[:40] + [rows[300], rows[300]]
    rows += [(5000, [-9.0] * 5, 4), (5001, [9.0] * 5, 4), (5002, [9.0] * 5, 5)]
    got = answer(spark, tmp_path, rows)
    assert got == brute(rows) and len(got) > 100


def test_blocks_and_floors_change_nothing(spark, monkeypatch):
    rows = vectors(700, 9, seed=5)
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)

    def found():
        return sorted(tuple(r) for r in hard_negatives(frame, F.col("vec_id") % 30 == 0, positives=3, negatives=2).collect())

    whole = found()
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 7)
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 3)
    assert found() == whole and len(whole) > 50


def test_large_components_stay_exact(spark, tmp_path):
    pick = random.Random(3)
    rows = [(i, [pick.choice([-1, 1]) * 130_000.0 + pick.randrange(9) for _ in range(4)], i % 2) for i in range(240)]
    rows.append((777, [1e7] * 4, 1))  # too long for any score to be held: takes no part
    got = answer(spark, tmp_path, rows)
    assert got == brute(rows[:-1]) and max(r[4] for r in got) > 2**51


def test_empty_tables(spark, tmp_path):
    assert answer(spark, tmp_path / "none", []) == []
    assert answer(spark, tmp_path / "no_anchor", [(1, [1.0], 1), (2, [1.0], 1)]) == []
    assert answer(spark, tmp_path / "alone", [(100, [1.0], 1)]) == []


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 70), st.integers(0, 2**32 - 1))
def test_every_level_bounds_the_product(dim, seed):
    own = np.random.default_rng(seed)
    x = np.floor(own.normal(0, 300, (6, dim)) * own.choice([0, 1], (6, 1)))
    levels = coarser(segment_summaries(x), dim)
    assert levels[0].shape == (6, 2)
    length = np.sqrt((x * x).sum(axis=1))
    block = negatives.Block(np.arange(6), np.arange(6), np.arange(6), x, levels, length)
    width = np.inf
    for level in range(len(levels)):
        low, high = block.bounds(block, level)
        assert (low <= x @ x.T + 1e-6).all() and (high >= x @ x.T - 1e-6).all()
        # Finer segments bound at least as closely.
        assert ((high - low) <= width + 1e-4 + 1e-6 * np.outer(length, length)).all()
        width = high - low


@pytest.mark.parametrize("same", [True, False])
def test_segments_rule_pairs_out(same, monkeypatch):
    own = np.random.default_rng(4)
    # Vectors that are nearly constant in a segment are settled by means alone.
    x = np.floor(np.repeat(own.normal(0, 300, (400, 8)), 8, axis=1) + own.normal(0, 2, (400, 64)))
    levels, number = coarser(segment_summaries(x), 64), np.arange(400)
    rows = negatives.Block(number, number, number % 2, x, levels, np.sqrt((x * x).sum(axis=1)))
    scored = []
    products = negatives.Block.products
    monkeypatch.setattr(negatives.Block, "products", lambda a, b: (scored.append(len(b.row)), products(a, b))[1])
    anchors = rows.take(slice(0, 1))
    none = np.iinfo(np.int64)
    best = negatives.Best(np.array([0]), np.array([none.max]), np.array([none.min]), 3)
    for start in range(0, 400, 50):
        negatives.search_block(rows.take(slice(start, start + 50)), anchors, best, same)
    exact = sorted(((-(x[0] @ x[i]), i) for i in range(1, 400) if (i % 2 == 0) == same))[:3]
    assert sorted(zip(-best.score, best.row)) == exact
    assert sum(scored) < 120
