"""Hard negatives: wrong-label rows that score just below an anchor's positives.

Every vector is stored with the mean and the deviation of its segments. For two
vectors the product of their means, plus or minus the product of their
deviations, bounds what a segment adds to the score, so most pairs are settled
by a few numbers. What is left is bounded again by finer segments, and scored
exactly only after the finest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerocell.session import shared_dir

# Anchors that one job searches for: they and their best rows are what a task and the driver hold.
ANCHOR_BLOCK = 8192
# Rows of a block of vectors; the first blocks of a task are smaller, to find thresholds early.
FIRST_ROWS, MOST_ROWS = 64, 1024
ANCHORS_AT_ONCE = 1024
# Segments of the finest level; each level above joins four of them.
FINEST, JOINED = 16, 4
# Share of the index that is searched first; its results are the floor for the rest.
FIRST_SHARE = 16
# Scores of vectors below this squared length fit a long a hundred times over.
MOST_SQUARED = float(1 << 56)
_EXACT = float(1 << 53)
_SLACK = 1e-9

_INDEX = "row long, vec_id long, label long, anchor boolean, dim int, x binary, segments binary, first boolean"
_FOUND = "win long, score long, vec_id long, row long"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_RESULT_COLUMNS = [c.split()[0] for c in _RESULT.split(", ")]


def _edges(dim: int) -> np.ndarray:
    """Where the finest segments of ``dim`` components start and end."""
    return np.unique(np.linspace(0, dim, min(FINEST, max(dim, 1)) + 1).astype(np.int64))


def segment_summaries(x: np.ndarray) -> np.ndarray:
    """Mean and deviation of each finest segment: ``(rows, 2 * segments)``.

    The mean is scaled by the root of the segment's length and the deviation is
    the root of the summed squares, so that products need no weights.
    """
    edges = _edges(x.shape[1])
    lengths = np.diff(edges)
    if not len(lengths):
        return np.zeros((len(x), 0))
    sums = np.add.reduceat(x, edges[:-1], axis=1)
    apart = x - np.repeat(sums / lengths, lengths, axis=1)
    deviations = np.sqrt(np.add.reduceat(apart * apart, edges[:-1], axis=1))
    return np.concatenate([sums / np.sqrt(lengths), deviations], axis=1)


def coarser(summaries: np.ndarray, dim: int) -> list[np.ndarray]:
    """The levels from one segment for the whole vector to the finest, from the finest alone."""
    lengths = np.diff(_edges(dim)).astype(np.float64)
    levels = [summaries]
    while len(lengths) > 1:
        half = len(lengths)
        means, deviations = summaries[:, :half], summaries[:, half:]
        starts = np.arange(0, half, JOINED)
        wide = np.add.reduceat(lengths, starts)
        joined = np.add.reduceat(means * np.sqrt(lengths), starts, axis=1) / np.sqrt(wide)
        squares = np.add.reduceat(means * means + deviations * deviations, starts, axis=1)
        apart = np.sqrt(np.maximum(squares - joined * joined, 0.0))
        summaries, lengths = np.concatenate([joined, apart], axis=1), wide
        levels.append(summaries)
    return levels[::-1]


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector")
        offsets = vectors.offsets.to_numpy().astype(np.int64)
        values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
        sizes = np.diff(offsets)
        columns = {name: [] for name in ("at", "x", "segments")}
        for dim in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dim)
            x = values[offsets[at][:, None] + np.arange(dim)]
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(256.0 * x)
                kept = (x * x).sum(axis=1) < MOST_SQUARED
            at, x = at[kept], x[kept]
            columns["at"] += at.tolist()
            columns["segments"] += [s.tobytes() for s in segment_summaries(x)]
            columns["x"] += [s.tobytes() for s in x.astype(np.int32)]
        out = batch.select(["row", "vec_id", "label", "anchor"]).take(pa.array(columns["at"], pa.int64()))
        dims = pa.array(sizes[columns["at"]].astype(np.int32) if columns["at"] else [], pa.int32())
        more = [dims, pa.array(columns["x"], pa.binary()), pa.array(columns["segments"], pa.binary())]
        first = pa.array(out.column("row").to_numpy() % FIRST_SHARE == 0)
        yield pa.RecordBatch.from_arrays(
            [*out.columns, *more, first],
            names=["row", "vec_id", "label", "anchor", "dim", "x", "segments", "first"],
        )


def _written(df: DataFrame, name: str, by: str) -> DataFrame:
    """``df`` as a table of the shared folder, in partitions by one column."""
    path = f"{shared_dir(df.sparkSession)}/{name}"
    df.write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def index_vectors(rows: DataFrame, anchor: Column, vec_id: str, label: str, vector: str) -> DataFrame:
    """The rows that take part, with whole-number vectors and segment summaries, written to the shared folder."""
    sound = ~F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    taken = rows.filter(F.col(label).isNotNull() & F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & sound)
    plain = taken.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    return _written(plain.mapInArrow(_index_batches, _INDEX), "vectors", "first")


@dataclass
class Block:
    """Vectors of one length, as matrices."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    levels: list[np.ndarray]
    length: np.ndarray

    @classmethod
    def of(cls, table: pa.RecordBatch | pa.Table, dim: int) -> Block:
        n = table.num_rows
        x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.int32).reshape(n, dim).astype(np.float64)
        segments = np.frombuffer(b"".join(table.column("segments").to_pylist()), np.float64)
        numbers = [table.column(c).to_numpy() for c in ("row", "vec_id", "label")]
        return cls(*numbers, x, coarser(segments.reshape(n, -1), dim), np.sqrt((x * x).sum(axis=1)))

    def take(self, at: np.ndarray | slice) -> Block:
        return Block(
            self.row[at], self.vec_id[at], self.label[at], self.x[at], [s[at] for s in self.levels], self.length[at]
        )

    def products(self, other: Block) -> np.ndarray:
        """Exact inner products."""
        if self.length.max(initial=0.0) * other.length.max(initial=0.0) < _EXACT:
            return (self.x @ other.x.T).astype(np.int64)
        return self.x.astype(np.int64) @ other.x.astype(np.int64).T

    def bounds(self, other: Block, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible product of each pair at a level of segments."""
        a, b = self.levels[level], other.levels[level]
        half = a.shape[1] // 2
        middle = a[:, :half] @ b[:, :half].T
        spread = a[:, half:] @ b[:, half:].T + _SLACK * np.outer(self.length, other.length)
        return middle - spread, middle + spread


@dataclass
class Best:
    """The best ``k`` rows of each window: scores at most ``high``, above ``low``."""

    anchor: np.ndarray
    high: np.ndarray
    low: np.ndarray
    k: int

    def __post_init__(self) -> None:
        # Of a full window, the id that an equal score has to be below.
        self.id_below = np.full(len(self.anchor), np.iinfo(np.int64).min)
        self.win = np.zeros(0, np.int64)
        self.score, self.vec_id, self.row = self.win, self.win, self.win

    def offer(self, win: np.ndarray, scores: np.ndarray, rows: Block, allowed: np.ndarray) -> None:
        """Take what belongs into the windows from a matrix of ``win`` times ``rows``."""
        low, high = self.low[win][:, None], self.high[win][:, None]
        tied = (scores == low) & (rows.vec_id[None, :] < self.id_below[win][:, None])
        i, j = np.nonzero(allowed & (scores <= high) & ((scores > low) | tied))
        if not len(i):
            return
        parts = ((self.win, win[i]), (self.score, scores[i, j]), (self.vec_id, rows.vec_id[j]), (self.row, rows.row[j]))
        win, score, vec_id, row = (np.concatenate(p) for p in parts)
        order = np.lexsort((row, vec_id, -score, win))
        win = win[order]
        starts = np.flatnonzero(np.concatenate(([True], win[1:] != win[:-1])))
        rank = np.arange(len(win)) - np.repeat(starts, np.diff(np.append(starts, len(win))))
        kept = order[rank < self.k]
        self.win, self.score, self.vec_id, self.row = win[rank < self.k], score[kept], vec_id[kept], row[kept]
        full = rank == self.k - 1
        self.low[win[full]] = score[order[full]]
        self.id_below[win[full]] = vec_id[order[full]]

    def floor_of(self, anchors: int) -> tuple[np.ndarray, np.ndarray]:
        """Least score that still matters to each anchor, and the largest."""
        least = np.full(anchors, np.iinfo(np.int64).max)
        most = np.full(anchors, np.iinfo(np.int64).min)
        np.minimum.at(least, self.anchor, self.low)
        np.maximum.at(most, self.anchor, self.high)
        return least, most


def search_block(rows: Block, anchors: Block, best: Best, same_label: bool) -> None:
    """Offer every row of a block to every window, pairs that segments rule out excepted."""
    for start in range(0, len(anchors.row), ANCHORS_AT_ONCE):
        at = np.arange(start, min(start + ANCHORS_AT_ONCE, len(anchors.row)))
        near, some, own = rows, anchors.take(at), at
        least, most = best.floor_of(len(anchors.row))
        allowed = some.label[:, None] == near.label[None, :]
        allowed = (allowed if same_label else ~allowed) & (some.row[:, None] != near.row[None, :])
        for level in range(len(rows.levels) + 1):
            a, r = allowed.any(axis=1), allowed.any(axis=0)
            if not a.any():
                break
            if not (a.all() and r.all()):
                near, some, own, allowed = near.take(r), some.take(a), own[a], allowed[np.ix_(a, r)]
            if level < len(rows.levels):
                under, over = some.bounds(near, level)
                allowed = allowed & (over >= least[own][:, None]) & (under <= most[own][:, None])
        else:
            scores = some.products(near)
            place = np.full(len(anchors.row), -1)
            place[own] = np.arange(len(own))
            wins = np.flatnonzero(place[best.anchor] >= 0)
            rank = np.arange(len(wins)) - np.searchsorted(best.anchor[wins], best.anchor[wins])
            # One window of each anchor at a time: no row of the matrix is repeated.
            for nth in range(int(rank.max(initial=-1)) + 1):
                win = wins[rank == nth]
                lines = place[best.anchor[win]]
                best.offer(win, scores[lines], near, allowed[lines])


def _searcher(shared, same_label: bool, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        by_dim = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in asked:
                    continue
                anchors, number, anchor, high, low = asked[dim]
                if dim not in by_dim:
                    by_dim[dim] = [Best(anchor, high.copy(), low.copy(), k), FIRST_ROWS]
                best, size = by_dim[dim]
                rows = Block.of(batch.filter(pa.array(dims == dim)), dim)
                start = 0
                while start < len(rows.row):
                    search_block(rows.take(slice(start, start + size)), anchors, best, same_label)
                    start, size = start + size, min(2 * size, MOST_ROWS)
                by_dim[dim][1] = size
        for dim, (best, _) in by_dim.items():
            number = asked[dim][1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (number[best.win], best.score, best.vec_id, best.row)],
                names=["win", "score", "vec_id", "row"],
            )

    return search


_WINDOWS = np.dtype([("win", "i8"), ("anchor", "i8"), ("high", "i8"), ("low", "i8")])


def _ask(
    spark: SparkSession, index: DataFrame, anchors: pa.Table, windows: np.ndarray, same_label: bool, k: int
) -> DataFrame:
    """``win, score, vec_id, row``: each task's best ``k`` rows of every window, which names its anchor by row."""
    dims = anchors.column("dim").to_numpy()
    asked = {}
    for dim in np.unique(dims).tolist():
        block = Block.of(anchors.filter(pa.array(dims == dim)), dim)
        block = block.take(np.argsort(block.row))
        own = windows[np.isin(windows["anchor"], block.row)]
        own = own[np.argsort(own["anchor"], kind="stable")]
        asked[dim] = (block, own["win"], np.searchsorted(block.row, own["anchor"]), own["high"], own["low"])
    shared = spark.sparkContext.broadcast(asked)
    columns = ["row", "vec_id", "label", "dim", "x", "segments"]
    return index.select(*columns).mapInArrow(_searcher(shared, same_label, k), _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("win").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _best(
    spark: SparkSession, index: DataFrame, anchors: pa.Table, windows: np.ndarray, same_label: bool, k: int
) -> DataFrame:
    """The best ``k`` rows of each window; a share of the index is searched first and sets floors for the rest."""
    first = _ranked(_ask(spark, index.filter("first"), anchors, windows, same_label, k), k).toArrow()
    full = first.filter(pa.array(first.column("rank").to_numpy() == k))
    floors = dict(zip(full.column("win").to_pylist(), full.column("score").to_pylist()))
    none = np.iinfo(np.int64).min
    # One below the floor, so that equal scores with smaller ids still come through.
    floor = np.array([floors.get(w, none + 1) - 1 for w in windows["win"].tolist()], np.int64)
    raised = windows.copy()
    raised["low"] = np.maximum(windows["low"], floor)
    rest = _ask(spark, index.filter("not first"), anchors, raised, same_label, k)
    return _ranked(spark.createDataFrame(first.drop_columns("rank"), _FOUND).union(rest), k)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` tells which rows are anchors. Vectors become whole numbers,
    floor(256 * x); a score is the inner product. An anchor's positives are its
    best other rows of the same label, and for each of them the negatives are
    the best rows of other labels that score at most as much and at least
    ``least_percent`` of it; ties go to the smaller id.

    Rows with a null id, label, vector or component, or a component that is not
    finite, take no part; nor do those whose scaled vector has a squared length
    of 2^56 or more, as scores would not fit a long. Rows of another length
    than the anchor's are not compared with it; empty vectors score 0. Repeated
    rows are rows of their own: a copy of an anchor can be its positive. Other
    columns are ignored; no row or no anchor gives no rows.

    Anchors are taken in blocks that a task and the driver can hold, each
    against all rows; neither rows nor pairs are shuffled, only each task's best.
    A sixteenth of the rows is searched first and sets floors for the rest.
    """
    spark = rows.sparkSession
    index = index_vectors(rows, anchor, vec_id, label, vector)
    chosen = index.filter("anchor")
    blocks = -(-chosen.count() // ANCHOR_BLOCK)
    number = F.pmod(F.xxhash64("row"), F.lit(max(blocks, 1))).alias("block")
    chosen = _written(chosen.select("row", "vec_id", "label", "dim", "x", "segments", number), "anchors", "block")
    path = f"{shared_dir(spark)}/negatives"
    spark.createDataFrame([], _RESULT).write.parquet(path)
    ends = np.iinfo(np.int64)
    for block in range(blocks):
        anchors = chosen.filter(F.col("block") == block).toArrow()
        row = anchors.column("row").to_numpy()
        every = np.zeros(len(row), _WINDOWS)
        every["win"], every["anchor"], every["high"], every["low"] = row, row, ends.max, ends.min
        pairs = _best(spark, index, anchors, every, True, positives).toArrow()
        owner, score = pairs.column("win").to_numpy(), pairs.column("score").to_numpy()
        windows = np.zeros(len(owner), _WINDOWS)
        windows["win"], windows["anchor"], windows["high"] = np.arange(len(owner)), owner, score
        # The least score allowed, less one: a window takes what is above.
        windows["low"] = -(-score * least_percent // 100) - 1
        # A negative score leaves no room: four fifths of it is more than it.
        asked = windows[windows["high"] > windows["low"]]
        ids = dict(zip(row.tolist(), anchors.column("vec_id").to_pylist()))
        named = pa.table(
            {
                "win": pa.array(windows["win"]),
                "anchor_id": pa.array([ids[a] for a in owner.tolist()], pa.int64()),
                "positive_id": pairs.column("vec_id"),
                "positive_score": pairs.column("score"),
            }
        )
        names = spark.createDataFrame(named, "win long, anchor_id long, positive_id long, positive_score long")
        found = _best(spark, index, anchors, asked, False, negatives)
        # One row per window of this block of anchors: its size is bounded.
        whole = found.join(F.broadcast(names), "win").withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        whole.select(*_RESULT_COLUMNS).write.mode("append").parquet(path)
    return spark.read.schema(_RESULT).parquet(path)
