"""Arrow batches as flat UTF-8 buffers, cut by bytes so that memory stays bounded."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# A batch of Spark is bounded by its rows; texts are cut again by their bytes.
# One longer text still goes whole, as a piece of its own.
PIECE_BYTES = 2 << 20

Piece = Callable[[pa.RecordBatch], pa.RecordBatch]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``most`` bytes."""
    offsets = flat(batch.column(text))[1]
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def map_texts(df: DataFrame, text: str, work: Piece, schema: str) -> DataFrame:
    """Apply ``work`` to bounded pieces of ``df``, one task per partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                yield work(piece)

    return df.mapInArrow(run, schema)


def per_text(cumulative: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums per text from an inclusive running sum over all bytes."""
    padded = np.concatenate(([0], cumulative))
    return padded[offsets[1:]] - padded[offsets[:-1]]
