"""Byte-level BPE through a sentencepiece model serialised straight from a rank file.

A rank file is a BPE model already: merging the pair of the lowest rank first
is merging the pair of the highest score first when a piece scores minus its
rank. So the model is written, not trained: every byte is mapped to one
printable character, pieces are mapped byte by byte, and normalisation is off.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocell.llm.batches import map_texts

# Matches whose ids a task keeps; when full the table starts anew, so that the
# memory of a task does not grow with its partition.
CACHED_MATCHES = 200_000
# Longer matches are rare and would fill the table with text.
LONGEST_CACHED = 64

# The character of byte b; the range holds letters only, no blanks or controls.
_BYTE_CHARACTERS = [chr(0x100 + b) for b in range(256)]
_TO_CHARACTERS = dict(enumerate(_BYTE_CHARACTERS))


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHARACTERS)


def _varint(value: int) -> bytes:
    out = bytearray()
    while value >= 0x80:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _field(number: int, value: bytes | str | int | float) -> bytes:
    """One protocol buffer field: text or message, integer, or 32-bit float."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


# Fixed values of the sentencepiece model format.
_PIECE, _TEXT, _SCORE, _KIND, _UNKNOWN = 1, 1, 2, 3, 2
_TRAINER, _MODEL_TYPE, _BPE = 2, 3, 2
_BOS, _EOS, _PAD = 41, 42, 43
_NORMALIZER, _NAME, _DUMMY_PREFIX, _TRIM, _ESCAPE = 3, 1, 3, 4, 5
_ABSENT = (1 << 64) - 1  # -1 as a varint


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a rank table; piece 0 is unknown, piece i + 1 the i-th by rank."""
    pieces = [_field(_PIECE, _field(_TEXT, "<unk>") + _field(_SCORE, 0.0) + _field(_KIND, _UNKNOWN))]
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        pieces.append(_field(_PIECE, _field(_TEXT, mapped(token)) + _field(_SCORE, float(-rank))))
    trainer = _field(_MODEL_TYPE, _BPE) + _field(_BOS, _ABSENT) + _field(_EOS, _ABSENT) + _field(_PAD, _ABSENT)
    normalizer = _field(_NAME, "identity") + _field(_DUMMY_PREFIX, 0) + _field(_TRIM, 0) + _field(_ESCAPE, 0)
    return b"".join(pieces) + _field(_TRAINER, trainer) + _field(_NORMALIZER, normalizer)


class Tokenizer:
    """Encodes and decodes with one serialised model."""

    def __init__(self, model: bytes, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # A piece may take any rank; pieces were written by rank.
        self.rank_of_piece = [0, *sorted(ranks.values())]
        self.split = regex.compile(pattern).findall
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.known: dict[str, bytes] = {}

    def _learn(self, matches: Iterable[str]) -> dict[str, bytes]:
        """Ids of new matches, packed as little-endian 32-bit integers."""
        found: dict[str, bytes] = {}
        merge: list[str] = []
        for match in matches:
            data = match.encode()
            rank = self.ranks.get(data)  # a whole token needs no merge
            if rank is None:
                merge.append(match)
            else:
                found[match] = struct.pack("<I", rank)
        encoded = self.processor.encode([mapped(m.encode()) for m in merge], num_threads=1) if merge else []
        for match, pieces in zip(merge, encoded):
            found[match] = struct.pack(f"<{len(pieces)}I", *map(self.rank_of_piece.__getitem__, pieces))
        return found

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.split(text) for text in texts]
        new = set(chain.from_iterable(split)).difference(self.known)
        if len(self.known) + len(new) > CACHED_MATCHES:
            self.known = {}
            new = set(chain.from_iterable(split))
        known = self.known
        known.update(self._learn(new))
        packed = [b"".join(map(known.__getitem__, matches)) for matches in split]
        if len(known) > CACHED_MATCHES:
            self.known = {}
        else:
            for match in new:
                if len(match) > LONGEST_CACHED:
                    del known[match]
        return packed

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def _tokenizer(model: bytes, pattern: str) -> Tokenizer:
    """One tokenizer per worker; the ranks are read back from the model itself."""
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    back = {c: b for b, c in enumerate(_BYTE_CHARACTERS)}
    ranks = {
        bytes(map(back.__getitem__, processor.id_to_piece(i))): round(-processor.get_score(i))
        for i in range(1, processor.get_piece_size())
    }
    return Tokenizer(model, ranks, pattern)


def load(path: str, pattern: str) -> Tokenizer:
    """The tokenizer of a rank file."""
    return _tokenizer(serialise(read_ranks(path)), pattern)


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids``: the token ids of every whole text.

    ``path`` is a rank file on the driver; its model travels with the tasks and
    is bounded by the vocabulary. A null or empty text has no ids; null and
    repeated ids each keep their row; other columns are ignored. A character
    whose bytes the vocabulary lacks fails, as there is no id to give.
    """
    model = serialise(read_ranks(path))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in piece.column("text").to_pylist()]
        packed = _tokenizer(model, pattern).encode_packed(texts)
        offsets = np.cumsum([0, *(len(p) // 4 for p in packed)])
        ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
        lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids)).cast(pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), lists], names=["doc_id", "ids"])

    kept = docs.select("doc_id", "text")
    return map_texts(kept, "text", work, f"doc_id {_id_type(docs)}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, data``: the bytes of every list of ids; a null list gives no bytes."""
    model = serialise(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokenizer = _tokenizer(model, pattern)
            data = [tokenizer.decode(ids.as_py() or ()) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {_id_type(encoded)}, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of the ids of every whole text and of the bytes they decode to.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256, whole`` (whether the
    decoded bytes are the text's) without moving the ids between tasks. Nulls,
    ties and clashing columns as in ``encode``.
    """
    model = serialise(read_ranks(path))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        tokenizer = _tokenizer(model, pattern)
        texts = [t or "" for t in piece.column("text").to_pylist()]
        counts, ids_digests, data_digests, whole = [], [], [], []
        for text, packed in zip(texts, tokenizer.encode_packed(texts)):
            data = tokenizer.decode(np.frombuffer(packed, "<u4").tolist())
            counts.append(len(packed) // 4)
            ids_digests.append(hashlib.sha256(packed).hexdigest())
            data_digests.append(hashlib.sha256(data).hexdigest())
            whole.append(data == text.encode())
        columns = [pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(data_digests), pa.array(whole, pa.bool_())]
        columns[1:3] = [c.cast(pa.string()) for c in columns[1:3]]
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "whole"]
    schema = f"doc_id {_id_type(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string, whole boolean"
    return map_texts(docs.select("doc_id", "text"), "text", work, schema)


def count_tokens(docs: DataFrame, path: str, pattern: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_tokens`` and the columns ``by`` of every document."""
    model = serialise(read_ranks(path))

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in piece.column("text").to_pylist()]
        counts = [len(p) // 4 for p in _tokenizer(model, pattern).encode_packed(texts)]
        kept = [piece.column(c) for c in ("doc_id", *by)]
        return pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64())], names=["doc_id", *by, "n_tokens"])

    kept = docs.select("doc_id", *by, "text")
    schema = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in ("doc_id", *by))
    return map_texts(kept, "text", work, f"{schema}, n_tokens long")
