"""License notices: phrases found by Aho-Corasick, tag expressions by a shunting-yard parser."""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocell.llm.batches import flat, map_texts

# The phrases and labels every scan reports.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Further notices, as words of the lower-cased text.
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "boost software license": "bsl",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}

TAG_PHRASE = "spdx license identifier"

# How freely a text under the label may be reused; an unlisted identifier counts as UNKNOWN.
FREEDOM = {
    "public-domain": 1.0,
    "cc0": 1.0,
    "unlicense": 1.0,
    "mit": 0.9,
    "bsd": 0.9,
    "isc": 0.9,
    "bsl": 0.9,
    "apache": 0.85,
    "cc-by": 0.8,
    "mpl": 0.6,
    "epl": 0.6,
    "lgpl": 0.5,
    "gpl": 0.3,
    "agpl": 0.2,
    "all-rights-reserved": 0.0,
}
UNKNOWN = 0.5
# An exception loosens the license it is attached to by half of what is left to 1.
EXCEPTION = 0.5

_TAG = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+-]*")
_BINDS = {"or": 1, "and": 2, "with": 3}

RESULT = (
    "n_words long, matches array<struct<label string, word long, base boolean>>, "
    "expressions array<string>, labels array<string>, score double"
)


def label_of(identifier: str) -> str:
    """Family of a license identifier: ``GPL-2.0-only`` is ``gpl``, ``BSD-3-Clause`` ``bsd``."""
    name = identifier.lower()
    families = sorted([*FREEDOM, "cc0"], key=len, reverse=True)
    return next((f for f in families if name == f or name.startswith((f + "-", f + "+"))), name)


def postfix(expression: str) -> list[str] | None:
    """Shunting-yard: the expression in postfix order, None when it is malformed.

    Operators bind as ``with``, ``and``, ``or``, each to the left. Words after
    the first complete expression (the end of a comment, say) are not part of it.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression):
        word = token.lower()
        if operand_next:
            if word in _BINDS or word == ")":
                return None
            if word == "(":
                stack.append(word)
                continue
            out.append(token)
            operand_next = False
        elif word in _BINDS:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[word]:
                out.append(stack.pop())
            stack.append(word)
            operand_next = True
        elif word == ")" and "(" in stack:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            break
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(order: list[str], freedom: Mapping[str, float] = FREEDOM) -> tuple[float, set[str]]:
    """``(freedom, labels)`` of a postfix expression.

    ``or`` lets the user choose, so it takes the freer side; ``and`` binds to
    both, so it takes the stricter; ``with`` loosens its left side.
    """
    stack: list[tuple[float, set[str]]] = []
    for token in order:
        operator = token.lower()
        if operator not in _BINDS:
            label = label_of(token)
            stack.append((freedom.get(label, UNKNOWN), {label}))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        if operator == "with":
            stack.append((a + (1 - a) * EXCEPTION, left))
        else:
            stack.append((max(a, b) if operator == "or" else min(a, b), left | right))
    return stack.pop()


_FOLD = np.full(256, 0x20, np.uint8)
for _low, _high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _FOLD[_low : _high + 1] = np.arange(_low, _high + 1)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


@functools.lru_cache(maxsize=4)
def _automaton(phrases: tuple[tuple[str, str, bool], ...]):
    found = ahocorasick.Automaton()
    for phrase, label, base in phrases:
        found.add_word(f" {phrase} ", (len(phrase) + 2, label, base))
    found.add_word(f" {TAG_PHRASE} ", (len(TAG_PHRASE) + 2, None, False))
    found.make_automaton()
    return found


def _folded(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """All texts as one buffer: a line feed and a blank open each text, one blank follows each word."""
    rows = len(offsets) - 1
    lengths = np.diff(offsets)
    out = np.full(len(data) + 3 * rows, 0x20, np.uint8)
    out[offsets[:-1] + 3 * np.arange(rows)] = 0x0A
    out[np.arange(len(data)) + np.repeat(3 * np.arange(rows) + 2, lengths)] = _FOLD[data]
    blank = out == 0x20
    blank[1:] &= blank[:-1].copy()
    blank[0] = False
    return out[~blank]


def _scan(piece: pa.RecordBatch, phrases: tuple[tuple[str, str, bool], ...]) -> list[pa.Array]:
    data, offsets = flat(piece.column("text"))
    folded = _folded(data, offsets)
    blanks = np.cumsum(folded == 0x20)
    opens = np.flatnonzero(folded == 0x0A)
    ends = np.append(opens[1:], len(folded)) - 1
    words = (blanks[ends] - blanks[opens] - 1) if len(opens) else np.zeros(0, np.int64)
    matches: list[list[dict]] = [[] for _ in range(piece.num_rows)]
    expressions: list[list[str]] = [[] for _ in range(piece.num_rows)]
    tagged: set[int] = set()
    for last, (length, label, base) in _automaton(phrases).iter(folded.tobytes().decode("latin-1")):
        start = last - length + 1
        row = int(np.searchsorted(opens, start)) - 1
        if label is None:
            tagged.add(row)
        else:
            word = int(blanks[start] - blanks[opens[row]] - 1)
            matches[row].append({"label": label, "word": word, "base": base})
    labels: list[list[str]] = []
    scores: list[float] = []
    for row, found in enumerate(matches):
        names = {m["label"] for m in found}
        free = [FREEDOM.get(n, UNKNOWN) for n in names]
        if row in tagged:
            for written in _TAG.findall(piece.column("text")[row].as_py()):
                order = postfix(written)
                if order is not None:
                    value, more = evaluate(order)
                    free.append(value)
                    names |= more
                    expressions[row].append(" ".join(order))
        labels.append(sorted(names))
        scores.append(min(free, default=UNKNOWN))
    of = pa.struct([("label", pa.string()), ("word", pa.int64()), ("base", pa.bool_())])
    return [
        pa.array(words, pa.int64()),
        pa.array(matches, pa.list_(of)),
        pa.array(expressions, pa.list_(pa.string())),
        pa.array(labels, pa.list_(pa.string())),
        pa.array(scores, pa.float64()),
    ]


def scan_licenses(
    docs: DataFrame,
    base: Mapping[str, str] = BASE_PHRASES,
    notices: Mapping[str, str] = NOTICE_PHRASES,
) -> DataFrame:
    """Every license notice and identifier tag of every whole text.

    Returns per row of ``docs``: ``doc_id, n_words, matches`` (label, word the
    phrase starts at, whether it is a base phrase; by text order), ``expressions``
    (of the identifier tags, in postfix order), ``labels`` (distinct, sorted) and
    ``score``, the reuse that the strictest notice leaves: 1 is free, 0 is none,
    0.5 unknown or no notice.

    Words are runs of ASCII letters and digits and of all characters above
    ASCII, A-Z lower-cased. A null or empty text has no words and no labels; a
    malformed expression is left out; a null ``doc_id`` and repeated rows each
    give a row; other columns are ignored.
    """
    phrases = tuple([(p, n, True) for p, n in base.items()] + [(p, n, False) for p, n in notices.items() if p not in base])

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), *_scan(piece, phrases)], names=names)

    kept = docs.select(F.col("doc_id"), F.col("text"))
    schema = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, {RESULT}"
    names = ["doc_id", "n_words", "matches", "expressions", "labels", "score"]
    return map_texts(kept, "text", work, schema)
