"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes.

The patterns are the base. The field adds spans in forms the patterns do not
know: national telephone numbers, identity numbers, masked addresses.
"""

from __future__ import annotations

import functools
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aerocell.llm.batches import flat, map_texts
from aerocell.llm.pii_examples import EXAMPLES

# Order of the kinds; the field knows the last, too.
KINDS = ("email", "ip", "card", "phone", "id")
BASE_KINDS = KINDS[:4]
LABELS = ("", "email", "phone", "id")

# A match never starts inside a run of digits, so the search stays linear.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # start, place in KINDS, end


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def _emails(text: str) -> list[Span]:
    found: list[Span] = []
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            found.append((start, 0, match.end()))
        # Nothing before this sign belongs to a later address.
        free = match.end() if match else at + 1
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind; those that fail their check are dropped."""
    found = _emails(text)
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in match[0].split(".")):
            found.append((match.start(), 1, match.end()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = "".join(_DIGITS.findall(match[0]))
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), 2, match.end()))
    for match in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(match[0])) <= 15:
            found.append((match.start(), 3, match.end()))
    return sorted(found)


# Word shapes. Each word has a place in every group; a code holds all places.
_TRIGGERS = (
    ("phone", "tel", "telefon", "mobile", "fax", "call", "appelez", "llame", "telephone", "cell"),
    ("ssn", "passport", "security", "identity", "nif", "dni"),
    ("mail", "email", "contact", "write", "kontakt", "correo"),
)
_DIGIT_STEPS = np.array([1, 3, 4, 5, 7, 9, 10, 12, 20])  # groups of digit counts start here
_GROUPS = {"digits": 10, "letters": 4, "dashes": 3, "dots": 2, "round": 2, "square": 2, "slash": 2, "trigger": 4}
_SIZES = tuple(_GROUPS.values())
N_CODES = int(np.prod(_SIZES))
# Digits and signs together tell a date from a telephone number.
_JOINT = ("digits", "dashes", "dots", "round")

_LETTER = np.zeros(256, bool)
for _first, _last in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _LETTER[_first : _last + 1] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True


def _word_hash(word: bytes) -> int:
    value = 0
    for byte in word:
        value = (value + (byte | 0x100) * (byte | 0x100) * 40503) & 0xFFFFFFFF
    return value ^ len(word)


_SQUARES = ((np.arange(256, dtype=np.uint64) | 0x100) ** 2 * 40503).astype(np.uint64)
# Sums of squared letters ignore their order; the first letter is checked as well.
_TRIGGER_OF = {(_word_hash(w.encode()), w[0]): i + 1 for i, words in enumerate(_TRIGGERS) for w in words}


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, chain)`` of every word: runs without blanks, cut at texts.

    ``chain`` numbers the sentences and lines; words of one chain are decoded
    together.
    """
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    word = ~_SPACE[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets[offsets <= len(data)]] = True
    opens = opens[:-1]
    before = np.concatenate(([False], word[:-1]))
    start = np.flatnonzero(word & (~before | opens))
    closes = np.concatenate((opens[1:], [True]))
    after = np.concatenate((word[1:], [False]))
    end = np.flatnonzero(word & (~after | closes)) + 1
    line = np.cumsum((data == 0x0A) | opens)[start]
    # A number after a full stop ("Tel. 030") goes on with the sentence.
    stops = _ENDS[data[end[:-1] - 1]] & _LETTER[data[start[1:]]]
    return start, end, np.cumsum(np.concatenate(([False], (np.diff(line) > 0) | stops)))


def _codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Shape code of each word."""
    if not len(start):
        return np.zeros(0, np.int64)
    place = np.repeat(np.arange(len(start)), end - start)
    inside = np.arange(len(place)) - np.repeat(np.cumsum(end - start) - (end - start), end - start) + np.repeat(start, end - start)
    byte = data[inside]
    edges = np.cumsum(end - start) - (end - start)

    def count(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.int32), edges)

    digit = (byte >= 0x30) & (byte <= 0x39)
    upper, lower = (byte >= 0x41) & (byte <= 0x5A), (byte >= 0x61) & (byte <= 0x7A) | (byte >= 0x80)
    uppers, lowers = count(upper), count(lower)
    first_upper = upper[edges]
    letters = np.where(uppers + lowers == 0, 0, np.where(uppers == 0, 1, np.where((uppers == 1) & first_upper, 2, 3)))
    # Dots at the end of a word are punctuation.
    last = np.zeros(len(byte), bool)
    last[edges + (end - start) - 1] = True
    values = {
        "digits": np.searchsorted(_DIGIT_STEPS, count(digit), "right"),
        "letters": letters,
        "dashes": np.minimum(count(byte == 0x2D), 2),
        "dots": count((byte == 0x2E) & ~last) > 0,
        "round": count((byte == 0x28) | (byte == 0x29)) > 0,
        "square": count((byte == 0x5B) | (byte == 0x5D)) > 0,
        "slash": count(byte == 0x2F) > 0,
    }
    letter = upper | lower
    folded = _LOWER[byte]
    total = np.add.reduceat(np.where(letter, _SQUARES[folded], 0), edges)
    value = (total & np.uint64(0xFFFFFFFF)) ^ (uppers + lowers).astype(np.uint64)
    trigger = np.zeros(len(start), np.int64)
    plain = (count(digit) == 0) & (uppers + lowers > 0) & (uppers + lowers < 16)
    for (known, first), group in _TRIGGER_OF.items():
        trigger[plain & (value == known) & (folded[edges] == ord(first))] = group
    values["trigger"] = trigger
    return np.ravel_multi_index(tuple(np.asarray(values[g], np.int64) for g in _GROUPS), _SIZES)


@dataclass(frozen=True)
class Field:
    """Scores: codes x labels for the word and its two neighbours, labels x labels for steps."""

    own: np.ndarray
    left: np.ndarray
    right: np.ndarray
    step: np.ndarray


def _features() -> np.ndarray:
    """codes x groups: the number of each code's feature in every group and joint group."""
    places = np.unravel_index(np.arange(N_CODES), _SIZES)
    by_name = dict(zip(_GROUPS, places))
    joint = np.ravel_multi_index(tuple(by_name[g] for g in _JOINT), tuple(_GROUPS[g] for g in _JOINT))
    columns = [*places, joint]
    sizes = [*_SIZES, int(np.prod([_GROUPS[g] for g in _JOINT]))]
    return np.stack([c + s for c, s in zip(columns, np.cumsum([0, *sizes[:-1]]))], axis=1)


_MARK = re.compile(r"\[(email|phone|id)\|(.*?)\](?=\s|$)")


def _example(line: str) -> tuple[str, list[tuple[int, int, str]]]:
    """Text and spans of a marked line."""
    text, spans, end = "", [], 0
    for match in _MARK.finditer(line):
        text += line[end : match.start()]
        spans.append((len(text), len(text) + len(match[2]), match[1]))
        text += match[2]
        end = match.end()
    return text + line[end:], spans


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(examples: tuple[str, ...] = EXAMPLES, rounds: int = 300, rate: float = 0.3, decay: float = 0.002) -> Field:
    """Maximise the penalised likelihood of the labelled lines (a small, fixed table).

    Forward-backward over all lines at once, padded to the longest; the step
    sizes follow the squared gradients, so the result is the same every time.
    """
    chains, answers = [], []
    for line in examples:
        text, spans = _example(line)
        data, offsets = flat(pa.array([text]))
        start, end, _ = _words(data, offsets)
        chains.append(_codes(data, start, end))
        kinds = [next((k for a, b, k in spans if s < b and e > a), "") for s, e in zip(start, end)]
        answers.append([LABELS.index(k) for k in kinds])
    n, longest, k = len(chains), max(map(len, chains)), len(LABELS)
    features = _features()
    size = int(features.max()) + 2  # the last is the border of a line
    border = np.full(features.shape[1], size - 1)
    seen = np.full((n, longest + 2, features.shape[1]), size - 1)
    gold = np.zeros((n, longest), int)
    real = np.zeros((n, longest), bool)
    for i, (chain, answer) in enumerate(zip(chains, answers)):
        seen[i, 1 : len(chain) + 1] = features[chain]
        gold[i, : len(answer)] = answer
        real[i, : len(answer)] = True
    views = [seen[:, 1:-1], seen[:, :-2], seen[:, 2:]]
    weights = [np.zeros((size, k)) for _ in views] + [np.zeros((k, k))]
    squares = [np.full_like(w, 1e-8) for w in weights]
    for _ in range(rounds):
        emit = sum(w[v].sum(2) for w, v in zip(weights, views))
        step = weights[3]
        forward, backward = np.zeros((n, longest, k)), np.zeros((n, longest, k))
        forward[:, 0] = emit[:, 0]
        for t in range(1, longest):
            forward[:, t] = emit[:, t] + _logsum(forward[:, t - 1, :, None] + step, 1)
        for t in range(longest - 2, -1, -1):
            onward = _logsum(step + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(real[:, t + 1, None], onward, 0)
        lasts = real.sum(1) - 1
        total = _logsum(forward[np.arange(n), lasts], 1)
        marginal = np.exp(forward + backward - total[:, None, None]) * real[..., None]
        wanted = np.eye(k)[gold] * real[..., None]
        gradients = []
        for view in views:
            gradient = np.zeros((size, k))
            np.add.at(gradient, view, (wanted - marginal)[:, :, None, :])
            gradients.append(gradient)
        pair = forward[:, :-1, :, None] + step + (emit[:, 1:] + backward[:, 1:])[:, :, None, :]
        both = (real[:, :-1] & real[:, 1:])[..., None, None]
        expected = np.where(both, np.exp(np.minimum(pair - total[:, None, None, None], 0)), 0)
        met = np.eye(k)[gold[:, :-1]][..., :, None] * np.eye(k)[gold[:, 1:]][..., None, :] * both
        gradients.append((met - expected).sum((0, 1)))
        for w, g, s in zip(weights, gradients, squares):
            g -= decay * n * w
            s += g * g
            w += rate * g / np.sqrt(s)
    with_border = np.concatenate([features, border[None]])
    own, left, right = (w[with_border].sum(1).astype(np.float32) for w in weights[:3])
    return Field(own, left, right, weights[3].astype(np.float32))


def viterbi(emit: np.ndarray, chain: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The best label of every word; words of equal ``chain`` follow each other."""
    if not len(emit):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], chain[1:] != chain[:-1])))
    lengths = np.diff(np.append(first, len(chain)))
    order = np.argsort(-lengths, kind="stable")
    first, lengths = first[order], lengths[order]
    k = emit.shape[1]
    back = np.zeros((len(emit), k), np.int8)
    best = emit[first].copy()
    # How many chains are longer than t; chains are sorted, the longest first.
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")
    for t in range(1, lengths[0]):
        live = alive[t]
        scores = best[:live, :, None] + step
        came = scores.argmax(1)
        back[first[:live] + t] = came
        best[:live] = np.take_along_axis(scores, came[:, None, :], 1)[:, 0] + emit[first[:live] + t]
    labels = np.zeros(len(emit), np.int64)
    label = best.argmax(1)
    labels[first + lengths - 1] = label
    for t in range(lengths[0] - 1, 0, -1):
        live = alive[t]
        label[:live] = back[first[:live] + t, label[:live]]
        labels[first[:live] + t - 1] = label[:live]
    return labels


def decode(field: Field, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, label)`` of the words that the field does not leave plain, in bytes."""
    start, end, chain = _words(data, offsets)
    if not len(start):
        return (np.zeros(0, np.int64),) * 3
    code = _codes(data, start, end)
    border = N_CODES
    same = chain[1:] == chain[:-1]
    left = np.concatenate(([border], np.where(same, code[:-1], border)))
    right = np.concatenate((np.where(same, code[1:], border), [border]))
    emit = field.own[code] + field.left[left] + field.right[right]
    labels = viterbi(emit, chain, field.step)
    some = np.flatnonzero(labels)
    if not len(some):
        return (np.zeros(0, np.int64),) * 3
    # A label's words in one chain form one span.
    joined = np.concatenate(([False], (np.diff(some) == 1) & (labels[some][1:] == labels[some][:-1]) & (chain[some][1:] == chain[some][:-1])))
    opens = np.flatnonzero(~joined)
    closes = np.append(opens[1:], len(some)) - 1
    return start[some[opens]], end[some[closes]], labels[some[opens]]


_TRIM = " \t\r\n,;:.!?\"'"


def _checked(text: str, start: int, end: int, kind: str) -> tuple[int, int] | None:
    """The span without outer punctuation, None if it cannot be what the field says."""
    while start < end and text[start] in _TRIM:
        start += 1
    while end > start and text[end - 1] in _TRIM:
        end -= 1
    part = text[start:end]
    digits = len(_DIGITS.findall(part))
    fits = {
        "phone": 7 <= digits <= 15 and not re.search(r"[^0-9 ()./-]", part),
        "id": bool(re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}|(?=[A-Z0-9]*[0-9])(?=[A-Z0-9]*[A-Z])[A-Z0-9]{7,10}", part)),
        "email": bool(re.fullmatch(r"[A-Za-z0-9._%+-]+(\(at\)|\[at\])[A-Za-z0-9-]+((\.|\[dot\]|\(dot\))[A-Za-z0-9-]+)+", part)),
    }
    return (start, end) if fits[kind] else None


def _spans(piece: pa.RecordBatch, field: Field) -> list[list[tuple[Span, bool]]]:
    data, offsets = flat(piece.column("text"))
    found: list[list[tuple[Span, bool]]] = [[] for _ in range(piece.num_rows)]
    signs = np.concatenate(([0], np.cumsum(((data >= 0x30) & (data <= 0x39)) | (data == 0x40))))
    texts: dict[int, str] = {}
    for row in np.flatnonzero(signs[offsets[1:]] > signs[offsets[:-1]]):
        texts[int(row)] = piece.column("text")[int(row)].as_py()
        found[row] = [(span, True) for span in base_spans(texts[int(row)])]
    starts, ends, labels = decode(field, data, offsets)
    rows = np.searchsorted(offsets, starts, "right") - 1
    for row, start, end, label in zip(rows.tolist(), starts.tolist(), ends.tolist(), labels.tolist()):
        text = texts.setdefault(row, piece.column("text")[row].as_py())
        at = int(offsets[row])
        points = [len(bytes(data[at:x]).decode()) for x in (start, end)]
        kept = _checked(text, points[0], points[1], LABELS[label])
        if kept and all(kept[1] <= s or kept[0] >= e for (s, _, e), _ in found[row]):
            found[row].append(((kept[0], KINDS.index(LABELS[label]), kept[1]), False))
    return [sorted(spans) for spans in found]


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


@functools.lru_cache(maxsize=1)
def _default_field() -> Field:
    return train()


RESULT = "spans array<struct<kind string, start long, `end` long, base boolean>>, base_sha256 string"


def find_personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, spans, base_sha256`` of every whole text.

    Spans are in code points, the end exclusive, by start and then kind; ``base``
    tells a pattern's spans from those the field adds, which never overlap a
    base span. ``base_sha256`` is the digest of the base spans as written. A
    null or empty text has none; null and repeated ids keep their rows; other
    columns are ignored.
    """
    field = field or _default_field()
    of = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def work(piece: pa.RecordBatch) -> pa.RecordBatch:
        spans, digests = [], []
        for found in _spans(piece, field):
            spans.append([{"kind": KINDS[k], "start": s, "end": e, "base": base} for (s, k, e), base in found])
            digests.append(hashlib.sha256(written([span for span, base in found if base]).encode()).hexdigest())
        columns = [piece.column("doc_id"), pa.array(spans, pa.list_(of)), pa.array(digests, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "spans", "base_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), "text", work, f"doc_id {kind}, {RESULT}")
