"""Conversation repair: the cheapest edits that make roles alternate, by a Viterbi search that emits as it goes.

A conversation is read once, in order. The best way to each state is a path in
a tree of backpointers; as soon as all surviving paths share an ancestor, the
edits up to it are certain and leave memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerocell.llm.votes import BLANKS

SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1

# What the repaired turns so far end with: nothing, a system, a user or an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEVER = 1 << 60
_TARGET = {_USER: "user", _ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}

SUMMARY = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string, n_repaired long, most_pending long"
)
TURNS = "conv_id {id}, position long, edit string, turn long, role string, text string"


class _Node:
    """One step of a path: its edits, the turns that they leave, and how many paths go on from it."""

    __slots__ = ("depth", "edits", "parent", "refs", "run", "turns")

    def __init__(self, parent: _Node | None, edits: str, turns: tuple):
        self.parent, self.edits, self.turns = parent, edits, turns
        self.depth = parent.depth + 1 if parent else 0
        self.refs, self.run = 0, 1


def _less(p: _Node, p_edits: str, q: _Node, q_edits: str) -> bool:
    """Whether the whole unresolved edits of one path come before the other's."""
    left, right = [p_edits], [q_edits]
    while p is not q:
        if p.depth >= q.depth:
            left.append(p.edits * p.run)
            p = p.parent
        else:
            right.append(q.edits * q.run)
            q = q.parent
    return "".join(reversed(left)) < "".join(reversed(right))


class Repair:
    """The search over one conversation; ``emit(edits, turns)`` gets what is certain, in order."""

    def __init__(self, emit: Callable[[str, tuple], None]):
        self.emit = emit
        self.root = _Node(None, "", ())
        self.root.refs = 1
        self.paths: list[tuple[int, _Node] | None] = [(0, self.root), None, None, None]
        self.pending = 0
        self.most_pending = 0

    def _ways(self, initial: str, fault: int) -> Iterator[tuple[int, int, int, str]]:
        """Old state, new state, cost and edits for the next row.

        A turn is inserted only right before one that stays: behind a deleted
        row it costs the same and its edits come first.
        """
        for state in range(4):
            yield state, state, DELETE_COST, DELETE
        if fault in (BLANK, DUPLICATE):
            return
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        if initial == "s":
            yield _START, _SYSTEM, more, KEEP
        for new, letter in ((_USER, "u"), (_ASSISTANT, "a")):
            cost, edit = (more, KEEP) if initial == letter else (more + REROLE_COST, REROLE)
            for state in range(4):
                direct = (state == _USER) == (new == _ASSISTANT)
                yield (state, new, cost, edit) if direct else (state, new, cost + INSERT_COST, INSERT + edit)

    def add(self, initial: str, fault: int, turn: int | None, role: str, text: str) -> None:
        """The next row of the conversation."""
        best: list[tuple[int, _Node, str] | None] = [None] * 4
        for state, new, cost, edits in self._ways(initial, fault):
            path = self.paths[state]
            if path is None:
                continue
            cost += path[0]
            now = best[new]
            if now is None or cost < now[0] or cost == now[0] and _less(path[1], edits, now[1], now[2]):
                best[new] = (cost, path[1], edits)
        self._drop_hopeless(best)
        held = {id(path[1]): path[1] for path in self.paths if path}
        users: dict[int, int] = {}
        for way in best:
            if way:
                users[id(way[1])] = users.get(id(way[1]), 0) + 1
        after: list[tuple[int, _Node] | None] = [None] * 4
        for state, way in enumerate(best):
            if way is None:
                continue
            cost, parent, edits = way
            if edits == DELETE == parent.edits and parent.refs == users[id(parent)] == 1 and parent is not self.root:
                # A run of deleted rows is one node, however long.
                parent.run += 1
                held.pop(id(parent))
                after[state] = (cost, parent)
                continue
            turns = ()
            if edits[-1] != DELETE:
                kept = (edits[-1], turn, role if edits[-1] == KEEP else _TARGET[state], text)
                between = _USER if state == _ASSISTANT else _ASSISTANT
                turns = ((INSERT, None, _TARGET[between], ""), kept) if len(edits) > 1 else (kept,)
            node = _Node(parent, edits, turns)
            node.refs = 1
            parent.refs += 1
            self.pending += 1
            after[state] = (cost, node)
        self.paths = after
        for node in held.values():
            self._release(node)
        self._coalesce()
        self.most_pending = max(self.most_pending, self.pending)

    def _drop_hopeless(self, best: list) -> None:
        """Forget states from which every end is dearer than from another state.

        From an assistant turn on, all goes that goes from a system turn, and
        all that goes from the start but for a kept system row, which is deleted.
        """
        system, user, assistant = (best[s][0] if best[s] else _NEVER for s in (_SYSTEM, _USER, _ASSISTANT))
        closed = min(assistant, user + INSERT_COST)
        if system > closed:
            best[_SYSTEM] = None
        if best[_START] and best[_START][0] > closed + DELETE_COST:
            best[_START] = None
        if user > assistant + INSERT_COST:
            best[_USER] = None
        if assistant > user + INSERT_COST:
            best[_ASSISTANT] = None

    def _release(self, node: _Node | None) -> None:
        while node is not None:
            node.refs -= 1
            if node.refs or node is self.root:
                return
            self.pending -= 1
            node = node.parent

    def _coalesce(self) -> None:
        """Emit the edits that all surviving paths have in common."""
        if self.root.refs != 1:
            return
        node = next(path[1] for path in self.paths if path)
        way = []
        while node is not self.root:
            way.append(node)
            node = node.parent
        for node in reversed(way):
            if self.root.refs != 1:
                break
            self.emit(node.edits * node.run, node.turns)
            node.parent = None
            self.root = node
            self.pending -= 1

    def end(self) -> int:
        """Emit the rest of the cheapest path; its cost."""
        best = None
        for state, edits in ((_START, ""), (_ASSISTANT, ""), (_USER, INSERT), (_SYSTEM, INSERT + INSERT)):
            path = self.paths[state]
            if path is None:
                continue
            cost = path[0] + INSERT_COST * len(edits)
            if best is None or cost < best[0] or cost == best[0] and _less(path[1], edits, best[1], best[2]):
                best = (cost, path[1], edits)
        cost, node, edits = best
        way = []
        while node is not self.root:
            way.append(node)
            node = node.parent
        for node in reversed(way):
            self.emit(node.edits * node.run, node.turns)
        added = ((INSERT, None, "user", ""), (INSERT, None, "assistant", ""))
        self.emit(edits, added[2 - len(edits) :])
        return cost


class _Conversation:
    """What is known of the conversation that a task is reading."""

    def __init__(self, conv_id, turns: list | None):
        self.conv_id, self.out = conv_id, turns
        self.faults = [0] * 4
        self.illegal = self.distinct = self.repaired = self.edits = 0
        self.least = self.most = self.last = None
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.repair = Repair(self._emit)

    def _emit(self, edits: str, turns: tuple) -> None:
        if edits and self.out is None:
            self.audit.append(edits)
        for edit, turn, role, text in turns:
            if self.out is not None:
                self.out.append((self.conv_id, self.repaired, edit, turn, role, text))
            else:
                self.digest.update(f"{chr(10) if self.repaired else ''}{role}:{text}".encode())
            self.repaired += 1

    def add(self, turn: int | None, fault: int, role: str, text: str) -> None:
        initial = role[:1]
        self.faults[fault] += 1
        if self.last is not None and self.last + initial not in _LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.distinct += 1
        self.repair.add(initial, fault, turn, role, text)

    def summary(self) -> tuple:
        cost = self.repair.end()
        gaps = self.most - self.least + 1 - self.distinct if self.distinct else 0
        return (
            self.conv_id,
            gaps,
            self.faults[BLANK],
            self.faults[DUPLICATE],
            self.faults[TRUNCATED],
            self.illegal,
            cost,
            "".join(self.audit),
            self.digest.hexdigest(),
            self.repaired,
            self.repair.most_pending,
        )


def _reader(whole: bool, names: list[str], types: list[pa.DataType]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def packed():
            columns = zip(*out) if out else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "present", "turn", "fault", "role", "text"))
            for conv_id, present, turn, fault, role, text in zip(*columns):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        last = now.summary()
                        if not whole:
                            out.append(last)
                    now = _Conversation(conv_id, out if whole else None)
                if present:
                    now.add(turn, fault, role, text)
            yield packed()
            out.clear()
        if now is not None:
            last = now.summary()
            if not whole:
                out.append(last)
        yield packed()

    return read


def checked_rows(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """``conv_id, present, turn, role, text, fault`` in the order in which a task reads them.

    A conversation's rows are together and sorted by turn (nulls first), role
    and text. ``fault`` is the first of blank, duplicate (role and text seen
    earlier in the conversation) and truncated that applies.
    """
    text = F.coalesce(F.col("text"), F.lit(" "))
    plain = rows.select(
        "conv_id",
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        text.alias("text"),
    )
    together = plain.repartition("conv_id")
    # Partitioned by more than the exchange's column: sorted in place, not dealt again.
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy("turn")
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (
        F.when(bare == "", BLANK)
        .when(F.col("_nth") > 1, DUPLICATE)
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
    )
    numbered = together.withColumn("_nth", F.row_number().over(same))
    # The first of equal rows is no duplicate, so it has to come first.
    in_order = numbered.sortWithinPartitions("conv_id", "turn", "role", "text", "_nth")
    return in_order.select("conv_id", "present", "turn", "role", "text", fault.alias("fault"))


def _streamed(rows: DataFrame, present: Column | None, whole: bool, schema: str) -> DataFrame:
    checked = checked_rows(rows, present)
    schema = schema.format(id=checked.schema["conv_id"].dataType.simpleString())
    empty = rows.sparkSession.createDataFrame([], schema)
    arrow = empty.toArrow().schema
    return checked.mapInArrow(_reader(whole, arrow.names, arrow.types), schema)


def audit_conversations(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per conversation: its faults, and the cost, edits and digest of its cheapest repair.

    ``rows`` has ``conv_id, turn, role, text``; further columns are ignored. Null
    roles and texts are one blank; a null id is a conversation; rows of one turn
    are ordered by role and text, and equal rows are repeats. Rows for which
    ``present`` is false or null only name their conversation: one without any
    other has zeros, no edits and the digest of an empty text. An empty table
    gives no rows.

    Roles are told by their first letter, and a repaired conversation reads
    system (at most once), then user and assistant in turns, or nothing. To keep
    a row costs 0, a new role (user or assistant) 2, an inserted empty turn 2, a
    deleted row 3; blank and duplicate rows have to go, and a truncated row that
    stays adds 1. Of the cheapest repairs the one with the least ``audit`` in
    ASCII order counts. ``gaps`` counts missing turns, ``illegal`` neighbours
    that may not follow each other. ``repaired_sha256`` is over ``role:text``
    lines. ``most_pending`` is the most steps that were undecided at once.

    A digest needs its conversation in order, so one task reads it, row by row.
    It holds what is undecided: a few turns, and one step for any number of
    deleted rows; only through a run of turns that all need a new role can
    several ways stay tied, and their texts wait. The audit takes a byte an edit.
    """
    return _streamed(rows, present, False, SUMMARY)


def repair_conversations(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """``conv_id, position, edit, turn, role, text``: the turns of every repaired conversation.

    ``edit`` is K, R or I; inserted turns have a null ``turn``. See
    :func:`audit_conversations` for the edits and what a task holds.
    """
    return _streamed(rows, present, True, TURNS)
