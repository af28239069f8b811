import hashlib
import re
import zlib
from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st
from small import prose

from aerocell.llm.conversations import Repair, audit_conversations, repair_conversations
from aerocell.llm.queries import QUERIES

ROWS = "conv_id long, turn long, role string, text string"
LEGAL = re.compile("(s?(ua)+)?")
BLANKS = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """``(cost, audit, repaired)`` with whole strings for every state; ``rows`` has (role, text, fault)."""
    # State: the initials so far, cut to what matters: nothing, s, u or a last.
    best = {"": (0, "", [])}

    def offer(into, state, way):
        if state not in into or way[:2] < into[state][:2]:
            into[state] = way

    def goes(state, initial):
        return {"s": "s" if state == "" else None, "u": "u" if state != "u" else None, "a": "a" if state == "u" else None}.get(initial)

    def inserted(ways):
        out = dict(ways)
        for _ in range(3):
            for state, (cost, audit, kept) in list(out.items()):
                for role in ("user", "assistant"):
                    if goes(state, role[0]):
                        offer(out, role[0], (cost + 2, audit + "I", [*kept, (role, "")]))
        return out

    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, kept) in inserted(best).items():
            offer(after, state, (cost + 3, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            if role[:1] and goes(state, role[:1]):
                offer(after, role[:1], (cost + more, audit + "K", [*kept, (role, text)]))
            for new in ("user", "assistant"):
                if goes(state, new[0]):
                    offer(after, new[0], (cost + 2 + more, audit + "R", [*kept, (new, text)]))
        best = after
    return min(way for state, way in inserted(best).items() if state in ("", "a"))


def damage(rows):
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv_id, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))


def brute(rows):
    out = {}
    for conv_id in {r[0] for r in rows}:
        own = [r for r in damage(rows) if r[0] == conv_id]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        checked, seen = [], set()
        for _, _, role, text in own:
            bare = text.strip(BLANKS)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            checked.append((role, text, fault))
        cost, audit, kept = cheapest(checked)
        assert LEGAL.fullmatch("".join(r[:1] for r, _ in kept))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [f for *_, f in checked]
        initials = [r[:1] for r, *_ in checked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv_id] = (gaps, *counts, illegal, cost, audit, digest)
    return out


NAMES = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def answers(rows):
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in rows.collect()}


def test_query_equals_brute_force(spark, tmp_path):
    texts = ["Yes.", "No!", "So", "", " \n", None, "What? ", "a" * 3000 + ".", "naïve 漢字", "Yes."]
    roles = ["user", "assistant", "system", None, "", "tool", "user", "assistant"]
    rows = []
    for c in range(400):
        for t in range((c * 7) % 13):
            role = roles[zlib.crc32(b"r%d:%d" % (c, t)) % 8] if c % 3 else ("assistant" if t % 2 else "user")
            rows.append((c, None if (c + t) % 17 == 0 else t * (1 + c % 2), role, texts[zlib.crc32(b"t%d:%d" % (c, t)) % 10]))
    rows += [(None, t, "user", f"{t}.") for t in (3, None, 1)] + [(1000, None, None, None), (1001, -5, "system", "Go.")]
    # Rows given twice, several roles on one turn, and a conversation that loses all its rows.
    rows += rows[:60] + [(2000, 1, r, t) for r, t in product(["user", "assistant"], ["b.", "a.", "a"])]
    gone = next(c for c in range(3000, 9000) if zlib.crc32(b"%d:1" % c) % 20 == 0)
    rows.append((gone, 1, "user", "Lost."))
    # One conversation of a third of all rows.
    rows += [(5000, t, roles[(t * t + t // 7) % 8], texts[t * 3 % 10] if t % 4 else f"Turn {t}.") for t in range(900)]
    spark.createDataFrame(rows, ROWS).selectExpr("*", "0 AS fault", "true AS present").write.parquet(f"{tmp_path}/conversations.parquet")
    got, want = answers(QUERIES["op12_conversation_repair"](spark, str(tmp_path))), brute(rows)
    assert got.keys() == want.keys()
    for conv_id in want:
        assert got[conv_id] == want[conv_id], conv_id
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table_and_other_ids(spark):
    none = spark.createDataFrame([], ROWS)
    assert audit_conversations(none).collect() == [] and repair_conversations(none).collect() == []
    rows = spark.createDataFrame([("a", 2, "user", "Hi."), ("a", 5, "user", "Ho.")], ROWS.replace("conv_id long", "conv_id string"))
    (one,) = audit_conversations(rows).collect()
    assert (one.conv_id, one.gaps, one.audit, one.cost) == ("a", 2, "KR", 2)
    turns = [tuple(r) for r in repair_conversations(rows).collect()]
    assert turns == [("a", 0, "K", 2, "user", "Hi."), ("a", 1, "R", 5, "assistant", "Ho.")]


def test_repaired_turns_carry_the_digest(spark):
    rows = [(c, t, ["user", "assistant", "system"][zlib.crc32(b"%d %d" % (c, t)) % 3], prose(c * 50 + t, 5) + ".") for c in range(30) for t in range(c)]
    frame = spark.createDataFrame(rows, ROWS)
    turns = {}
    for r in repair_conversations(frame).collect():
        turns.setdefault(r.conv_id, {})[r.position] = f"{r.role}:{r.text}"
    for r in audit_conversations(frame).collect():
        own = turns.get(r.conv_id, {})
        assert sorted(own) == list(range(r.n_repaired))
        assert hashlib.sha256("\n".join(own[i] for i in sorted(own)).encode()).hexdigest() == r.repaired_sha256


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.integers(0, 3)), max_size=14))
def test_any_conversation(rows):
    names = ["", "blank", "duplicate", "truncated"]
    edits, kept = [], []
    repair = Repair(lambda e, turns: (edits.append(e), kept.extend((r, t) for _, _, r, t in turns)))
    for i, (role, fault) in enumerate(rows):
        repair.add(role[:1], fault, i, role, str(i))
    cost = repair.end()
    assert (cost, "".join(edits), kept) == cheapest([(r, str(i), names[f]) for i, (r, f) in enumerate(rows)])


def pending(rows):
    repair = Repair(lambda edits, turns: None)
    for i, (role, fault) in enumerate(rows):
        repair.add(role[0], fault, i, role, "x")
    return repair.most_pending


def test_memory_is_bounded():
    assert pending([("user", 0), ("assistant", 0)] * 5000) < 10
    # Any number of deleted rows is one step of each path.
    assert pending([("system", 0)] + [("user", 1)] * 5000 + [("user", 0)]) < 10
    assert pending([("user", 3), ("user", 0), ("system", 2), ("assistant", 0), ("system", 3)] * 3000) < 40
    assert pending([("system", 3)] * 5000) < 40


def test_a_text_of_three_megabytes(spark):
    text = "word " * 600_000
    rows = [(1, 0, "user", text), (1, 1, "assistant", text + "end."), (1, 2, "user", text)]
    (one,) = audit_conversations(spark.createDataFrame(rows, ROWS)).collect()
    # Cut off twice, and the second time a repeat.
    assert (one.truncated, one.duplicate, one.audit, one.cost) == (1, 1, "KKD", 4)
    assert one.repaired_sha256 == hashlib.sha256(f"user:{text}\nassistant:{text}end.".encode()).hexdigest()


def test_one_exchange_deals_conversations_out(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a.")], ROWS)
    text = audit_conversations(rows)._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning(conv_id") == physical.count("Exchange ") == 1
