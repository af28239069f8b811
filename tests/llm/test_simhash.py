import hashlib
import random
import re

import pytest
import xxhash
from small import AWKWARD, docs_of, prose, saved

from aerocell.llm.queries import QUERIES
from aerocell.llm.simhash import document_fingerprints, edited_texts, next_ids, within_radius

TEXTS = AWKWARD + [prose(i, 40 + 9 * i) for i in range(14)] + [prose(3, 67), "x y z"] + ["漢字かな混じり文" * 9, "Éa ÉÀ ß"]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    terms = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    votes = [(xxhash.xxh64_intdigest(t.encode(), seed=42), len(t.encode())) for t in terms]
    total = sum(w for _, w in votes)
    return sum(1 << k for k in range(64) if 2 * sum(w for h, w in votes if h >> k & 1) > total)


def test_query_equals_brute_force(spark, tmp_path):
    rows = {r.doc_id: r for r in QUERIES["op4_document_fingerprints"](spark, saved(spark, tmp_path, TEXTS)).collect()}
    assert len(rows) == len(TEXTS)
    texts = [t or "" for t in TEXTS]
    prints = [simhash(t) for t in texts]
    for i, text in enumerate(texts):
        after = texts[i - 1] if i else texts[-1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (f"{prints[i]:016x}", f"{simhash(edited):016x}")
        assert r.near_edited == 1 - (prints[i] ^ simhash(edited)).bit_count() / 64
        assert r.near_next == 1 - (prints[i] ^ prints[i - 1]).bit_count() / 64
        want = sum((prints[i] ^ p).bit_count() <= 3 for p in prints) if i % 20 == 0 else None
        assert r.n_near == want


@pytest.mark.parametrize("radius, blocks", [(3, 6), (3, 4), (0, 1), (5, 8)])
def test_search_finds_all(spark, radius, blocks):
    pick = random.Random(blocks)
    prints = [pick.getrandbits(64) for _ in range(30)]
    prints += [p ^ sum(1 << k for k in pick.sample(range(64), n)) for p in prints for n in range(1, radius + 3)] + prints[:3]
    signed = [(p - 2**64 if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame([*signed, (None,)], "fingerprint long")
    queries = spark.createDataFrame(signed[:40], "fingerprint long")
    got = [(r.query % 2**64, r.found % 2**64) for r in within_radius(queries, df, radius, blocks).collect()]
    want = {(a, b) for a in prints[:40] for b in prints if (a ^ b).bit_count() <= radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_next_of_uneven_ids(spark):
    ids = [5, -3, 2**62, 0, 17, 18, 2**40, 5, None]
    got = {r.doc_id: r.next_id for r in next_ids(spark.createDataFrame([(i,) for i in ids], "doc_id long")).collect()}
    down = sorted({i for i in ids if i is not None}, reverse=True)
    assert got == dict(zip(down, down[1:] + down[:1]))


def test_rows_that_share_an_id(spark):
    rows = [(1, "aaaa bbbb"), (1, "aaaa bbbb"), (2, "cccc"), (None, "dddd"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "5 AS n_rows", "6 AS fingerprint", "7 AS edited")
    got = sorted((str(r.doc_id), r.edited) for r in edited_texts(docs).collect())
    assert got == [("1", "aaaa "), ("1", "aaaa "), ("2", "ccaa"), ("7", ""), ("None", "dd")]
    found = document_fingerprints(docs).collect()
    assert len(found) == 5 and len({r.fingerprint for r in found if r.doc_id == 1}) == 1
    assert document_fingerprints(docs.limit(0)).collect() == []


def test_one_document_is_its_own_next(spark):
    (row,) = edited_texts(docs_of(spark, ["abcdef"])).collect()
    assert row.edited == "abcabc"
