import re

import pytest
from small import AWKWARD, docs_of, saved

from aerocell.llm.licenses import BASE_PHRASES, FREEDOM, evaluate, label_of, postfix, scan_licenses
from aerocell.llm.queries import QUERIES

TEXTS = AWKWARD + [
    "Under the MIT License.",
    "mit license mit-license MIT  LICENSE;submit license mit licenses",
    "This work is licensed under the GNU General Public License, version 3.",
    "gnu general\npublic license apache license cc by cc-by ccby",
    "mit license, " * 400,
    "cc byé and écc by, cc by",
    "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\ncode",
    "SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 */",
    "SPDX-License-Identifier: AND OR (",
    "gnu",
    "general public license",
]


def brute(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    found = [
        (i, label)
        for phrase, label in BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in found]
    labels = ",".join(sorted({n for _, n in found}))
    return len(words), len(found), min(starts, default=None), max(starts, default=None), labels


def test_query_equals_brute_force(spark, tmp_path):
    got = {r.doc_id: r for r in QUERIES["op10_license_scan"](spark, saved(spark, tmp_path, TEXTS)).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))


@pytest.mark.parametrize(
    "expression, order",
    [
        ("MIT", "MIT"),
        ("MIT or Apache-2.0 and BSD-3-Clause", "MIT Apache-2.0 BSD-3-Clause and or"),
        ("(MIT OR Apache-2.0) AND ISC", "MIT Apache-2.0 OR ISC AND"),
        ("GPL-2.0 WITH X-exception AND MIT", "GPL-2.0 X-exception WITH MIT AND"),
        ("MIT and ISC and BSD", "MIT ISC and BSD and"),
        ("MIT */ more", "MIT"),
    ],
)
def test_shunting_yard(expression, order):
    # Operators keep the spelling of their first use in lower case.
    assert [t.lower() for t in postfix(expression)] == order.lower().split()


@pytest.mark.parametrize("expression", ["", "AND", "(MIT", "MIT OR", ")", "OR MIT"])
def test_malformed_expressions(expression):
    assert postfix(expression) is None


def test_evaluation():
    assert evaluate(postfix("MIT OR GPL-3.0")) == (FREEDOM["mit"], {"mit", "gpl"})
    assert evaluate(postfix("MIT AND GPL-3.0")) == (FREEDOM["gpl"], {"mit", "gpl"})
    loosened, labels = evaluate(postfix("GPL-2.0 WITH Classpath-exception-2.0"))
    assert loosened > FREEDOM["gpl"] and labels == {"gpl"}
    assert label_of("LGPL-2.1+") == "lgpl" and label_of("CC-BY-4.0") == "cc-by" and label_of("CC0-1.0") == "cc0"


def test_empty_table_and_clashing_columns(spark):
    docs = docs_of(spark, ["mit license", None])
    more = docs.selectExpr("*", "1 AS score", "'x' AS labels", "array(1) AS matches", "2 AS n_words")
    rows = scan_licenses(more).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == [["mit"], []] and rows[0].n_words == 2
    assert scan_licenses(docs.limit(0)).collect() == []


def test_null_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "mit license"), (1, "a"), (1, "a")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_words) for r in scan_licenses(docs).collect()) == [("1", 1), ("1", 1), ("None", 2)]
