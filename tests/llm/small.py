"""Small document tables and brute-force helpers shared by the tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, langs=None):
    """Documents 0, 1, ... with these texts (null allowed)."""
    langs = langs or ["en"] * len(texts)
    rows = [(i, t, langs[i], "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def saved(spark, tmp_path, texts, langs=None):
    """A folder with those documents, as the registered queries read them."""
    docs_of(spark, texts, langs).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def prose(seed, words, vocabulary=400):
    """Invented words, each text by its own seed."""
    pick = random.Random(seed)
    known = ["".join(random.Random(i).choices("abcdefghilmnorstuv", k=2 + i % 8)) for i in range(vocabulary)]
    return " ".join(pick.choice(known) for _ in range(words))


AWKWARD = [
    None,
    "",
    " \n\t ",
    "a",
    "...",
    "naïve Ünïcode ß 漢字 \U0001f600 text",
    "x" * 5000,
    "word " * 3000,
    "line\n\n\nline\r\nline",
    "nul \x00 byte",
    "word " * 3000,
]
