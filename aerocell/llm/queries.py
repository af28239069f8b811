"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocell.llm import bpe, language, pii, quality, scoring
from aerocell.llm.conversations import audit_conversations
from aerocell.llm.decontaminate import contaminated
from aerocell.llm.lengths import context_limits, length_histogram
from aerocell.llm.licenses import scan_licenses
from aerocell.llm.lines import duplicate_lines
from aerocell.llm.near_dedup import near_duplicates
from aerocell.llm.negatives import hard_negatives
from aerocell.llm.simhash import document_fingerprints, likeness
from aerocell.llm.votes import as_hex

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@register
def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Languages of every document, learnt from the documents that are not held out."""
    docs = documents(spark, sf)
    found = language.infer(docs, language.train_on_rest(docs))
    return found.select(
        "doc_id",
        (language.remainder() == 1).alias("held_out"),
        "lang_pred",
        "score",
        F.array_join(F.transform("languages", lambda x: x["lang"]), ",").alias("languages"),
        "noise",
    )


@register
def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What every possible context limit keeps of the corpus."""
    lengths = bpe.count_tokens(documents(spark, sf), VOCABULARY, public_tokenizers.PATTERN)
    return context_limits(length_histogram(lengths))


@register
def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of every document, learnt from weak labellers only."""
    docs = documents(spark, sf)
    scored = quality.score_quality(docs, quality.train(docs))
    return scored.select("*", (F.col("score") >= 0.5).alias("keep"))


@register
def op4_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """SimHash of every document and of its edited text, and how alike they are."""
    own = F.col("fingerprint")
    return document_fingerprints(documents(spark, sf)).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_hex(own).alias("fingerprint"),
        as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(own, F.col("next_fingerprint")).alias("near_next"),
        "n_near",
    )


@register
def op5_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return near_duplicates(documents(spark, sf))


@register
def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items that documents repeat, with the most similar window."""
    return contaminated(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@register
def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that each document loses to an equal or similar line before them."""
    return duplicate_lines(documents(spark, sf)).select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join(F.col("dropped").cast("array<string>"), ",").alias("dropped"),
    )


@register
def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans."""
    found = pii.find_personal_data(documents(spark, sf))

    def number(kind: str):
        own = F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
        return F.size(own).cast("long").alias(f"n_{kind}")

    shown = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return found.select(
        "doc_id", *map(number, pii.BASE_KINDS), "base_sha256", F.array_join(shown, ",").alias("spans")
    )


@register
def op9_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document and the bytes that they decode to, as digests."""
    return bpe.round_trip(documents(spark, sf), VOCABULARY, public_tokenizers.PATTERN)


@register
def op10_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Notices, labels and reuse score of every document."""
    base = F.filter("matches", lambda m: m["base"])
    words = F.transform(base, lambda m: m["word"])
    found = F.array_sort(F.array_distinct(F.transform(base, lambda m: m["label"])))
    return scan_licenses(documents(spark, sf)).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        F.array_join(found, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@register
def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """For every hundredth vector and its positives, the best rows of other labels just below them."""
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    # Some labels are made wrong on purpose.
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", wrong), F.col("vec_id") % 100 == 0)


ORACLE_SQL["op11_hard_negatives"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, br) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.ar, p.br ORDER BY n.score DESC, n.vec_id, n.br) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.ar = p.ar AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY row_number() OVER (PARTITION BY p.ar, p.br ORDER BY n.score DESC, n.vec_id, n.br) <= 5
"""


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present``: every 20th row dropped, emptied, cut, repeated or given to the user."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    kind = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c), blank) for c in ("role", "text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        copies.alias("copy"),
    ).drop("copy")


@register
def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults of every conversation after damage, and its cheapest repair."""
    rows = damaged(spark.read.parquet(f"{sf}/conversations.parquet"))
    return audit_conversations(rows, F.col("present")).drop("most_pending")


# The cheapest repair step by step: every row goes from each state with none, one or two turns inserted before it.
ORACLE_SQL["op12_conversation_repair"] = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)) AS tab
), src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_transform(
      string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda ch: CAST(ascii(ch) AS BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295)) % 20 AS kind
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM src, (VALUES (1), (2)) AS copies(n) WHERE kind <> 0 AND (n = 1 OR kind = 3)
), counted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged
), numbered AS (
  SELECT *, row_number() OVER w AS i, lag(left(role, 1)) OVER w AS before, left(role, 1) AS initial,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
  FROM counted WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth)
), checked AS (
  SELECT *, CASE WHEN bare = '' THEN 1 WHEN nth > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM numbered
), inserts(old, n, mid, turns) AS (VALUES
  ('', 0, '', ''), ('', 1, 'u', E'\nuser:'), ('', 2, 'a', E'\nuser:\nassistant:'),
  ('s', 0, 's', ''), ('s', 1, 'u', E'\nuser:'), ('s', 2, 'a', E'\nuser:\nassistant:'),
  ('u', 0, 'u', ''), ('u', 1, 'a', E'\nassistant:'), ('u', 2, 'u', E'\nassistant:\nuser:'),
  ('a', 0, 'a', ''), ('a', 1, 'u', E'\nuser:'), ('a', 2, 'a', E'\nuser:\nassistant:')
), follows(mid, next) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')
), ways(edit, old, n, turns, initial, next, price) AS (
  SELECT 'D', old, n, turns, NULL, mid, 3 FROM inserts
  UNION ALL SELECT 'K', old, n, turns, next, next, 0 FROM inserts JOIN follows USING (mid)
  UNION ALL SELECT 'R', old, n, turns, NULL, next, 2 FROM inserts JOIN follows USING (mid) WHERE next <> 's'
), steps(conv_id, i, state, cost, audit, body) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '', 0, '', '' FROM checked
  UNION ALL
  SELECT conv_id, i, state, cost, audit, body FROM (
    SELECT s.conv_id, c.i, w.next AS state, s.cost + 2 * w.n + w.price + CASE WHEN fault = 3 AND edit <> 'D' THEN 1 ELSE 0 END AS cost,
      s.audit || repeat('I', w.n) || w.edit AS audit,
      s.body || w.turns || CASE w.edit WHEN 'D' THEN '' WHEN 'K' THEN E'\n' || c.role || ':' || c.text
        ELSE E'\n' || CASE w.next WHEN 'u' THEN 'user:' ELSE 'assistant:' END || c.text END AS body
    FROM steps s JOIN checked c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.i = s.i + 1
      JOIN ways w ON w.old = s.state AND (w.edit = 'D' OR c.fault NOT IN (1, 2)) AND (w.initial IS NULL OR w.initial = c.initial)
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, i, state ORDER BY cost, audit) = 1
), sums AS (
  SELECT conv_id, max(i) AS last, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM checked GROUP BY conv_id
), repaired AS (
  SELECT u.*, s.cost + 2 * n AS cost, s.audit || repeat('I', n) AS audit, substr(s.body || turns, 2) AS body
  FROM sums u JOIN steps s ON s.conv_id IS NOT DISTINCT FROM u.conv_id AND s.i = u.last
    JOIN inserts ON old = s.state AND mid IN ('', 'a')
  QUALIFY row_number() OVER (PARTITION BY u.conv_id ORDER BY s.cost + 2 * n, s.audit || repeat('I', n)) = 1
)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256,
  CAST(length(replace(coalesce(audit, ''), 'D', '')) AS BIGINT) AS n_repaired
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
"""


@register
def op13_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Log-probability of every document, learnt from the documents that are not held out."""
    docs = documents(spark, sf)
    return scoring.score_texts(docs, scoring.train_on_rest(docs), language.remainder(parts=7) == 2)
