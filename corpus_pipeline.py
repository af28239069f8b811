"""From raw documents to token ids, stage by stage; each stage reads what the one before it wrote."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aerocell.llm import bpe, language
from aerocell.llm.decontaminate import without_contaminated
from aerocell.llm.lines import without_duplicate_lines
from aerocell.llm.near_dedup import one_of_each
from aerocell.session import collected, remove_folder, shared_dir, shuffles_removed, stored_roots

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

# No SQL expresses the mixtures, the fuzzy lines or the token ids.
ORACLE_SQL = None


# Folders of intermediate tables that the last stage has left.
_LEFT: list[str] = []


def _stage(work):
    """A stage that first removes what the one before it wrote on its way.

    By then that one's result has been written and read again, so its
    intermediate tables are of no use; what ``docs`` itself reads stays. One
    pipeline runs in a driver at a time.
    """

    @functools.wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _release(spark, docs)
        with collected() as made:
            result = work(spark, docs, sf_dir)
        _LEFT.extend(made)
        return result

    return run


def _release(spark: SparkSession, docs: DataFrame) -> None:
    used = " ".join(stored_roots(docs))
    for folder in [f for f in _LEFT if f.rsplit("/", 1)[-1] not in used]:
        remove_folder(spark, folder)
        _LEFT.remove(folder)


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, by a model of all labelled documents that are not held out."""
    return language.in_known_language(docs, language.train_on_rest(docs))


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each line or its like kept once in the corpus."""
    return without_duplicate_lines(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 on shingles of five words.

    Candidates are texts with near SimHash fingerprints, found by deletion
    variants, and texts that share a band of minima of these shingles, so block
    edits are found like scattered ones, at 0.8 with a probability of 0.9992.
    """
    return one_of_each(docs, similarity=0.8, similarity_words=5)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers and digests of the token ids and of the bytes that they decode to."""
    return bpe.round_trip(docs, VOCABULARY, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back.

    What a stage writes on its way is removed when its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark)
    for name, stage in STAGES:
        with shuffles_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        _release(spark, docs)
    return docs
