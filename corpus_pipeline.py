"""Corpus pipeline: language ID, quality rules, near-duplicate removal, mixing, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's docs.  All stages but the last return the
columns of documents; the mixing stage returns one row per copy that the mix takes, in
training order, texts whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from delaystar.llm import bpe, jaccard, lang_kernel, mixing, quality_rules
from delaystar.llm.tables import read_table, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts of no learned language, learnt from the documents themselves.

    The latter are those with a score below ``lang_kernel.MIN_SCORE``, which also costs a
    few clean documents (figure there).
    """
    return lang_kernel.keep_languages(docs, lang_kernel.train(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or the trees learned from the labels."""
    return quality_rules.keep_documents(docs, quality_rules.train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingles at 0.8 or more."""
    return jaccard.keep_one_per_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents to the target weights and sorts the copies by training position."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every copy."""
    return bpe.token_digests(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("mixing", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages score with trained models, which SQL cannot express; tests hold run() against a brute-force version.
ORACLE_SQL = None
