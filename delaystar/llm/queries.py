"""Registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from delaystar.llm import bpe, byte_cnn, chat, collocations, cover_tree, fingerprints, jaccard, lang_kernel, mixing, periodic, quality_rules, urls, warc
from delaystar.llm.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(read_table(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(read_table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(read_table(spark, sf_dir, "documents"))


def op4_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return byte_cnn.score_documents(documents, byte_cnn.train(documents, read_table(spark, sf_dir, "labels")))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return lang_kernel.predict_languages(documents, lang_kernel.train(documents))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read_table(spark, sf_dir, "pages"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(spark, read_table(spark, sf_dir, "conversations"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return quality_rules.judge_documents(documents, quality_rules.train(documents, read_table(spark, sf_dir, "labels")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(read_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op13_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_warc, op2_mixing, op3_bpe, op4_byte_cnn, op5_fingerprints, op6_language_id, op7_url_filter, op8_jaccard_join, op9_chat_format, op10_quality_rules,
    op11_periodic_runs, op12_collocations, op13_cover_tree,
)}

QUERIES["pipeline"] = corpus_pipeline.run

SQL: dict[str, str] = {
    "op1_warc": warc.oracle(), "op2_mixing": mixing.oracle(), "op7_url_filter": urls.oracle(), "op9_chat_format": chat.oracle(),
    "op12_collocations": collocations.oracle(),
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
