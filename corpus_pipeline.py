"""Documents to packed training sequences: five stages, each written as Parquet and read back by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, line_join, order_minhash, packing, secret_scan
from tidemark.llm.queries import tokenizer_path
from tidemark.plans.tables import raw_table
from tidemark.session import settled


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where a stage has changed it."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; null texts, texts without letters and letter salad go.

    The model learns from all labelled documents of the stage's input. Without
    any label there is nothing to tell languages by, and all documents stay.
    """
    model = language_id.train(docs.select("text", "lang"))
    return language_id.keep_identified(docs, model) if model.languages else docs


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines similar to an earlier line; a document may be left with an empty text."""
    return _recounted(line_join.dedup_lines(docs).select(*docs.columns))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; texts without words are one group."""
    return order_minhash.drop_near_duplicates(order_minhash.drop_wordless_copies(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, plain and encoded secrets replaced by a mark of their kind."""
    return _recounted(secret_scan.mask_secrets(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: Language models, alignment and tokenisation have no SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = raw_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
