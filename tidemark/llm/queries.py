"""One registered query per operator over its whole table; the digest columns derive from the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    jump_shards, language_id, lattice, line_join, metric_join, oracle, order_minhash, packing, periodic_runs, pii_surrogates, ppm,
    scaled_sketch, secret_scan, whitening,
)
from tidemark.plans.tables import raw_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = dict(oracle.SQL)

#: The queries show the operator with a fixed key; a user brings a secret one.
SURROGATE_KEY = "tidemark"


def tokenizer_path(name: str) -> str:
    """Where the installed package of public tokenizer files keeps one; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str):
    def register(f):
        QUERIES[name] = f
        return f

    return register


@query("op2_language_bloom")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = raw_table(spark, sf_dir, "documents")
    out = language_id.held_out("doc_id", 4, 2)
    model = language_id.train(docs.where(~out).select("text", "lang"))
    return language_id.predict(docs.select("doc_id", "text"), model).withColumn("held_out", out)


@query("op4_sum_of_squares_packing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = raw_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs.select("doc_id", "text"), tokenizer_path("word_bpe_49k.json"))


@query("op10_secret_layers")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(raw_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(kind) for kind in secret_scan.KINDS], F.sha2(secret_scan.span_list(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_list(F.col("spans")).alias("spans"),
    )


@query("op3_order_minhash")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(raw_table(spark, sf_dir, "documents"))


@query("op9_line_set_join")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = raw_table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = line_join.dedup_lines(docs)
    return cleaned.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), "text")


@query("op5_ppm")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = raw_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = language_id.held_out("doc_id", 10, 0)
    return ppm.score(docs, ~out).withColumn("held_out", out)


@query("op7_scaled_sketch")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.neighbours_compared(raw_table(spark, sf_dir, "documents"))


@query("op6_metric_range_join")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_vectors(raw_table(spark, sf_dir, "embeddings"))


@query("op1_pii_surrogates")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = raw_table(spark, sf_dir, "documents").select("doc_id", "text")
    replaced = pii_surrogates.replace_entities(docs, SURROGATE_KEY)
    return replaced.select("doc_id", F.col("__mentions").alias("n_mentions"), "text")


@query("op8_piece_lattice")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = lattice.load(tokenizer_path("piece_bpe_32k.model"))
    return lattice.encode(raw_table(spark, sf_dir, "documents"), vocabulary)


@query("op11_jump_shards")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = jump_shards.manifest(raw_table(spark, sf_dir, "documents"), 40)
    return placed.withColumn("law", F.lit("key"))


@query("op12_basic_factor_runs")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(raw_table(spark, sf_dir, "documents"))
    found = periodic_runs.find_runs(docs)
    # The greatest length first, then the smallest start and period.
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"), F.floor(-F.col("best.less") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op13_chebyshev_whitening")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(raw_table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))
