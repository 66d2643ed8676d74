"""One registered query per operator, over whole tables; their SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakespark.llm import (
    bpe,
    divergence,
    filter_audit,
    language,
    line_dedup,
    multi_index,
    pareto_mix,
    quotes,
    secret_scan,
    setsketch,
    simhash,
    sqltext,
    toxicity,
    va_file,
)
from quakespark.llm.common import table

PIECES = "piece_bpe_32k.model"
RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    return public_tokenizers.path(name)


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quotes.conversations(table(spark, sf_dir, "conversations"))
    return out.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


def op2_vector_approximation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_file.search(table(spark, sf_dir, "embeddings"), "embedding", every=100, k=10)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), tokenizer(RANKS), public_tokenizers.PATTERN)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), tokenizer(PIECES))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer(VOCABULARY))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(table(spark, sf_dir, "documents"))


def op8_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), "embedding", every=50, k=5)


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pareto_mix.drawn(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, at_least=(85, 100))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quotation_linking, op2_vector_approximation, op3_secret_scan, op4_toxicity, op5_language_id, op6_bpe,
        op7_line_dedup, op8_multi_index_hashing, op9_pareto_mix, op10_simhash, op11_setsketch, op12_filter_audit, op13_source_divergence, pipeline,
    )
}
ORACLES: dict[str, str] = dict(sqltext.ORACLES)
