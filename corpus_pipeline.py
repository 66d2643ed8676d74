"""A training corpus out of ``documents``: five stages, each of which calls one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakespark.llm import bpe, language, line_dedup, pareto_mix, simhash
from quakespark.llm.common import fold, table, unused
from quakespark.llm.queries import PIECES, VOCABULARY, tokenizer
from quakespark.session import checkpointed, ship_package


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the operator knows; those without text or letters go."""
    ship_package(spark)
    model = language.train(docs.filter(fold("doc_id", 5) != 0), tokenizer(PIECES))
    found = unused(docs, "_found")
    marked = docs.withColumn(found, language.prediction(spark, model, "text"))
    return marked.filter(F.col(found)["lang_pred"] != language.UNDETERMINED).select(*docs.columns)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that repeat an earlier one."""
    return line_dedup.without_repeats(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship_package(spark)
    return simhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return pareto_mix.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    ship_package(spark)
    return bpe.digests(docs, tokenizer(VOCABULARY))


STAGES = [
    ("language ID", known_language),
    ("line dedup", distinct_lines),
    ("SimHash near-dedup", distinct_documents),
    ("mixing to target weights", mixed),
    ("BPE encoding", encoded),
]

#: Language scores, SimHash and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = checkpointed(docs)
    return docs
