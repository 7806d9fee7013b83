"""A training corpus from the documents table: five stages, each one an operator, its result stored for the next.

Low-quality documents go, lines that many documents share stay in one, one document of each group of near copies
stays, documents with benchmark passages go, and the rest are encoded. All stages but the last return the columns
of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.staging import stage
from tallyloom.llm import bpe, decontaminate, line_crf, line_dedup, ngram_join
from tallyloom.llm.queries import tokenizer
from tallyloom.llm.shipping import ship_package
from tallyloom.llm.tables import table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more."""
    ship_package(spark)
    model = line_crf.train(docs, table(spark, sf_dir, "labels"))
    kept = line_crf.score_documents(docs, model).where("score >= 0.3")
    return kept.select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the lines they keep as their text; a null text stays null."""
    rows = line_dedup.dedup_lines(docs)
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    changed = {"text": text, "n_chars": F.coalesce(F.length(text).cast("long"), F.col("n_chars"))}
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, that with the smallest id; documents without an id stay. Rows that
    share an id but not the text are documents of their own."""
    ship_package(spark)
    return ngram_join.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    ship_package(spark)
    return decontaminate.without_hits(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return bpe.encode_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("lines", drop_shared_lines),
    ("similar", keep_one_of_similar),
    ("benchmark", drop_benchmark),
    ("encode", encode),
]

#: The classifier of the first stage is fitted, so SQL cannot express the rows of a run.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
