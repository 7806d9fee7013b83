"""The registered queries of this package, each one an operator over its whole table, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.staging import stage_path
from tallyloom.llm import (
    bpe,
    decontaminate,
    fill_middle,
    html_text,
    line_crf,
    line_dedup,
    ngram_join,
    pivot_search,
    quality_rules,
    reshard,
    spelling,
    unigram,
    warc,
)
from tallyloom.llm.shipping import ship_package
from tallyloom.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    """Where a public vocabulary lies; ``TOKENIZERS_DIR`` overrides the installed folder."""
    return os.path.join(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), name)


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return unigram.count_tokens(table(spark, sf, "documents"), tokenizer("piece_bpe_32k.model"))


def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """The old layout is one of 16 shards by source, which the hot source makes uneven; the new one has even sizes."""
    by_source = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(16))
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    old = reshard.write_shards(docs, by_source, stage_path(spark, "old-shards"))
    new = reshard.reshard(old, docs.schema, 16)
    return reshard.sharded_rows(new.layout, docs.schema).select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        F.crc32(F.coalesce("row.text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


def op3_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf, "documents"), tokenizer("byte_bpe_50k.json"))


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), path)
    return warc.read_archives(
        spark, path, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    )


def op5_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf, "pages"))


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.benchmark_hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op7_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = line_crf.train(docs, table(spark, sf, "labels"))
    scored = line_crf.score_documents(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        line_crf.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        *quality_rules.MEASURES,
        "failed",
        (~quality_rules.passes("base")).alias("base_failed"),
        quality_rules.passes("v3").alias("kept"),
    )


def op10_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf, "documents"))


def op11_fill_middle(spark: SparkSession, sf: str) -> DataFrame:
    return fill_middle.fill_middle(table(spark, sf, "documents"), with_texts=False)


def op12_topk_search(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_search.top_inner_products(table(spark, sf, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_sharding,
        op3_bpe,
        op4_warc,
        op5_html_text,
        op6_decontamination,
        op7_quality_classifier,
        op8_line_dedup,
        op9_quality_rules,
        op10_ngram_join,
        op11_fill_middle,
        op12_topk_search,
        op13_spelling_variants,
    )
}


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(query) for name, query in QUERIES.items()}
