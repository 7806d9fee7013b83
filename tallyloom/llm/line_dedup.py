"""Lines that many documents share, dropped from all of them but the one with the largest id.

Line keys are hashed; (hash, document) pairs are dealt out by range with a secondary sort by document
(largest first) and position, so a line that a third of all documents hold spans many ranges. Each range
streams its first occurrences, one per hash and document, and sends one partial row per hash. What comes
back per document is a bitmap in words of 64 lines of which only words with a dropped line are stored.

A key is taken as equal if two differently seeded 64-bit hashes agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.staging import stage
from tallyloom.llm.tables import BLANKS, let, unused

HASH = ["line_hash", "line_hash2"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """One row per line whose key has ``min_chars`` code points: its hashes, document, text and position."""
    exploded = docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.posexplode(F.transform(_lines(F.col("text")), line_key)).alias("pos", "key"),
    ).where(F.length("key") >= min_chars)
    return exploded.select(
        F.xxhash64("key").alias("line_hash"),
        F.xxhash64(F.lit("line"), "key").alias("line_hash2"),
        "doc_id",
        "text_hash",
        "pos",
    )


def shared_lines(lines: DataFrame, min_docs: int = 3) -> DataFrame:
    """The hashes that at least ``min_docs`` documents hold, with the largest id among these (``keeper``)."""
    dealt = lines.select(*HASH, "doc_id", "pos").repartitionByRange(*HASH, F.desc("doc_id"))
    within = Window.partitionBy(*HASH, "doc_id").orderBy("pos")
    firsts = dealt.withColumn("nth", F.row_number().over(within)).where("nth = 1")
    counted = firsts.groupBy(*HASH).agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
    return counted.where(F.col("n_docs") >= min_docs)


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document with a dropped line: ``dropped``, a map from word number to a 64-bit word with 1 for a dropped
    line, and ``n_dropped``. Documents without a row keep every line.

    Rows are told apart by ``doc_id`` and text, so repeated rows share a bitmap; rows with one id are one document
    to the counts. Documents without an id count as one document that never keeps a shared line if another holds it.
    """
    lines = stage(line_hashes(docs, min_chars), "line-hashes")
    shared = stage(shared_lines(lines, min_docs), "shared-lines")
    lost = lines.join(shared, HASH).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    bit = F.expr("shiftleft(1L, pos % 64)")
    by_word = lost.groupBy("doc_id", "text_hash", F.expr("pos div 64").cast("int").alias("word")).agg(
        F.bit_or(bit).alias("bits")
    )
    return by_word.groupBy("doc_id", "text_hash").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped"),
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
    )


def _kept_text(text: Column, dropped: Column) -> Column:
    lines = _lines(text)
    numbers = F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / 64).cast("int"))
    bits = F.transform(numbers, lambda w: F.coalesce(F.element_at(dropped, w), F.lit(0).cast("long")))

    def kept(parts):
        def stays(_, i):
            word = F.get(parts["bits"], F.floor(i / 64).cast("int"))
            return F.call_function("getbit", word, F.pmod(i, F.lit(64))) == 0

        return F.array_join(F.filter(parts["lines"], stays), "\n")

    return F.when(dropped.isNull(), F.coalesce(text, F.lit(""))).otherwise(
        let(F.struct(lines.alias("lines"), bits.alias("bits")), kept)
    )


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` plus ``n_lines`` (before dropping), ``n_dropped`` and ``kept_text``.

    Null and empty texts have one empty line and the kept text ''. Other columns pass through; an input column
    named like an added one is replaced.
    """
    docs = docs.drop("n_lines", "n_dropped", "kept_text")
    own_hash = unused(docs, "text_hash")
    left = docs.withColumn(own_hash, F.xxhash64(F.coalesce("text", F.lit("")))).alias("d")
    maps = keep_bitmaps(docs, min_chars, min_docs).alias("b")
    same = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col(f"d.{own_hash}") == F.col("b.text_hash"))
    text = F.col("d.text")
    return left.join(maps, same, "left").select(
        *[F.col(f"d.`{c}`") for c in docs.columns],
        F.size(_lines(text)).cast("long").alias("n_lines"),
        F.coalesce("b.n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        _kept_text(text, F.col("b.dropped")).alias("kept_text"),
    )
