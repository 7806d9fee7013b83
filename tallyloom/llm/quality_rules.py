"""A ledger of quality rules: every rule is evaluated once, policies are bit masks over the stored failures.

``ledger`` stores measurements and one failure bit per rule and document. A policy version names the rules it
applies; applying one, or asking what a rule alone removes, reads the ledger and never the texts.
All columns are built-in functions; texts are processed whole, one row at a time, without a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.tables import BLANKS, let, unused, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Bit and failure condition of each rule; new rules get new bits, old bits keep their meaning.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "4 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "shouting": "2 * n_upper > word_chars",
    "odd_word_length": "word_chars > 20 * n_words or word_chars < 2 * n_words",
    "several_repeated_lines": "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines",
}
#: Policy versions; the base policy is the part that every version contains.
POLICIES = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "many_symbols"],
    "v2": ["few_words", "repeated_windows", "many_symbols", "repeated_lines", "shouting", "odd_word_length"],
    # A share of very few lines says little: a notice at both ends of a short document is no repetition.
    "v3": ["few_words", "repeated_windows", "many_symbols", "several_repeated_lines", "shouting", "odd_word_length"],
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]


def rule_bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def policy_mask(version: str) -> int:
    return sum(rule_bit(rule) for rule in POLICIES[version])


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice: equal hashes meet by sorting, then windows are joined up."""

    def repeated(found: Column) -> Column:
        def twice(x, i):
            before, after = F.get(found, i - 1), F.get(found, i + 1)
            return (before["h"].eqNullSafe(x["h"])) | (after["h"].eqNullSafe(x["h"]))

        return F.sort_array(F.transform(F.filter(found, twice), lambda x: x["i"]))

    def length(starts: Column) -> Column:
        steps = F.transform(starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(pairs, repeated), length)


def _repeat_words(word_list: Column) -> Column:
    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    def count(hashes: Column) -> Column:
        none = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(none, F.lit(0).cast("long")).otherwise(_covered(hashes))

    def over(w: Column) -> Column:
        return F.when(F.size(w) <= WINDOW, F.lit(0).cast("long")).otherwise(let(windows(w), count))

    return let(F.transform(word_list, lambda x: F.xxhash64(x)), over)


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` plus the measurements, as long; columns of their names are replaced, all others kept. A null text has
    no words and no lines. The length rule of words rejects long texts in a script without spaces, whose lines are words.

    Windows are compared by 64-bit hashes within one document.
    """
    docs = docs.drop(*MEASURES)
    text = F.coalesce("text", F.lit(""))
    # A line that other documents or lines merely resemble is not equal; a line of blanks is no line.
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    counts = let(
        words(F.col("text")),
        lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r")),
    )
    line_counts = let(
        lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d"))
    )
    of_words, of_lines = unused(docs, "_words"), unused(docs, "_lines")
    return (
        docs.withColumn(of_words, counts)
        .withColumn(of_lines, line_counts)
        .select(
            *docs.columns,
            F.col(of_words)["n"].alias("n_words"),
            _without(text, BLANKS).cast("long").alias("word_chars"),
            (F.length(text) - _without(text, SYMBOLS)).cast("long").alias("n_symbols"),
            F.col(of_lines)["d"].cast("long").alias("n_dup_lines"),
            F.col(of_words)["r"].alias("n_repeat_words"),
            F.col(of_lines)["n"].alias("n_lines"),
            (F.length(text) - _without(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_upper"),
        )
    )


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, plus the measurements and ``failed``, the failure bits of all rules (long)."""
    bits = [F.when(F.expr(rule), rule_bit(name)).otherwise(0).cast("long") for name, rule in RULES.items()]
    measured = measure(docs.drop("failed"))
    return measured.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits)).drop("text")


def passes(version: str) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy_mask(version)).cast("long")) == 0


def ablations(rows: DataFrame, version: str) -> DataFrame:
    """What each rule of a policy does: documents that fail it, those that fail it alone (and would come back
    without it), and the documents kept with and without it; one pass over the ledger."""
    mask = policy_mask(version)
    under = F.col("failed").bitwiseAND(F.lit(mask).cast("long"))
    one = rows.groupBy(under.alias("failed")).agg(F.count(F.lit(1)).alias("n"))
    table = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(rule_bit(r)).cast("long").alias("bit")) for r in POLICIES[version]]))
    spread = one.select("failed", "n", table.alias("r")).select("failed", "n", "r.*")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")

    hit = F.col("failed").bitwiseAND(F.col("bit")) != 0
    return spread.groupBy("rule").agg(
        total(hit).alias("n_failed"),
        total(F.col("failed") == F.col("bit")).alias("n_failed_alone"),
        total(F.col("failed") == 0).alias("n_kept"),
        total((F.col("failed") == 0) | (F.col("failed") == F.col("bit"))).alias("n_kept_without"),
    )
