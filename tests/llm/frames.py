"""Fixtures of the tests in this folder; not a conftest, whose name would clash with that of the folder above."""

import pytest

from tallyloom.llm.shipping import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}" for a in "abcdefghij" for b in ("er", "on", "ti", "sh", "le")]


def prose(start, count, step=7):
    return " ".join(WORDS[(start + i * step + i * i // 3) % len(WORDS)] + str((start + i) % 13) for i in range(count))


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    def build(texts, more=()):
        rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
        return spark.createDataFrame([*rows, *more], SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and blank texts, a very long one, ties and repeated rows, and a row without an id."""
    base = prose(3, 200)
    texts = [None, "", " \t\n", "one", "one two three four", base, base, base.replace("aer", "x"), prose(11, 60)]
    texts += ["\n".join([prose(5, 30)] * 3 + ["tail"]), prose(1, 20_000), "é漢字 😀 naïve\x0b\x0cword " * 9]
    more = [(5, base, "en", "src2", len(base)), (None, base, None, None, None), (None, None, None, None, None)]
    return make_docs(texts, more)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """Extra columns named like the operators' own columns and helpers."""
    names = """score failed n_words n_lines n_dropped kept_text size shard slot at node hash hashes start first past place nth shifts
        shift bucket info old_shard row file upto target text_hash dropped pos key keeper line_hash line_hash2 word bits _words
        _lines _words_ word_chars n n_shingles component_id component name digest __digest __salt signature kind group held_out
        item_id edits end prefix middle output restored form root n_near part h score_"""
    return odd_docs.selectExpr("*", *[f"'x' as {n}" for n in names.split()])


@pytest.fixture(scope="session")
def kept_columns(clashing):
    """Whether the extra columns of ``clashing`` that a result still has are as they were; ``added`` are the result's own."""

    def check(result, added=()):
        lost = set(clashing.columns) - set(result.columns) - {"text"}
        assert not lost, lost
        for r in result.collect():
            assert all(r[c] == "x" for c in clashing.columns[5:] if c not in added)

    return check
