import statistics

import pytest
from conftest import as_dict

from tallyloom.operators import quality
from tallyloom.operators.cleaning import clean_modular


def test_tags(raw):
    assert as_dict(quality.quality_counts(raw), "category", "rows") == {
        "trim": 2,
        "cancel": 2,
        "invalid_date": 1,
        "invalid_values": 2,
        "null_customer": 2,
        "normal": 4,
    }


def test_examples_are_the_first_lines_of_each_tag(raw):
    got = {}
    for row in quality.quality_examples(raw, per_category=2).orderBy("category", "rank").collect():
        got.setdefault(row["category"], []).append(row["InvoiceNo"])
    assert got == {
        "trim": ["101", "108"],
        "cancel": ["C103", "C104"],
        "invalid_date": ["105"],
        "invalid_values": ["106", "C103"],
        "null_customer": ["107", "108"],
        "normal": [None, "100"],
    }


def test_examples_with_many_lines_of_one_invoice(spark, raw):
    copies = raw.filter("InvoiceNo = '100'").crossJoin(spark.range(500)).drop("id")
    rows = quality.quality_examples(copies).collect()
    assert [(r["category"], r["rank"]) for r in rows] == [("normal", 1), ("normal", 2), ("normal", 3)]


def test_missing_values(raw, empty_raw):
    counts = as_dict(quality.missing_values(raw), "column_name", "missing_count")
    assert counts["CustomerID"] == counts["Description"] == counts["InvoiceNo"] == counts["Country"] == 1
    assert as_dict(quality.missing_values(raw), "column_name", "missing_pct")["CustomerID"] == 9.09
    assert {r["missing_pct"] for r in quality.missing_values(empty_raw).collect()} == {None}


def test_cancellations(raw):
    share = {r["status"]: (r["lines"], r["share_pct"]) for r in quality.cancel_share(raw).collect()}
    assert share == {"cancelled": (2, 18.181818), "successful": (9, 81.818182)}
    assert [tuple(r) for r in quality.top_returned_products(raw).collect()] == [("mug", 2)]
    assert [tuple(r) for r in quality.cancel_trend_monthly(raw).collect()] == [("2010-12", 2)]


def test_summary_matches_reference_statistics(spark):
    values = [float(v * v % 97) for v in range(60)]
    df = spark.createDataFrame([(v, 7.0) for v in values], "a double, constant double")
    rows = {r["column_name"]: r for r in quality.numeric_summary(df, ["a", "constant"]).collect()}
    quartiles = statistics.quantiles(values, n=4, method="inclusive")
    assert rows["a"]["std"] == pytest.approx(statistics.stdev(values), abs=0.005)
    assert [rows["a"][q] for q in ("p25", "p50", "p75")] == pytest.approx(quartiles, abs=0.005)
    assert (rows["constant"]["std"], rows["constant"]["p50"], rows["constant"]["count"]) == (0.0, 7.0, 60)
    assert {r["count"] for r in quality.numeric_summary(df.limit(0), ["a"]).collect()} == {0}


def test_stage_counts(raw):
    counts = as_dict(quality.stage_counts(raw, clean_modular(raw)), "stage", "rows")
    assert counts == {"raw": 11, "clean": 4, "customers": 4}
