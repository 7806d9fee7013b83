"""Every registered query against its SQL equivalent, on the smallest tables."""

import dataclasses
import datetime as dt
import math

import duckdb
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyloom.operators import clustering, enrichment
from tallyloom.plans import catalog, oracles
from tallyloom.sources import writers

QUERIES, SQL = catalog.queries(), oracles.oracle_sql()
TABLES = ["region", "nation", "customer", "orders", "lineitem", "part", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "~"
    return value.isoformat() if isinstance(value, dt.datetime) else str(value)


def test_every_query_is_checked_or_listed():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    rows = frame.collect()
    relation = duck.sql(SQL[name])
    columns = sorted(frame.columns)
    assert columns == sorted(relation.columns)
    expected = [tuple(_cell(r[relation.columns.index(c)]) for c in columns) for r in relation.fetchall()]
    assert sorted(tuple(_cell(r[c]) for c in columns) for r in rows) == sorted(expected)


def test_entry(spark):
    assert entry.entry(spark).columns == ["YearMonth", "Country", "Revenue", "Transactions", "ItemsSold"]


def _agrees(spark, duck, name):
    frame, relation = QUERIES[name](spark, SMALL), duck.sql(SQL[name])
    columns = sorted(frame.columns)
    expected = [tuple(_cell(r[relation.columns.index(c)]) for c in columns) for r in relation.fetchall()]
    return sorted(tuple(_cell(r[c]) for c in columns) for r in frame.collect()) == sorted(expected)


@pytest.mark.parametrize("name", ["export_csv_modular", "export_csv_minimal"])
@pytest.mark.parametrize("column", ["StockCode", "Description", "InvoiceDate", "UnitPrice"])
def test_one_changed_value_of_an_export_is_seen(spark, duck, monkeypatch, name, column):
    export = writers.export_csv

    def shifted(df, path, columns, **options):
        one = df.agg(F.min("InvoiceNo")).first()[0]
        other = F.col(column) + 0.5 if column == "UnitPrice" else F.concat(F.col(column), F.lit("x"))
        first = (F.col("InvoiceNo") == one) & (F.col("StockCode") == df.where(F.col("InvoiceNo") == one).agg(F.min("StockCode")).first()[0])
        export(df.withColumn(column, F.when(first, other).otherwise(F.col(column))), path, columns, **options)

    monkeypatch.setattr(writers, "export_csv", shifted)
    assert not _agrees(spark, duck, name)


def test_a_wrong_region_of_one_country_is_seen(spark, duck, monkeypatch):
    moved = {**enrichment.REGION_COUNTRIES, "Asia": [c for c in enrichment.REGION_COUNTRIES["Asia"] if c != "ISRAEL"]}
    monkeypatch.setattr(enrichment, "REGION_COUNTRIES", moved)
    assert not _agrees(spark, duck, "region_case")


def test_a_wrong_silhouette_is_seen(spark, duck, monkeypatch):
    real = clustering._cluster
    monkeypatch.setattr(clustering, "_cluster", lambda *a, **b: dataclasses.replace(r := real(*a, **b), silhouette=r.silhouette + 1e-4))
    assert not _agrees(spark, duck, "kmeans_metrics")


def test_the_plain_silhouette_and_its_sql_take_all_members_of_large_segments(spark, duck, monkeypatch):
    random = np.random.default_rng(23)
    labels = np.repeat([0, 1], [700, 500])
    x = random.normal(size=(1200, 3)) ** 3 + labels[:, None]
    rows = [(f"c{i}", *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, labels, strict=True))]
    frame = spark.createDataFrame(rows, "CustomerID string, Recency double, Frequency double, Monetary double, Cluster int")
    monkeypatch.setattr(catalog, "segment_frame", lambda spark, sf: frame)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    gaps = np.sqrt(((z[:, None] - z[None]) ** 2).sum(axis=2))
    own, other = (gaps[:, labels == 0].sum(axis=1), gaps[:, labels == 1].sum(axis=1)), np.array([700, 500])
    a = np.where(labels == 0, own[0] / 699, own[1] / 499)
    b = np.where(labels == 0, own[1] / other[1], own[0] / other[0])
    expected = np.mean((b - a) / np.maximum(a, b))
    assert QUERIES["silhouette_euclidean"](spark, SMALL).first()["score"] == pytest.approx(expected, abs=1.1e-6)
    values = ", ".join(f"('{r[0]}', {r[1]!r}::DOUBLE, {r[2]!r}::DOUBLE, {r[3]!r}::DOUBLE, {r[4]})" for r in rows)
    segs = f"SELECT * FROM (VALUES {values}) AS t(CustomerID, Recency, Frequency, Monetary, Cluster)"
    ((score,),) = duck.sql(f"WITH segs AS ({segs}) SELECT * FROM ({oracles._EUCLIDEAN})").fetchall()
    assert score == pytest.approx(expected, abs=1.1e-6)
