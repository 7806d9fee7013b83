import datetime as dt
from pathlib import Path

import pytest
from conftest import invoices

from tallyloom.operators import enrichment
from tallyloom.sources.sales_store import MANIFEST, read_sales, sales_manifest, stored_filter_domain
from tallyloom.sources.writers import write_sales


def _lines(months, country="A"):
    return [(f"{country}{m}", f"2010-{m:02d}-15 10:00:00", "1", country, "mug", 1, 1.0) for m in months]


def _rows(df):
    return sorted(map(str, df.collect()))


def _spoil(path):
    for file in Path(path).glob("YearMonth=*/*.parquet"):
        file.write_bytes(b"no parquet")


@pytest.fixture
def store(make_sales, tmp_path):
    path = str(tmp_path / "sales")
    write_sales(make_sales(_lines(range(1, 13)) + _lines([3, 4], "B") + _lines([5], None)), path)
    return path


def test_the_domain_is_read_without_the_sales(spark, store):
    sales = spark.read.parquet(store)
    expected = _rows(enrichment.filter_domain(sales, ["B"]))
    fallback = _rows(enrichment.filter_domain(sales, ["Z"], fallback=1))
    _spoil(store)
    found = stored_filter_domain(spark, store, ["B"])
    assert _rows(found) == expected and _rows(stored_filter_domain(spark, store, ["Z"], fallback=1)) == fallback
    assert found.first()["min_date"] == dt.date(2010, 1, 15)
    files = sales_manifest(spark, store).inputFiles()
    assert all(MANIFEST in f for f in files if f.endswith(".parquet") and "YearMonth" not in f)


def test_a_report_opens_the_files_that_can_have_its_lines(spark, store):
    days = dt.date(2010, 3, 1), dt.date(2010, 5, 31)
    found = read_sales(spark, store, *days, ["B"])
    assert _rows(found) == _rows(enrichment.filter_date_country(spark.read.parquet(store), *days, ["B"]))
    assert {f.split("YearMonth=")[1][:7] for f in found.inputFiles()} == {"2010-03", "2010-04"}  # no B in May
    assert read_sales(spark, store, *days, ["C"]).count() == 0
    assert read_sales(spark, store, *days, ["C"]).schema == spark.read.parquet(store).schema
    assert read_sales(spark, store, dt.date(2010, 12, 15), dt.date(2010, 12, 15), ["A", "B"]).count() == 1


def test_appended_files_and_files_without_rows(spark, store, make_sales):
    before = sales_manifest(spark, store).count()
    write_sales(make_sales(_lines([2], "C")), store, mode="append")
    assert sales_manifest(spark, store).count() == before + 1
    # a write that ended before its manifest was written
    more = make_sales(_lines([6], "D")).selectExpr("*", "'2010-06' as YearMonth")
    more.write.mode("append").partitionBy("YearMonth").parquet(store)
    domain = stored_filter_domain(spark, store, ["A"])
    assert [r["Country"] for r in domain.collect()] == [None, "A", "B", "C", "D"]
    assert invoices(read_sales(spark, store, dt.date(2010, 6, 1), dt.date(2010, 6, 30), ["A", "D"])) == ["A6", "D6"]
    for file in Path(store).glob("YearMonth=2010-0[1-9]/*.parquet"):  # old months are dropped
        file.unlink()
    domain = stored_filter_domain(spark, store, ["A"])
    assert {r["Country"]: str(r["min_date"]) for r in domain.collect()} == {"A": "2010-10-15"}


def test_overwriting_and_an_empty_store(spark, store, make_sales):
    write_sales(make_sales(_lines([7], "E")), store, mode="overwrite")
    assert [r["Country"] for r in stored_filter_domain(spark, store).collect()] == ["E"]
    write_sales(make_sales(_lines([7], "E")).limit(0), store, mode="overwrite")
    assert sales_manifest(spark, store).count() == 0 and stored_filter_domain(spark, store).count() == 0
