import pytest
from conftest import invoices
from pyspark.errors import PySparkException

from tallyloom.operators import cleaning


def test_modular_keeps_blank_customers_and_drops_unknown_invoice(raw):
    assert invoices(cleaning.clean_modular(raw)) == ["100", "101", "102", "108"]


def test_modular_trims_spaces_only_and_uppercases_country(raw):
    rows = {r["InvoiceNo"]: r for r in cleaning.clean_modular(raw).collect()}
    assert rows["101"]["Description"] == "lamp" and rows["101"]["Country"] == "FRANCE"
    assert rows["101"]["CustomerID"] == "17850" and rows["108"]["CustomerID"] == ""
    assert rows["102"]["Description"] == "\tlamp"
    assert str(rows["100"]["InvoiceTS"]) == "2010-12-01 08:26:00"


def test_basic_drops_blank_customers_unless_told_not_to(raw):
    assert invoices(cleaning.clean_basic(raw)) == ["100", "101", "102", "109"]
    kept = cleaning.clean_basic(raw, drop_null_customer=False)
    assert invoices(kept) == ["100", "101", "102", "107", "108", "109"]
    assert {r["Country"] for r in kept.collect()} >= {"United Kingdom", "France"}


def test_minimal_keeps_cancelled_positive_bad_date_and_zero_price(raw):
    assert invoices(cleaning.clean_minimal(raw)) == ["", "100", "101", "102", "105", "106", "108", "C104"]


def test_dashboard_fails_on_bad_date_by_default(raw):
    with pytest.raises(PySparkException):
        cleaning.clean_dashboard(raw).collect()
    with pytest.raises(ValueError):
        cleaning.clean_dashboard(raw, on_bad_date="ignore")


def test_dashboard_null_dates_and_calendar_columns(raw):
    rows = {r["InvoiceNo"]: r for r in cleaning.clean_dashboard(raw, on_bad_date="null").collect()}
    assert rows["105"]["InvoiceTS"] is None and rows["105"]["MonthStr"] is None
    assert (rows["106"]["DayOfWeek"], rows["106"]["Hour"], rows["106"]["MonthStr"]) == ("Saturday", 11, "2010-12")
    assert "107" not in rows and "C104" in rows


def test_strict_dates_do_not_depend_on_ansi(spark, raw):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException):
            cleaning.clean_dashboard(raw).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_loss_reports(raw, empty_raw):
    loss = cleaning.cleaning_loss_report(raw).first()
    assert (loss["rows_before"], loss["rows_after"], loss["rows_removed"], loss["rows_consistent"]) == (11, 9, 2, 8)
    assert loss["removed_pct"] == pytest.approx(18.181818)
    volume = cleaning.volume_comparison(raw).first()
    assert (volume["rows_before"], volume["rows_after"], volume["rows_removed"]) == (11, 9, 2)
    empty = cleaning.cleaning_loss_report(empty_raw).first()
    assert empty["rows_before"] == 0 and empty["removed_pct"] is None


def test_inferred_types_clean_like_text(spark, raw, tmp_path):
    path = str(tmp_path / "csv")
    good = raw.filter("InvoiceNo in ('100', '101', '102')")
    good.write.csv(path, header=True)
    inferred = spark.read.csv(path, header=True, inferSchema=True)
    assert dict(inferred.dtypes)["InvoiceDate"] == "timestamp"
    cleaned = cleaning.clean_modular(inferred)
    assert invoices(cleaned) == ["100", "101", "102"]
    assert {r["CustomerID"] for r in cleaned.collect()} == {"17850.0", "17851.0"}
