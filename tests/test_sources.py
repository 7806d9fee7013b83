import pytest
from conftest import invoices

from tallyloom.schema import RAW, RAW_COLUMNS
from tallyloom.sources.readers import read_jdbc, read_transactions_csv
from tallyloom.sources.writers import export_csv, write_jdbc

HEADER = ",".join(RAW_COLUMNS) + "\n"


def test_quotes_padding_and_malformed_numbers(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        HEADER
        + '1,S,"a ""big"" mug, blue",6,2010-12-01 08:26:00,2.5,17850, France\n'
        + "2,S,mug,six,2010-12-01 08:26:00,x,,France\n",
        encoding="utf-8",
    )
    df = read_transactions_csv(spark, str(path))
    assert df.schema == RAW
    one, two = df.orderBy("InvoiceNo").collect()
    assert one["Description"] == 'a "big" mug, blue' and one["Country"] == " France"
    assert two["Quantity"] is None and two["UnitPrice"] is None and two["CustomerID"] is None


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(HEADER + '1,S,"two\nlines",6,2010-12-01 08:26:00,2.5,17850,France\n', encoding="utf-8")
    assert read_transactions_csv(spark, str(path), multi_line=True).first()["Description"] == "two\nlines"
    for infer in (False, True):
        with pytest.raises(Exception, match="multi_line=True"):
            read_transactions_csv(spark, str(path), infer_schema=infer).count()


def test_latin1(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes((HEADER + "1,S,café £,6,2010-12-01 08:26:00,2.5,17850,France\n").encode("latin-1"))
    assert read_transactions_csv(spark, str(path), encoding="ISO-8859-1").first()["Description"] == "café £"


def test_inferred_schema(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(HEADER + "1,S,mug,6,2010-12-01 08:26:00,2.5,17850.0,France\n", encoding="utf-8")
    types = dict(read_transactions_csv(spark, str(path), infer_schema=True).dtypes)
    assert (types["InvoiceDate"], types["CustomerID"], types["Quantity"]) == ("timestamp", "double", "int")


def test_export_round_trip(spark, raw, tmp_path):
    path = str(tmp_path / "out")
    export_csv(raw.repartition(3), path, RAW_COLUMNS)
    export_csv(raw, path, RAW_COLUMNS, single_file=True)  # overwrites
    back = read_transactions_csv(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, raw.collect()))
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    assert invoices(back)[-1] == "C104"


def test_database_failures_are_raised(spark, raw):
    missing = {"driver": "org.example.NoSuchDriver"}
    with pytest.raises(Exception, match="NoSuchDriver"):
        write_jdbc(raw, "t", "jdbc:none://nowhere/db", missing, num_partitions=2)
    with pytest.raises(Exception, match="NoSuchDriver"):
        read_jdbc(spark, "t", "jdbc:none://nowhere/db", missing, single_connection=True)
    with pytest.raises(ValueError):
        read_jdbc(spark, "t", "jdbc:none://nowhere/db", missing)
    with pytest.raises(Exception, match="NoSuchDriver"):
        read_jdbc(spark, "t", "jdbc:none://nowhere/db", missing, "id", 0, 100, 4)
