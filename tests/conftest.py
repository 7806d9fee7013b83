from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

from tallyloom.schema import RAW

SMALL = "/root/testdata/sf0.001"

# One line per irregularity of the raw data.
RAW_LINES = [
    ("100", "S1", "mug", 6, "2010-12-01 08:26:00", 2.5, "17850.0", "United Kingdom"),
    ("101", "S2", " lamp ", 1, "2010-12-02 10:00:00", 4.0, " 17850 ", " France"),
    ("102", "S3", "\tlamp", 1, "2010-12-02 10:05:00", 4.0, "17851", "France"),
    ("C103", "S1", "mug", -6, "2010-12-03 09:00:00", 2.5, "17850.0", "United Kingdom"),
    ("C104", "S1", "mug", 6, "2010-12-03 09:05:00", 2.5, "17850.0", "United Kingdom"),
    ("105", "S1", "mug", 1, "12/1/2010 8:26", 2.5, "17852", "Japan"),
    ("106", "S1", "mug", 1, "2010-12-04 11:00:00", 0.0, "17852", "Japan"),
    ("107", "S1", "mug", 1, "2010-12-05 11:00:00", 2.5, None, "Japan"),
    ("108", "S1", "mug", 1, "2010-12-05 12:00:00", 2.5, "  ", "Japan"),
    ("109", "S1", None, 1, "2010-12-05 13:00:00", 2.5, "17853", "Atlantis"),
    (None, "S1", "mug", 1, "2010-12-05 14:00:00", 2.5, "17853", None),
]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stages-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    return spark.createDataFrame(RAW_LINES, RAW)


@pytest.fixture(scope="session")
def empty_raw(spark):
    return spark.createDataFrame([], RAW)


@pytest.fixture(scope="session")
def make_sales(spark):
    """Sales lines from (InvoiceNo, timestamp, CustomerID, Country, Description, Quantity, UnitPrice)."""

    def build(rows):
        frame = spark.createDataFrame(
            rows,
            "InvoiceNo string, ts string, CustomerID string, Country string, Description string, "
            "Quantity int, UnitPrice double",
        )
        return frame.selectExpr(
            "InvoiceNo",
            "Description as StockCode",
            "Description",
            "Quantity",
            "cast(ts as timestamp) as InvoiceTS",
            "UnitPrice",
            "CustomerID",
            "Country",
            "Quantity * UnitPrice as TotalAmount",
        )

    return build


def invoices(df):
    return sorted(row["InvoiceNo"] or "" for row in df.collect())


def as_dict(df, key, value):
    return {row[key]: row[value] for row in df.collect()}
