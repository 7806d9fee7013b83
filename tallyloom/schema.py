"""Table schemas and the default parameters of the retail data model."""

from __future__ import annotations

from pyspark.sql import types as T


def _nullable(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()

# Columns of the raw lines and fields of the segment documents.
RAW = _nullable(
    ("InvoiceNo", _S),
    ("StockCode", _S),
    ("Description", _S),
    ("Quantity", _I),
    ("InvoiceDate", _S),
    ("UnitPrice", _D),
    ("CustomerID", _S),
    ("Country", _S),
)

SEGMENT_DOCUMENT = _nullable(
    ("_id", _S),
    ("rfm", _nullable(("recency", _I), ("frequency", _I), ("monetary", _D))),
    ("segment", _nullable(("cluster_id", _I), ("label", _S))),
)

RAW_COLUMNS = RAW.fieldNames()
TEXT_COLUMNS = [f.name for f in RAW.fields if f.dataType == _S]

# Column order of the two preprocessed exports.
EXPORT_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "InvoiceTS", "UnitPrice",
    "CustomerID", "Country", "Country_Encoded", "Region", "TotalAmount", "Quantity_Normalized",
    "UnitPrice_Standardized",
]
MINIMAL_EXPORT_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID",
    "Country", "Region", "Region_Encoded", "TotalAmount",
]

# The weekdays the shop reports on, in display order (no Saturday).
REPORT_DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Sunday"]

INVOICE_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
HOME_COUNTRY = "UNITED KINGDOM"
# Countries preselected by the report filter.
DEFAULT_COUNTRIES = ["United Kingdom", "Germany", "France", "EIRE", "Netherlands"]
