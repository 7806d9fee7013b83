"""Region, amount and report-filter columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.columns import total_amount
from tallyloom.functions.staging import stage
from tallyloom.schema import DEFAULT_COUNTRIES

# Countries of each region; every other country belongs to OTHER_REGION.
REGION_COUNTRIES = {
    "Europe": [
        "UNITED KINGDOM", "GERMANY", "FRANCE", "SPAIN", "PORTUGAL", "ITALY", "SWITZERLAND", "BELGIUM",
        "NETHERLANDS", "EIRE", "ICELAND", "CHANNEL ISLANDS", "CYPRUS", "NORWAY", "POLAND", "SWEDEN",
        "DENMARK", "AUSTRIA", "IRELAND", "ALBANIA", "FINLAND", "GREECE", "CZECH REPUBLIC", "MALTA",
        "LUXEMBOURG", "HUNGARY",
    ],
    "Asia": [
        "JAPAN", "SAUDI ARABIA", "LEBANON", "HONG KONG", "SINGAPORE", "BAHRAIN", "MALAYSIA",
        "UNITED ARAB EMIRATES", "ISRAEL", "KOREA, REPUBLIC OF",
    ],
    "North America": ["USA", "CANADA", "COSTA RICA"],
    "South America": ["BRAZIL", "ARGENTINA"],
    "Africa": ["RSA", "KENYA", "EGYPT"],
    "Oceania": ["AUSTRALIA"],
}
# The short seed dimension of the minimal preprocessing run.
SEED_REGIONS = {
    "Europe": ["UNITED KINGDOM", "GERMANY", "FRANCE"],
    "Oceania": ["AUSTRALIA"],
    "Asia": ["JAPAN"],
}
OTHER_REGION = "Other"


def region_dimension(
    spark: SparkSession, regions: dict[str, list[str]] | None = None
) -> DataFrame:
    """Table (Country, Region) of a fixed mapping, 45 rows by default."""
    pairs = [(c, r) for r, members in (regions or REGION_COUNTRIES).items() for c in members]
    return spark.createDataFrame(pairs, "Country string, Region string")


def add_region(df: DataFrame, dimension: DataFrame | None = None) -> DataFrame:
    """Left join on Country; unmapped and missing countries get ``Other``.

    The built-in mapping is a constant of 45 rows and is broadcast. A dimension table of the caller is
    broadcast only if Spark finds it small; else adaptive execution splits hot countries.
    """
    if dimension is None:
        joined = df.join(F.broadcast(region_dimension(df.sparkSession)), "Country", "left")
    else:
        joined = df.join(dimension, "Country", "left")
    return joined.na.fill({"Region": OTHER_REGION}).select(*df.columns, "Region")


def add_total_amount(df: DataFrame) -> DataFrame:
    return df.withColumn("TotalAmount", total_amount())


def filter_date_country(
    df: DataFrame, start: dt.date, end: dt.date, countries: Sequence[str]
) -> DataFrame:
    """Rows dated from ``start`` through ``end`` (both days included) in one of ``countries``.

    Written as bounds on the timestamp itself, which a columnar scan can use to skip data. On sales stored
    by month the months outside the range are not read at all.
    """
    first = F.lit(start.isoformat()).cast("timestamp")
    past_end = F.lit((end + dt.timedelta(days=1)).isoformat()).cast("timestamp")
    in_range = (F.col("InvoiceTS") >= first) & (F.col("InvoiceTS") < past_end)
    if "YearMonth" in df.columns:
        in_range = in_range & F.col("YearMonth").between(f"{start:%Y-%m}", f"{end:%Y-%m}")
    return df.filter(in_range & F.col("Country").isin(list(countries)))


def filter_domain(
    df: DataFrame, defaults: Sequence[str] = tuple(DEFAULT_COUNTRIES), fallback: int = 5
) -> DataFrame:
    """Choices of the report filter: every country, whether it is preselected, and the date range.

    If none of ``defaults`` occurs, the first ``fallback`` countries by name are preselected.
    """
    per_country = df.groupBy("Country").agg(
        F.to_date(F.min("InvoiceTS")).alias("first"), F.to_date(F.max("InvoiceTS")).alias("last")
    )
    return domain_of(per_country, defaults, fallback)


def domain_of(per_country: DataFrame, defaults: Sequence[str], fallback: int) -> DataFrame:
    """``filter_domain`` from each country's ``first`` and ``last`` day."""
    # read three times below, so it is stored once
    per_country = stage(per_country, "countries")
    wanted = F.col("Country").isin(list(defaults))
    overall = per_country.agg(
        F.struct(
            F.min("first").alias("min_date"),
            F.max("last").alias("max_date"),
            F.coalesce(F.bool_or(wanted), F.lit(False)).alias("any_default"),
        )
    ).scalar()
    leading = (
        per_country.filter(F.col("Country").isNotNull())
        .select("Country")
        .orderBy("Country")
        .limit(fallback)
        .withColumn("leading", F.lit(True))
    )
    return (
        per_country.join(F.broadcast(leading), "Country", "left")
        .withColumn("o", overall)
        .select(
            "Country",
            F.when(F.col("o.any_default"), F.coalesce(wanted, F.lit(False)))
            .otherwise(F.coalesce("leading", F.lit(False)))
            .alias("is_default"),
            F.col("o.min_date").alias("min_date"),
            F.col("o.max_date").alias("max_date"),
        )
        .orderBy("Country")
    )


def preview(df: DataFrame, rows: int = 10, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``rows`` rows by ``order_by`` (default: all columns), NULLs first."""
    return df.orderBy(*(order_by or df.columns)).limit(rows)
