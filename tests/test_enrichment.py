import datetime as dt

from conftest import as_dict, invoices

from tallyloom.functions.columns import normalized_customer_id
from tallyloom.operators import enrichment
from tallyloom.sources.writers import write_sales


def test_builtin_regions(spark):
    names = ["UNITED KINGDOM", "KOREA, REPUBLIC OF", "RSA", "BRAZIL", "USA", "AUSTRALIA", "ATLANTIS", None]
    df = spark.createDataFrame([(n, 1) for n in names], "Country string, x int")
    got = as_dict(enrichment.add_region(df), "Country", "Region")
    assert got == {
        "UNITED KINGDOM": "Europe",
        "KOREA, REPUBLIC OF": "Asia",
        "RSA": "Africa",
        "BRAZIL": "South America",
        "USA": "North America",
        "AUSTRALIA": "Oceania",
        "ATLANTIS": "Other",
        None: "Other",
    }
    assert enrichment.region_dimension(spark).count() == 45
    assert enrichment.region_dimension(spark, enrichment.SEED_REGIONS).count() == 5


def test_large_dimension_takes_the_shuffle_join(spark):
    dimension = spark.range(50).selectExpr("concat('C', id) as Country", "concat('R', id % 3) as Region")
    df = spark.range(200).selectExpr("concat('C', id % 60) as Country", "id as x")
    small = sorted(map(tuple, enrichment.add_region(df, dimension).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, enrichment.add_region(df, dimension).collect())) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r[2] == "Other" for r in small) == sum(i % 60 >= 50 for i in range(200))


def test_filter_includes_both_days_and_reaches_the_scan(make_sales, spark, tmp_path, capsys):
    rows = [
        (str(i), ts, "1", c, "mug", 1, 1.0)
        for i, (ts, c) in enumerate(
            [
                ("2010-12-01 00:00:00", "A"),
                ("2010-12-02 23:59:59", "A"),
                ("2010-12-03 00:00:00", "A"),
                ("2010-12-02 12:00:00", "B"),
            ]
        )
    ]
    path = str(tmp_path / "sales")
    make_sales(rows).write.parquet(path)
    kept = enrichment.filter_date_country(
        spark.read.parquet(path), dt.date(2010, 12, 1), dt.date(2010, 12, 2), ["A"]
    )
    assert invoices(kept) == ["0", "1"]
    kept.select("TotalAmount").explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(InvoiceTS" in pushed and "LessThan(InvoiceTS" in pushed and "Country" in pushed
    assert "Description" not in next(line for line in plan.splitlines() if "ReadSchema" in line)


def test_months_outside_the_range_are_not_read(make_sales, spark, tmp_path, capsys):
    rows = [(str(m), f"2010-{m:02d}-15 10:00:00", "1", "A", "mug", 1, 1.0) for m in range(1, 13)]
    path = str(tmp_path / "sales")
    write_sales(make_sales(rows), path)
    stored = spark.read.parquet(path)
    assert dict(stored.dtypes)["YearMonth"] == "string"
    kept = enrichment.filter_date_country(stored, dt.date(2010, 3, 15), dt.date(2010, 4, 14), ["A"])
    assert invoices(kept) == ["3"]
    kept.explain("formatted")
    plan = capsys.readouterr().out
    pruned = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "2010-03" in pruned and "2010-04" in pruned


def test_filter_domain_defaults_and_fallback(make_sales):
    rows = [(c, f"2010-12-0{i + 1} 10:00:00", "1", c, "mug", 1, 1.0) for i, c in enumerate("GFEDCBA")]
    sales = make_sales(rows)
    chosen = as_dict(enrichment.filter_domain(sales, ["A", "Z"]), "Country", "is_default")
    assert [c for c, d in chosen.items() if d] == ["A"]
    domain = enrichment.filter_domain(sales, ["Z"])
    assert [r["Country"] for r in domain.collect()] == list("ABCDEFG")
    assert [c for c, d in as_dict(domain, "Country", "is_default").items() if d] == list("ABCDE")
    first = domain.first()
    assert (first["min_date"], first["max_date"]) == (dt.date(2010, 12, 1), dt.date(2010, 12, 7))
    assert enrichment.filter_domain(sales.limit(0)).count() == 0


def test_normalized_ids(spark):
    ids = ["17850.0", "17850", " 17850 ", "", "  ", None, "abc", "NaN", "1e3"]
    df = spark.createDataFrame([(i,) for i in ids], "CustomerID string")
    got = [r[0] for r in df.select(normalized_customer_id()).collect()]
    assert got == ["17850", "17850", "17850", None, None, None, None, None, "1000"]


def test_preview_is_ordered_and_short(raw):
    rows = enrichment.preview(raw, 3).collect()
    assert [r["InvoiceNo"] for r in rows] == [None, "100", "101"]
