import datetime as dt
import random

import pytest
from conftest import as_dict

from tallyloom.operators import cohorts, customers


@pytest.fixture(scope="module")
def sales(make_sales):
    random.seed(5)
    rows = []
    for i in range(600):
        # one customer owns a third of all lines
        customer = "hot" if i % 3 == 0 else f"c{random.randrange(25)}"
        day = dt.date(2010, 11, 3) + dt.timedelta(days=random.randrange(400))
        ts = f"{day} {random.randrange(24):02d}:00:00"
        rows.append((f"i{i // 2}", ts, customer, random.choice("XYZ"), "mug", random.randrange(1, 9), 1.25))
    rows.append(("n", "2010-11-01 00:00:00", None, "X", "mug", 1, 1.0))
    return make_sales(rows)


@pytest.fixture(scope="module")
def lines(sales):
    return [r.asDict() for r in sales.collect() if r["CustomerID"] is not None]


def _months(lines):
    first = {}
    for r in lines:
        first[r["CustomerID"]] = min(r["InvoiceTS"], first.get(r["CustomerID"], r["InvoiceTS"]))
    return first


def test_rfm_counts_calendar_days(make_sales):
    sales = make_sales(
        [
            ("1", "2010-12-01 23:59:00", "a", "X", "mug", 2, 1.5),
            ("2", "2010-12-01 10:00:00", "a", "X", "mug", 1, 1.0),
            ("3", "2010-12-02 00:01:00", "b", "X", "mug", 1, 1.0),
        ]
    )
    rows = {r["CustomerID"]: r for r in customers.compute_rfm(sales).collect()}
    a = rows["a"]
    assert (a["Recency"], a["Frequency"], a["Monetary"], a["Sum_Qty"]) == (1, 2, 4.0, 3)
    assert rows["b"]["Recency"] == 0
    fixed = as_dict(customers.compute_rfm(sales, "2010-12-10"), "CustomerID", "Recency")
    assert fixed == {"a": 9, "b": 8}
    extra = customers.compute_rfm(sales, dt.date(2010, 12, 10), ["UnitPrice"])
    assert as_dict(extra, "CustomerID", "UnitPrice") == {"a": 1.5, "b": 1.0}


def test_top_customers_and_first_country(make_sales):
    sales = make_sales(
        [
            ("2", "2010-12-02 10:00:00", "1.0", "Y", "mug", 4, 1.0),
            ("1", "2010-12-01 10:00:00", "1.0", "X", "mug", 1, 1.0),
            ("3", "2010-12-01 10:00:00", "2.0", "Z", "mug", 5, 1.0),
            ("3", "2010-12-01 10:00:00", "10.0", "Z", "mug", 5, 1.0),
            ("4", "2010-12-01 10:00:00", None, "Z", "mug", 99, 1.0),
        ]
    )
    assert [tuple(r) for r in customers.top_customers(sales, 2).collect()] == [("1", 5.0), ("10", 5.0)]
    assert as_dict(customers.customer_country(sales), "CustomerID", "Country") == {"1.0": "X", "2.0": "Z", "10.0": "Z"}


def test_repeat_kpis_and_loyalty(spark):
    profiles = spark.createDataFrame(
        [("a", "s", 1, 10.0), ("b", "s", 2, 40.0), ("c", "t", 3, 90.0), ("d", None, None, None)],
        "CustomerID string, Segment string, Frequency int, Monetary double",
    )
    repeat = {r["buyer_type"]: (r["Customers"], r["share_pct"]) for r in customers.repeat_purchase(profiles).collect()}
    assert repeat == {"repeat": (2, 66.666667), "one_time": (1, 33.333333)}
    assert tuple(customers.kpi_customers(profiles).first()) == (4, 2, 46.67, 2.0)
    assert tuple(customers.loyalty_effect(profiles).first()) == (10.0, 0.0, 1.0, 3)
    assert customers.kpi_customers(profiles.limit(0)).first()["total_customers"] == 0


def test_cohorts_match_brute_force(sales, lines):
    first = _months(lines)
    cells = {}
    for r in lines:
        f, t = first[r["CustomerID"]], r["InvoiceTS"]
        key = (f.strftime("%Y-%m"), (t.year - f.year) * 12 + t.month - f.month + 1)
        cells.setdefault(key, set()).add(r["CustomerID"])
    expected = {k: len(v) for k, v in cells.items()}
    got = {(r["CohortMonth"], r["CohortIndex"]): r["Customers"] for r in cohorts.cohort_counts(sales).collect()}
    assert got == expected
    for r in cohorts.cohort_retention(sales).collect():
        size = expected[(r["CohortMonth"], 1)]
        assert r["CohortSize"] == size and r["Retention"] == pytest.approx(r["Customers"] / size, abs=1e-6)


def test_wide_retention_has_every_month(sales):
    wide = cohorts.cohort_retention_wide(sales)
    long = {(r["CohortMonth"], r["CohortIndex"]): r["Retention"] for r in cohorts.cohort_retention(sales).collect()}
    occurring = sorted({i for _, i in long})
    assert wide.columns == ["CohortMonth"] + [f"m{i}" for i in occurring]
    for r in wide.collect():
        for i in occurring:
            assert r[f"m{i}"] == long.get((r["CohortMonth"], i))
    assert cohorts.cohort_retention_wide(sales, [1, 2]).columns == ["CohortMonth", "m1", "m2"]
    assert cohorts.cohort_retention_wide(sales.limit(0)).count() == 0


def test_cohort_assignment_and_value(sales, lines):
    first = _months(lines)
    rows = cohorts.cohort_assign(sales).collect()
    assert len(rows) == len(lines)
    assert all(r["CohortMonth"] == first[r["CustomerID"]].strftime("%Y-%m") and r["CohortIndex"] >= 1 for r in rows)
    spend, members = {}, {}
    for r in lines:
        month = first[r["CustomerID"]].strftime("%Y-%m")
        spend[month] = spend.get(month, 0.0) + r["TotalAmount"]
        members.setdefault(month, set()).add(r["CustomerID"])
    got = as_dict(cohorts.cohort_ltv(sales), "CohortMonth", "AvgLTV")
    assert got == {m: pytest.approx(spend[m] / len(members[m]), abs=0.006) for m in spend}


def test_cohorts_follow_the_filter(sales):
    later = sales.filter("InvoiceTS >= '2011-06-01'")
    assert cohorts.cohort_counts(later).agg({"CohortMonth": "min"}).first()[0] == "2011-06"


def test_a_stray_date_adds_no_columns_but_its_own(make_sales):
    rows = [
        ("1", "0001-01-01 10:00:00", "1", "A", "mug", 1, 1.0),
        ("2", "2010-12-01 10:00:00", "1", "A", "mug", 1, 1.0),
        ("3", "2011-01-01 10:00:00", "2", "A", "mug", 1, 1.0),
    ]
    wide = cohorts.cohort_retention_wide(make_sales(rows))
    assert wide.columns == ["CohortMonth", "m1", "m24120"] and wide.count() == 2


def test_top_customers_have_one_spelling_and_an_id(make_sales):
    rows = [
        ("1", "2010-12-01 10:00:00", "", "A", "mug", 100, 1.0),
        ("2", "2010-12-01 10:00:00", "17850", "A", "mug", 2, 1.0),
        ("3", "2010-12-01 10:00:00", "17850.0", "A", "mug", 3, 1.0),
        ("4", "2010-12-01 10:00:00", "7", "A", "mug", 4, 1.0),
    ]
    got = [tuple(r) for r in customers.top_customers(make_sales(rows)).collect()]
    assert got == [("17850", 5.0), ("7", 4.0)]
