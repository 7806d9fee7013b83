from conftest import as_dict

from tallyloom.operators import trends


def test_daily_and_monthly_by_country(make_sales):
    sales = make_sales(
        [
            ("1", "2010-12-01 10:00:00", "a", "X", "mug", 2, 1.5),
            ("1", "2010-12-01 10:00:00", "a", "X", "cup", 1, 1.0),
            ("2", "2010-12-02 10:00:00", "a", "X", "mug", 1, 1.5),
            ("3", "2011-01-02 10:00:00", "b", "Y", "mug", 1, 1.5),
        ]
    )
    daily = [tuple(map(str, r)) for r in trends.sales_daily(sales).collect()]
    assert daily == [
        ("2010-12-01", "X", "4.0", "1", "3"),
        ("2010-12-02", "X", "1.5", "1", "1"),
        ("2011-01-02", "Y", "1.5", "1", "1"),
    ]
    monthly = [tuple(r) for r in trends.sales_monthly(sales).collect()]
    assert monthly == [("2010-12", "X", 5.5, 2, 4), ("2011-01", "Y", 1.5, 1, 1)]
    assert [tuple(r) for r in trends.monthly_revenue(sales).collect()] == [("2010-12", 5.5), ("2011-01", 1.5)]


def test_invoice_over_midnight_counts_twice_by_weekday_only(make_sales):
    sales = make_sales(
        [
            ("1", "2010-12-01 23:59:00", "a", "X", "mug", 1, 1.0),
            ("1", "2010-12-02 00:01:00", "a", "X", "mug", 1, 1.0),
            ("2", "2010-12-02 10:00:00", "a", "X", "mug", 1, 1.0),
        ]
    )
    assert tuple(trends.kpi_sales(sales).first()) == (3.0, 3, 2, 3)


def test_reporting_days_leave_out_saturday(make_sales):
    sales = make_sales(
        [
            ("1", "2010-12-04 10:00:00", "a", "X", "mug", 1, 9.0),  # Saturday
            ("2", "2010-12-05 10:00:00", "a", "X", "mug", 1, 2.0),  # Sunday
            ("3", "2010-12-06 10:00:00", "a", "X", "mug", 4, 1.0),
            ("3", "2010-12-06 11:00:00", "a", "X", "cup", 2, 1.0),
            ("4", "2010-12-06 12:00:00", "b", "X", "mug", 1, 1.0),
        ]
    )
    ordered = [(r["Day"], r["Total_Sales"], r["Transactions"]) for r in trends.dow_sales_ordered(sales).collect()]
    assert ordered == [
        ("Monday", 7.0, 2),
        ("Tuesday", None, None),
        ("Wednesday", None, None),
        ("Thursday", None, None),
        ("Friday", None, None),
        ("Sunday", 2.0, 1),
    ]
    assert [tuple(r) for r in trends.dow_basket(sales).collect()] == [("Monday", 7.0, 2, 3.5), ("Sunday", 2.0, 1, 2.0)]
    assert "Saturday" in as_dict(trends.dow_sales(sales), "Day", "Transactions")


def test_hours(make_sales):
    rows = [(h, f"2010-12-01 {h}:30:00", "a", "X", "mug", 1, 2.0) for h in ["09", "10", "15", "16"]]
    sales = make_sales(rows)
    hourly = [(r["Hour"], r["is_peak"]) for r in trends.hourly_sales(sales).collect()]
    assert hourly == [("09:00", False), ("10:00", True), ("15:00", True), ("16:00", False)]
    assert as_dict(trends.hourly_basket(sales), "Hour", "AvgBasketSize") == {9: 2.0, 10: 2.0, 15: 2.0, 16: 2.0}


def test_moving_average_needs_seven_rows(make_sales):
    days = [1, 2, 3, 5, 8, 9, 10, 20]
    rows = [
        (f"{d}-{i}", f"2010-12-{d:02d} 10:00:00", "a", "X", "mug", 1, 1.0)
        for d in days
        for i in range(d)
    ]
    averages = [r["MA7"] for r in trends.daily_transactions_ma(make_sales(rows)).collect()]
    assert averages[:6] == [None] * 6
    assert averages[6:] == [round(sum(days[:7]) / 7, 6), round(sum(days[1:]) / 7, 6)]


def test_products_ties_long_names_and_missing_names(make_sales):
    long_name = "a very long product name that goes on"
    sales = make_sales(
        [
            ("1", "2010-12-01 10:00:00", "a", "X", "mug", 5, 1.0),
            ("1", "2010-12-01 10:00:00", "a", "X", "cup", 5, 1.0),
            ("1", "2010-12-01 10:00:00", "a", "X", None, 50, 1.0),
            ("1", "2010-12-01 10:00:00", "a", "X", long_name, 9, 1.0),
            ("1", "2010-12-01 10:00:00", "a", "X", "x" * 25, 1, 1.0),
        ]
    )
    top = [(r["Product"], r["ShortName"]) for r in trends.top_products(sales, 3).collect()]
    assert top == [(long_name, long_name[:25] + "..."), ("cup", "cup"), ("mug", "mug")]
    assert as_dict(trends.top_products(sales), "Product", "ShortName")["x" * 25] == "x" * 25
    assert trends.product_sales(sales).count() == 4


def test_home_and_abroad(make_sales):
    sales = make_sales(
        [(str(i), "2010-12-01 10:00:00", "a", c, "mug", 1, v) for i, (c, v) in enumerate([("H", 6.0), ("A", 1.0), ("B", 1.0), (None, 5.0)])]
    )
    shares = {r["market"]: (r["Total_Sales"], r["share_pct"]) for r in trends.home_vs_international(sales, "H").collect()}
    assert shares == {"home": (6.0, 75.0), "international": (2.0, 25.0)}
    assert [r["Country"] for r in trends.top_international(sales, "H", 1).collect()] == ["A"]
    nothing = trends.home_vs_international(sales.limit(0), "H").collect()
    assert {(r["Total_Sales"], r["share_pct"]) for r in nothing} == {(0.0, None)}


def test_price_quantity_histogram(make_sales):
    prices = [(0.5, 1), (5.0, 1), (5.5, 20), (0.0, 3)]
    sales = make_sales([(str(i), "2010-12-01 10:00:00", "a", "X", "mug", q, p) for i, (p, q) in enumerate(prices)])
    bins = {(r["price_bin"], r["qty_bin"]): r["Lines"] for r in trends.price_quantity_bins(sales, 1).collect()}
    assert bins == {(-1, 0): 1, (0, 0): 1, (0, 1): 1}
