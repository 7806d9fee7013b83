import numpy as np
import pytest
from conftest import as_dict

from tallyloom.operators import insights


@pytest.fixture(scope="module")
def sales(make_sales):
    return make_sales(
        [
            ("1", "2010-12-01 10:00:00", "1.0", "X", "mug", 10, 1.0),
            ("2", "2010-12-02 10:00:00", "1", "Y", "cup", 1, 5.0),
            ("3", "2010-12-03 10:00:00", "2.0", "Y", "mug", 2, 1.0),
            ("4", "2010-12-03 10:00:00", "3.0", "Y", "jar", 1, 3.0),
            ("5", "2010-12-03 10:00:00", "", "Y", "jar", 1, 99.0),
            ("6", "2010-12-03 10:00:00", None, "Y", "jar", 1, 99.0),
        ]
    )


@pytest.fixture(scope="module")
def segments(spark):
    return spark.createDataFrame(
        [("1", 5, 2, 15.0, 0, "gold"), ("2.0", 100, 1, 2.0, 1, "tin"), ("3", 10, 1, 3.0, 1, "tin"), ("9", 1, 1, 1.0, 1, "tin")],
        "CustomerID string, Recency int, Frequency int, Monetary double, Cluster int, Segment string",
    )


@pytest.fixture(scope="module")
def insight(sales, segments):
    return insights.insight_frame(sales, segments)


def test_frame_joins_on_normalised_ids(insight):
    rows = {r["CustomerID"]: (r["TotalAmount"], r["Invoices"], r["Segment"]) for r in insight.collect()}
    assert rows == {"1": (15.0, 2, "gold"), "2": (2.0, 1, "tin"), "3": (3.0, 1, "tin")}


def test_pareto_and_vip(sales, insight):
    assert [tuple(r) for r in insights.pareto_segments(insight).collect()] == [("gold", 15.0, 75.0), ("tin", 5.0, 100.0)]
    assert tuple(insights.vip_segment(insight).first()) == ("gold", 15.0)
    assert [tuple(r) for r in insights.vip_top_products(sales, insight).collect()] == [("mug", 10.0), ("cup", 5.0)]


def test_country_shares(sales, insight):
    long = [tuple(r) for r in insights.vip_share_by_country(sales, insight).collect()]
    assert long == [("Y", "tin", 2, 100.0), ("X", "gold", 1, 100.0)]
    assert [r[0] for r in insights.vip_share_by_country(sales, insight, 1).collect()] == ["Y"]
    wide = insights.vip_share_by_country_wide(sales, insight, ["gold", "tin"])
    assert {r["Country"]: (r["gold"], r["tin"]) for r in wide.collect()} == {"X": (100.0, 0.0), "Y": (0.0, 100.0)}


def test_churn_labels_and_null_comparisons(spark):
    rows = [("a", 91, 100.0), ("b", 90, 100.0), ("c", 91, 1.0), ("d", 90, 1.0), ("e", None, 100.0), ("f", 95, None)]
    rows += [(f"x{i}", 1, 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "CustomerID string, Recency int, Monetary double")
    got = as_dict(insights.churn_risk(df), "CustomerID", "RiskStatus")
    assert got["a"] == insights.RISK_LAPSED_VIP and got["b"] == insights.RISK_ACTIVE_VIP
    assert got["c"] == insights.RISK_ORDINARY_CHURN
    assert got["d"] == got["e"] == got["f"] == insights.RISK_SAFE
    threshold = insights.churn_risk(df).first()["Threshold"]
    assert threshold == pytest.approx(np.quantile([r[2] for r in rows if r[2] is not None], 0.75))


def test_caps(spark):
    rows = [(i + 1, float((i * 37) % 101)) for i in range(101)]
    df = spark.createDataFrame(rows, "Frequency int, Monetary double")
    caps = insights.loyalty_caps(df).first()
    frequency, monetary = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert caps["freq_p99"] == pytest.approx(np.quantile(frequency, 0.99))
    assert caps["monetary_p98"] == pytest.approx(np.quantile(monetary, 0.98))
    assert caps["avg_spend_p99"] == pytest.approx(np.quantile(monetary / frequency, 0.99), abs=1e-6)
