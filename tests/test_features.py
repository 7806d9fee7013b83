import pytest
from conftest import as_dict
from pyspark.errors import PySparkException
from pyspark.ml.feature import MinMaxScaler, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyloom.operators import features


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [("b", 1, 2.0), ("b", 5, 3.5), ("a", 9, 2.25), ("a", 3, 8.0), ("c", 2, 1.0), (None, 7, 4.0)],
        "Country string, Quantity int, UnitPrice double",
    )


def test_many_labels_are_numbered_in_order(spark):
    n = 20_000
    many = spark.range(n + 3).selectExpr("lpad(id % 20000, 6, '0') as Country")
    labels, count = features.frequency_index(many, "Country", "i")
    assert count == n
    assert as_dict(labels, "Country", "i") == {f"{i:06d}": float(i) for i in range(n)}


def test_index_agrees_with_string_indexer(df):
    indexer = StringIndexer(
        inputCol="Country", outputCol="i", handleInvalid="keep", stringOrderType="frequencyDesc"
    )
    expected = as_dict(indexer.fit(df).transform(df), "Country", "i")
    got = features.encode_by_frequency(df, "Country", "i")
    assert as_dict(got, "Country", "i") == expected == {"a": 0.0, "b": 1.0, "c": 2.0, None: 3.0}
    assert got.columns == [*df.columns, "i"] and got.count() == 6


def test_missing_label_can_fail(df):
    with pytest.raises(PySparkException):
        features.encode_by_frequency(df, "Country", "i", on_missing="error").collect()
    assert features.encode_by_frequency(df.na.drop(), "Country", "i", on_missing="error").count() == 5
    with pytest.raises(ValueError):
        features.encode_by_frequency(df, "Country", "i", on_missing="skip")


def test_scaling_agrees_with_ml_scalers(df):
    vectors = df.select(F.col("Quantity").cast("double").alias("q"), "UnitPrice")
    for column, out in [("q", "qv"), ("UnitPrice", "pv")]:
        vectors = VectorAssembler(inputCols=[column], outputCol=out).transform(vectors)
    for scaler in [
        MinMaxScaler(inputCol="qv", outputCol="qs"),
        StandardScaler(inputCol="pv", outputCol="ps", withMean=True, withStd=True),
    ]:
        vectors = scaler.fit(vectors).transform(vectors)
    expected = vectors.select("q", vector_to_array("qs")[0], vector_to_array("ps")[0]).orderBy("q").collect()
    scaled = features.transform_features(df)
    got = scaled.select("Quantity", "Quantity_Normalized", "UnitPrice_Standardized").orderBy("Quantity").collect()
    for e, g in zip(expected, got, strict=True):
        assert tuple(g) == pytest.approx(tuple(e), abs=1e-12)
    assert dict(scaled.dtypes)["Quantity"] == "double"


def test_constant_columns(spark):
    constant = spark.createDataFrame([(4, 2.0), (4, 2.0)], "Quantity int, UnitPrice double")
    rows = features.transform_features(constant).collect()
    assert {(r["Quantity_Normalized"], r["UnitPrice_Standardized"]) for r in rows} == {(0.5, 0.0)}
    one = features.transform_features(constant.limit(1)).first()
    assert (one["Quantity_Normalized"], one["UnitPrice_Standardized"]) == (0.5, 0.0)
    assert features.transform_features(constant.limit(0)).count() == 0
    single = features.min_max_scale(constant, "Quantity", "n")
    assert {r["n"] for r in single.collect()} == {0.5}
