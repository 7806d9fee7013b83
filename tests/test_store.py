import pytest
from pyspark.sql import functions as F

from tallyloom.schema import SEGMENT_DOCUMENT
from tallyloom.sources.readers import flatten_segments, read_segment_documents
from tallyloom.sources.segment_store import (
    SegmentStore,
    merge_documents,
    push_documents,
    segment_documents,
    upsert_segments,
)


def _docs(spark, *rows):
    return spark.createDataFrame(
        [(i, (1, 2, money), (0, label)) for i, money, label in rows], SEGMENT_DOCUMENT
    )


def _labels(store):
    return {r["CustomerID"]: (r["Monetary"], r["Segment"]) for r in flatten_segments(store).collect()}


def test_insert_update_keep_and_repeat(spark, tmp_path):
    v1, v2, v3 = (str(tmp_path / v) for v in ("v1", "v2", "v3"))
    upsert_segments(_docs(spark, ("a", 1.0, "x"), ("b", 2.0, "y")), v1)
    batch = _docs(spark, ("b", 5.0, "z"), ("c", 3.0, "x"))
    merged = upsert_segments(batch, v2, old_version=v1)
    expected = {"a": (1.0, "x"), "b": (5.0, "z"), "c": (3.0, "x")}
    assert _labels(merged) == expected
    assert _labels(upsert_segments(batch, v3, old_version=v2)) == expected
    assert _labels(spark.read.parquet(v1)) == {"a": (1.0, "x"), "b": (2.0, "y")}
    with pytest.raises(ValueError):
        upsert_segments(batch, v3, old_version=v3 + "/")


def test_null_overwrites_but_absent_field_is_kept(spark):
    store = _docs(spark, ("a", 1.0, "x"), ("b", 2.0, "y"))
    nulls = _docs(spark, ("a", 9.0, "q")).withColumn("segment", F.lit(None).cast(SEGMENT_DOCUMENT["segment"].dataType))
    assert _labels(merge_documents(store, nulls)) == {"a": (9.0, None), "b": (2.0, "y")}
    partial = _docs(spark, ("a", 9.0, "q"), ("n", 4.0, "q")).drop("segment")
    assert _labels(merge_documents(store, partial)) == {"a": (9.0, "x"), "b": (2.0, "y"), "n": (4.0, None)}
    extra = store.withColumn("note", F.lit("hi")).filter("_id = 'a'")
    assert {r["_id"]: r["note"] for r in merge_documents(store, extra).collect()} == {"a": "hi", "b": None}


def test_latest_of_a_repeated_key_wins(spark):
    store = _docs(spark, ("a", 1.0, "x"))
    batch = _docs(spark, ("a", 7.0, "late"), ("a", 9.0, "early"), (None, 1.0, "none"))
    ordered = batch.withColumn("at", F.when(F.col("segment.label") == "late", 2).otherwise(1))
    merged = merge_documents(store, ordered, order_by="at")
    assert merged.columns == ["_id", "rfm", "segment"]
    assert _labels(merged) == {"a": (7.0, "late")}


def test_documents_survive_json(spark, tmp_path):
    labelled = spark.createDataFrame(
        [("17850", 3, 4, 5.5, 1, "Segment-1")],
        "CustomerID string, Recency int, Frequency long, Monetary double, cluster int, segment_label string",
    )
    path = str(tmp_path / "docs")
    segment_documents(labelled).write.json(path)
    documents = read_segment_documents(spark, path, "json")
    assert documents.schema == SEGMENT_DOCUMENT
    assert tuple(flatten_segments(documents).first()) == ("17850", 3, 4, 5.5, 1, "Segment-1")


def test_documents_are_pushed_from_the_executors(spark, tmp_path):
    target = str(tmp_path)

    def send(rows):
        for row in rows:
            with open(f"{target}/{row['_id']}.txt", "w", encoding="utf-8") as handle:
                handle.write(row["segment"]["label"])

    push_documents(_docs(spark, ("a", 1.0, "x"), ("b", 2.0, "y")), send)
    assert sorted(p.name + p.read_text() for p in tmp_path.glob("*.txt")) == ["a.txtx", "b.txty"]


def _files(path):
    return {str(p): (p.stat().st_mtime_ns, p.read_bytes()) for p in path.glob("data/*/bucket=*/*.parquet")}


def test_an_upsert_leaves_the_files_of_other_buckets_alone(spark, tmp_path):
    store = SegmentStore(spark, str(tmp_path), buckets=16)
    assert store.versions() == [] and store.read().count() == 0 and store.read().schema == SEGMENT_DOCUMENT
    first = _docs(spark, *[(str(i), float(i), "x") for i in range(400)])
    assert store.upsert(first) == 1
    before = _files(tmp_path)
    old = {r["path"]: r["bucket"] for r in store.manifest().collect()}
    assert set(old.values()) == set(range(16))
    assert store.upsert(_docs(spark, ("7", -7.0, "z"), ("new", 1.0, "y"))) == 2
    new = {r["path"]: r["bucket"] for r in store.manifest().collect()}
    written = set(new) - set(old)
    assert 1 <= len({new[p] for p in written}) <= 2
    assert {p for p in old if old[p] not in {new[w] for w in written}} == set(new) & set(old)
    assert len(set(new) & set(old)) >= 14
    after = _files(tmp_path)
    assert {p: after[p] for p in before} == before  # neither rewritten nor touched
    expected = {str(i): (float(i), "x") for i in range(400)}
    assert _labels(store.read(1)) == expected
    assert _labels(store.read()) == {**expected, "7": (-7.0, "z"), "new": (1.0, "y")}
    assert store.upsert(_docs(spark, ("7", -7.0, "z"), ("new", 1.0, "y"))) == 3
    assert _labels(store.read()) == _labels(store.read(2))


def test_a_failed_upsert_leaves_the_old_version(spark, tmp_path):
    store = SegmentStore(spark, str(tmp_path), buckets=4)
    store.upsert(_docs(spark, ("a", 1.0, "x"), ("b", 2.0, "y")))
    failing = F.udf(lambda i: 1 / 0, "double")
    bad = _docs(spark, ("a", 1.0, "x")).withColumn("note", failing("_id"))
    with pytest.raises(Exception, match="ZeroDivision"):
        store.upsert(bad)
    assert store.versions() == [1] and _labels(store.read()) == {"a": (1.0, "x"), "b": (2.0, "y")}
    # a manifest that was begun and not committed is no version
    (tmp_path / "versions" / "000000002").mkdir()
    assert store.versions() == [1] and _labels(store.read()) == {"a": (1.0, "x"), "b": (2.0, "y")}
    with pytest.raises(Exception, match="already exists"):
        store.upsert(_docs(spark, ("c", 1.0, "x")))
    assert store.versions() == [1]
    with pytest.raises(ValueError, match="no version 9"):
        store.read(9)


def test_store_keeps_the_merging_rules(spark, tmp_path):
    store = SegmentStore(spark, str(tmp_path), buckets=8)
    store.upsert(_docs(spark, ("a", 1.0, "x"), ("b", 2.0, "y"), ("c", 3.0, "q")))
    batch = _docs(spark, ("a", 7.0, "late"), ("a", 9.0, "early"), (None, 1.0, "none"), ("d", 4.0, "late"))
    ordered = batch.withColumn("at", F.when(F.col("segment.label") == "late", 2).otherwise(1))
    store.upsert(ordered.drop("rfm"), order_by="at")
    assert _labels(store.read()) == {"a": (1.0, "late"), "b": (2.0, "y"), "c": (3.0, "q"), "d": (None, "late")}
    store.upsert(_docs(spark, ("b", 5.0, "y")).withColumn("note", F.lit("hi")))
    notes = {r["_id"]: r["note"] for r in store.read().collect()}
    assert notes == {"a": None, "b": "hi", "c": None, "d": None} and _labels(store.read())["b"] == (5.0, "y")
    store.upsert(_docs(spark))
    assert store.versions() == [1, 2, 3, 4] and _labels(store.read()) == _labels(store.read(3))
    assert _labels(SegmentStore(spark, str(tmp_path), buckets=99).read(1)) == {"a": (1.0, "x"), "b": (2.0, "y"), "c": (3.0, "q")}


def test_forgotten_versions_take_their_own_files_with_them(spark, tmp_path):
    store = SegmentStore(spark, str(tmp_path), buckets=4)
    for value in (1.0, 2.0, 3.0):
        store.upsert(_docs(spark, *[(i, value, "x") for i in "abcdefgh"]))
    store.upsert(_docs(spark, ("a", 4.0, "x")))
    expected = _labels(store.read())
    store.forget(keep=1)
    assert store.versions() == [4] and _labels(store.read()) == expected
    assert len(list((tmp_path / "data").iterdir())) == 2
    store.upsert(_docs(spark, ("b", 5.0, "x")))
    assert _labels(store.read()) == {**expected, "b": (5.0, "x")}
