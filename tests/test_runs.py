import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyloom.operators.enrichment import add_total_amount
from tallyloom.operators.cleaning import clean_modular
from tallyloom.operators.customers import compute_rfm
from tallyloom.functions.staging import stage
from tallyloom.plans import runs, star_schema as star
from tallyloom.plans.run_log import RunLog, fingerprint
from tallyloom.schema import EXPORT_COLUMNS, MINIMAL_EXPORT_COLUMNS
from tallyloom.sources.readers import flatten_segments, read_transactions_csv
from tallyloom.sources.segment_store import SegmentStore


@pytest.fixture(scope="module")
def lines(spark):
    return star.raw_transactions(spark, SMALL)


def test_full_run_reaches_every_sink(spark, lines, tmp_path):
    monthly = []
    export, store = str(tmp_path / "export"), str(tmp_path / "store")
    result = runs.run_full(lines, k=4, export_path=export, monthly_sink=monthly.append, store_path=store)
    expected = add_total_amount(clean_modular(lines))
    profiles = compute_rfm(expected)
    assert result.stage_rows == {"raw": lines.count(), "clean": expected.count(), "customers": profiles.count()}
    exported = spark.read.csv(export, header=True)
    assert exported.columns == EXPORT_COLUMNS and exported.count() == expected.count()
    assert monthly[0].agg({"Revenue": "sum"}).first()[0] == pytest.approx(
        expected.agg({"TotalAmount": "sum"}).first()[0], rel=1e-6
    )
    stored = {r["CustomerID"]: r for r in flatten_segments(SegmentStore(spark, store).read()).collect()}
    for row in profiles.filter("trim(CustomerID) <> ''").collect():
        kept = stored.pop(row["CustomerID"])
        assert (kept["Recency"], kept["Frequency"]) == (row["Recency"], row["Frequency"])
        assert kept["Monetary"] == pytest.approx(row["Monetary"])
        assert kept["Segment"] == f"Segment-{kept['Cluster']}" and kept["Cluster"] in range(4)
    assert not stored


def test_full_run_merges_into_an_earlier_store(spark, lines, tmp_path):
    store = SegmentStore(spark, str(tmp_path))
    early = lines.filter("InvoiceDate < '1997-01-01'")
    runs.run_basic(early, store_path=str(tmp_path))
    runs.run_basic(lines.filter("InvoiceDate >= '1997-01-01'"), store_path=str(tmp_path))
    assert store.versions() == [1, 2]
    ids = {r["_id"] for r in store.read().collect()}
    assert ids >= {r["_id"] for r in store.read(1).collect()}


class Killed(Exception):
    pass


def _killed(*_):
    raise Killed


def test_a_killed_run_goes_on_after_its_last_stage(spark, lines, tmp_path, monkeypatch):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    lines.write.csv(source, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    sinks = {"export_path": str(tmp_path / "export"), "store_path": str(tmp_path / "store"), "work_path": work, "inputs": source}
    raw = read_transactions_csv(spark, source)
    with monkeypatch.context() as patch:
        patch.setattr(SegmentStore, "upsert", _killed)  # killed after the clustering
        with pytest.raises(Killed):
            runs.run_full(raw, k=3, **sinks)
    (log,) = [p for p in (tmp_path / "work").iterdir()]
    assert {p.name for p in log.iterdir()} == {"applications", "sales", "export", "profiles", "clusters"}

    broken = raw.withColumn("Country", F.raise_error(F.lit("the raw lines were read again")).cast("string"))
    with monkeypatch.context() as patch:
        patch.setattr(runs, "rfm_kmeans", _killed)  # and neither fitted nor exported again
        patch.setattr(runs, "export_csv", _killed)
        result = runs.run_full(broken, k=3, **sinks)
        again = runs.run_full(broken, k=3, **sinks)  # a whole run is not repeated either
    assert again.stage_rows == result.stage_rows and SegmentStore(spark, sinks["store_path"]).versions() == [1]
    plain = runs.run_full(raw, k=3)
    assert result.stage_rows == plain.stage_rows
    assert (result.clusters.sse, result.clusters.silhouette) == pytest.approx((plain.clusters.sse, plain.clusters.silhouette))
    figures = [sorted((r["CustomerID"], r["Segment"]) for r in flatten_segments(x.segments).collect()) for x in (result, plain)]
    assert figures[0] == figures[1]
    assert sorted(map(tuple, result.clusters.centroids.collect())) == sorted(map(tuple, plain.clusters.centroids.collect()))
    result.log.discard()
    assert not list((tmp_path / "work").iterdir())


def test_a_stage_cut_short_is_made_again_and_other_inputs_start_anew(spark, tmp_path):
    made = []
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("a")

    def log(**settings):
        return RunLog(spark, str(tmp_path / "work"), fingerprint(spark, [str(tmp_path / "in")], **settings))

    def make():
        made.append(1)
        return spark.range(5).toDF("x"), lambda: {"made": len(made)}

    table, facts = log(k=3).table("numbers", make)
    assert facts == {"made": 1} and table.count() == 5
    assert log(k=3).table("numbers", make)[1] == {"made": 1} and log(k=4).table("numbers", make)[1] == {"made": 2}
    mark = f"{log(k=3).folder}/numbers/mark/_SUCCESS"
    os.unlink(mark)  # killed before the mark was committed
    assert log(k=3).table("numbers", make)[1] == {"made": 3}
    (tmp_path / "in" / "b.txt").write_text("b")
    assert log(k=3).table("numbers", make)[1] == {"made": 4}


def test_tables_of_dead_applications_are_deleted(spark, tmp_path):
    dead = tmp_path / "stages" / "app-of-before"
    dead.mkdir(parents=True)
    log = RunLog(spark, str(tmp_path / "work"), "x")
    note = spark.createDataFrame([(str(dead),)], "tables string")
    note.write.parquet(f"{log.folder}/applications/app-of-before")
    kept = stage(spark.range(3), "in-use")
    RunLog(spark, str(tmp_path / "work"), "x")
    assert not dead.exists() and kept.count() == 3
    assert [p.name for p in (tmp_path / "work" / "x" / "applications").iterdir()] == [spark.sparkContext.applicationId]


def test_short_preprocessing(spark, lines):
    frame = runs.preprocess_minimal(lines, star.region_table(spark, SMALL))
    assert frame.columns == [*MINIMAL_EXPORT_COLUMNS, "Quantity_Normalized", "UnitPrice_Standardized"]
    low, high = frame.selectExpr("min(Quantity_Normalized)", "max(Quantity_Normalized)").first()
    assert (low, high) == (0.0, 1.0)


def test_command_line(spark, lines, tmp_path, monkeypatch, capsys):
    from tallyloom import __main__ as cli

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    lines.write.csv(source, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    monkeypatch.setattr(cli, "create_session", lambda: spark)
    monkeypatch.setattr(cli, "clear_stages", lambda session: None)
    cli.main(["full", "--input", source, "--output", out, "--k", "3"])
    assert '"silhouette"' in capsys.readouterr().out
    assert SegmentStore(spark, f"{out}/segments").read().select("segment.label").distinct().count() == 3
    assert not list((tmp_path / "out" / "_work").iterdir())
    cli.main(["preprocess", "--input", source, "--output", f"{out}/again"])
    assert spark.read.csv(f"{out}/again/preprocessed", header=True).columns == EXPORT_COLUMNS
