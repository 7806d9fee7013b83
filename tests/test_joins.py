import pytest
from pyspark.sql import functions as F

from tallyloom.functions.joins import skew_join
from tallyloom.functions.running import running_total
from tallyloom.functions import joins, staging
from tallyloom.functions.staging import clear_stages, stage, stage_path, stage_scope


@pytest.fixture(scope="module")
def tables(spark):
    # key 0 owns a third of the rows; some keys are NULL and some have no lookup row
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"),
        (F.col("id") % 7).alias("x"),
    )
    lookup = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("y"))
    return rows, lookup


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_split_keys_give_the_plain_join(tables, how):
    rows, lookup = tables
    plain = sorted(map(str, rows.join(lookup, "k", how).collect()))
    split = skew_join(rows, lookup, "k", how, task_rows=100)
    assert sorted(map(str, split.collect())) == plain
    assert split.columns == rows.join(lookup, "k", how).columns


def test_hot_key_is_spread_over_tasks(spark, tables):
    rows, lookup = tables
    conf = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:

        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        total = rows.join(lookup, "k").count()
        assert largest(rows.join(lookup, "k")) > total / 3
        # rows repeat few distinct contents, so the input partition has to do the spreading
        assert largest(skew_join(rows, lookup, "k", task_rows=30)) < total / 4
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_counts_from_the_lookup(tables):
    rows, _ = tables
    lookup = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("m"))
    joined = skew_join(rows, lookup, "k", task_rows=200, row_count="n")
    assert joined.columns == ["k", "x", "m"]
    assert joined.count() == rows.filter("k is not null").count()


def test_salts_grow_with_the_rows_of_a_key(spark):
    def salts(n):
        rows = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("x"))
        lookup = spark.range(3).select(F.col("id").cast("int").alias("k"))
        plan = skew_join(rows, lookup, "k", task_rows=100)
        assert plan.count() == n
        return rows.groupBy("k").count().select(F.ceil(F.col("count") / 100)).first()[0]

    assert salts(1000) == 10 and salts(4000) == 40


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_more_hot_keys_than_a_list_may_hold(tables, monkeypatch, how):
    monkeypatch.setattr(joins, "MOST_LISTED_KEYS", 5)
    rows, lookup = tables
    plain = sorted(map(str, rows.join(lookup, "k", how).collect()))
    split = skew_join(rows, lookup, "k", how, task_rows=40)  # 40 keys have more
    assert sorted(map(str, split.collect())) == plain
    assert split.columns == rows.join(lookup, "k", how).columns


def test_many_hot_keys_leave_no_task_above_its_share(spark, monkeypatch):
    """Keys of 50 to 5,000 rows, nearly all of them hot; a plain join gives the largest one to one task."""
    monkeypatch.setattr(joins, "MOST_LISTED_KEYS", 20)
    keys = spark.range(200).select(F.col("id").alias("k"), F.expr("if(id % 40 = 0, 5000, 50)").alias("n"))
    rows = keys.select("k", F.explode(F.expr("sequence(1, n)")).alias("x")).repartition(8)
    lookup = spark.range(150).select(F.col("id").alias("k"), (F.col("id") * 10).alias("y"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    before = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        split = skew_join(rows, lookup, "k", task_rows=45)
        assert "Broadcast" not in split._jdf.queryExecution().executedPlan().toString()
        tasks = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
        total = rows.join(lookup, "k").count()
        assert sum(tasks) == total == 27300 and max(tasks) < 3 * total / 64
        plain = [r["count"] for r in rows.join(lookup, "k").groupBy(F.spark_partition_id()).count().collect()]
        assert max(plain) >= 5000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_running_total_over_ranges(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"), F.lit(3).alias("n"))
    got = running_total(df, ["g"], [F.desc("v")], "n", "upto").collect()
    assert len(got) == 500 and all(r["upto"] == 3 * ((499 - r["v"]) // 2 + 1) for r in got)


def test_stages_live_in_the_shared_folder(spark):
    staged = stage(spark.range(5), "numbers")
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]
    assert staged.count() == 5 and stage_path(spark, "a") != stage_path(spark, "a")


def test_clearing_removes_the_own_tables_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "stage_root", lambda session: str(tmp_path / "app"))
    (tmp_path / "other").mkdir()
    stage(spark.range(5), "numbers")
    assert len(list((tmp_path / "app").iterdir())) == 1
    clear_stages(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]


def test_a_scope_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "stage_root", lambda session: str(tmp_path))
    with stage_scope(spark):
        assert stage(spark.range(5), "outer").count() == 5
        with stage_scope(spark):
            assert stage(spark.range(6), "inner").count() == 6
    assert list(tmp_path.iterdir()) == []


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Context:
        applicationId, master = "app-1", "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        staging.stage_root(Session())
    Context.master = "local[2]"
    assert staging.stage_root(Session()) == staging.stage_root(Session())
