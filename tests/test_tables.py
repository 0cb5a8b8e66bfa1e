from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from panelcast import Cutoffs, Workflow, make_model
from panelcast.operators.compare import assert_frames_equal, frame_diff, numbered
from panelcast.sources import tables
from panelcast.sources.spool import shared_folder, spool
from tests.conftest import SCHEMA, SPEC, days, facts, rows

FIRST = date(2018, 12, 1)


@pytest.fixture
def database(spark, request):
    name = request.node.name.lower().replace("[", "_").replace("]", "").replace("-", "_")
    tables.create_database(spark, name)
    return name


def test_csv_is_read_with_the_declared_schema(spark, tmp_path):
    (tmp_path / "f.csv").write_text("date;store;item;sales\n2020-01-02;1;2;3.5\n2020-01-03;1;2;\n")
    df = tables.read_csv(spark, str(tmp_path / "f.csv"), "date date, store int, item int, sales double", sep=";")
    assert rows(df) == [(date(2020, 1, 2), 1, 2, 3.5), (date(2020, 1, 3), 1, 2, None)]


def test_database_and_table_are_created_once(spark, database):
    tables.create_database(spark, database)
    schema = spark.createDataFrame([], SCHEMA).schema
    for _ in range(2):
        tables.create_table(spark, database, "t", schema)
    assert spark.catalog.databaseExists(database)
    assert tables.read_table(spark, database, "t").count() == 0
    info = tables.table_info(spark, database, "t")
    assert info["Type"] == "MANAGED" and info["sales"] == "double" and not any(k.startswith("#") for k in info)


def test_overwrite_replaces_and_append_adds(spark, database):
    df = facts(spark, days(FIRST, [1, 2, 3]))
    tables.write_table(df, database, "t")
    tables.write_table(df.limit(1), database, "t")
    assert tables.read_table(spark, database, "t").count() == 1
    tables.write_table(df, database, "t", mode="append")
    assert tables.read_table(spark, database, "t").count() == 4


@pytest.mark.parametrize("buckets", [None, 3])
def test_partition_overwrite_keeps_the_others(spark, database, buckets):
    def part(model, value):
        return facts(spark, days(FIRST, [value] * 4)).withColumn("model", F.lit(model))

    tables.create_table(spark, database, "t", part("A", 1).schema, ["model"], SPEC.keys, [SPEC.time], buckets)
    for model, value in (("A", 1), ("B", 2), ("A", 3)):
        # columns in another order: they are matched by name
        tables.overwrite_partitions(part(model, value).select("model", *SPEC.columns), database, "t")
    got = tables.read_table(spark, database, "t").groupBy("model").agg(F.sum("sales").alias("s"))
    assert rows(got) == [("A", 12.0), ("B", 8.0)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_catalog_choice(spark):
    tables.use_catalog(spark, "spark_catalog")
    assert spark.catalog.currentCatalog() == "spark_catalog"


def test_settings_are_put_back_after_an_error(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    with pytest.raises(RuntimeError):
        with tables.setting(spark, "spark.sql.ansi.enabled", "false"):
            raise RuntimeError
    assert spark.conf.get("spark.sql.ansi.enabled") == before


def test_spooled_frames_are_read_from_the_shared_folder(spark):
    df = facts(spark, days(FIRST, [1, 2]))
    stored = spool(df)
    assert rows(stored) == rows(df) and spool(stored) is stored
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) in stored.inputFiles()[0]


# ------------------------------------------------------------------------ workflow


def write_csv(tmp_path, *series):
    lines = ["store,item,date,sales"] + [f"{s},{i},{t},{'' if y is None else y}" for part in series for s, i, t, y in part]
    (tmp_path / "facts.csv").write_text("\n".join(lines))
    return str(tmp_path / "facts.csv")


@pytest.mark.parametrize("buckets", [None, 4])
def test_workflow_from_csv_to_forecast(spark, database, tmp_path, buckets):
    path = write_csv(
        tmp_path,
        days(FIRST, range(1, 31)),
        days(FIRST, [5] * 30, store=1, item=2),
        days(FIRST, range(1, 31), store=2),  # dropped by the key filter
    )
    flow = Workflow(database, SPEC, Cutoffs(date(2018, 12, 31), 727, 5), steps=2, metrics=("rmse", "mae"), select_on="mae", buckets=buckets)
    models = [make_model("NaiveMean"), make_model("NaiveDrift")]
    error = flow.run(spark, path, SCHEMA, models, keep=("store", [1]))
    read = lambda t: tables.read_table(spark, database, t)
    assert read("input").count() == 60
    assert rows(read("split").filter("item = 1").groupBy("split").count()) == [("test", 5), ("train", 25)]
    on_test = {r["date"] for r in read("forecast_on_test").collect()}
    assert on_test == {date(2018, 12, 26) + timedelta(days=i) for i in range(5)}
    assert {r["date"] for r in read("all_models_forecast").collect()} == {date(2018, 12, 31), date(2019, 1, 1)}
    assert read("metrics").count() == 8
    best = {r["item"]: (r["model"], r["value"]) for r in read("best_models").collect()}
    assert best == {1: ("NaiveDrift", pytest.approx(0)), 2: ("NaiveDrift", pytest.approx(0))}
    assert error == pytest.approx(0)
    got = read("forecast").filter("item = 1").orderBy("date").collect()
    assert [(r["model"], r["sales"]) for r in got] == [("NaiveDrift", pytest.approx(31)), ("NaiveDrift", pytest.approx(32))]
    log = {r["step"]: r for r in read("run_log").collect()}
    assert set(log) == {"create_database", "ingest", "split", "model", "evaluate"}
    assert log["evaluate"]["metric"] == "mae" and log["model"]["params"]["models"] == "NaiveMean,NaiveDrift"
    # one model again: the other keeps its partition, and the tables stay whole
    flow.model(spark, [make_model("NaiveMean")])
    assert read("all_models_forecast").count() == 8
    flow.evaluate(spark)
    assert read("forecast").count() == 4


def test_bucketed_tables_are_joined_without_a_shuffle(spark, database, tmp_path):
    from panelcast.operators import scoring
    from panelcast.operators.vectors import series_vectors

    path = write_csv(tmp_path, *[days(FIRST, range(1, 31), store=s) for s in range(1, 6)])
    cut = Cutoffs(date(2018, 12, 31), 727, 5)
    flow = Workflow(database, SPEC, cut, steps=2, metrics=("mae",), select_on="mae", buckets=4)
    flow.run(spark, path, SCHEMA, [make_model("NaiveMean"), make_model("NaiveDrift")])
    read = lambda t: tables.read_table(spark, database, t)
    with (
        tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"),
        tables.setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"),
    ):
        joined = scoring.score_join(read("split").filter("split = 'test'"), read("forecast_on_test"), SPEC, null_keys=False)
        for df in (
            series_vectors(read("split"), SPEC, cut),
            scoring.metrics_long(joined, SPEC, ["mae"]),
            scoring.best_model(read("metrics"), SPEC, "mae"),
            scoring.champion_forecast(read("all_models_forecast"), read("best_models"), SPEC, null_keys=False),
        ):
            assert "Exchange " not in df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------------- comparison


def test_differences_keep_copies_and_can_round(spark):
    one = spark.createDataFrame([(1, 0.123), (1, 0.123), (2, None)], "k int, v double")
    two = spark.createDataFrame([(1, 0.12301), (3, 1.0)], "k int, v double")
    assert rows(frame_diff(one, two, digits=3)) == [("actual", 3, 1.0, 1), ("expected", 1, 0.123, 1), ("expected", 2, None, 1)]
    assert frame_diff(one, two).count() == 4
    assert_frames_equal(one, one)
    with pytest.raises(AssertionError, match="frames differ"):
        assert_frames_equal(one, two)
    with pytest.raises(ValueError):
        frame_diff(one, two.withColumn("v", F.col("v").cast("float")))


def test_order_counts_when_asked_for(spark):
    one = spark.range(100).repartition(4).sortWithinPartitions("id").coalesce(2).selectExpr("id * 1.0 AS v")
    assert rows(numbered(one).select("row")) == sorted(((i,) for i in range(100)), key=repr)
    up = spark.createDataFrame([(1,), (2,), (3,)], "v int").coalesce(1)
    down = up.orderBy(F.desc("v")).coalesce(1)
    assert_frames_equal(up, down)
    with pytest.raises(AssertionError):
        assert_frames_equal(up, down, ignore_order=False)
    assert_frames_equal(up, down.orderBy("v"), ignore_order=False)


def test_the_number_of_buckets_follows_the_panel(spark, database, tmp_path):
    path = write_csv(tmp_path, *[days(FIRST, range(i, i + 30), item=i) for i in range(1, 13)])
    cut, models = Cutoffs(date(2018, 12, 31), 40, 5), [make_model("NaiveMean"), make_model("NaiveDrift")]
    flow = Workflow(database, SPEC, cut, steps=2, metrics=("mae",), select_on="mae", buckets=2, bucket_cells=80)
    flow.run(spark, path, SCHEMA, models)
    written = ("split", "forecast_on_test", "all_models_forecast", "runs", "metrics", "best_models", "forecast", "no_forecast")
    assert {tables.bucket_count(spark, database, t) for t in written} == {6}
    assert tables.bucket_count(spark, database, "input") is None
    # Forecasts that are kept bind a later run to their number.
    larger = Workflow(database, SPEC, cut, steps=2, metrics=("mae",), select_on="mae", buckets=2, bucket_cells=40)
    larger.run(spark, path, SCHEMA, models)
    assert {tables.bucket_count(spark, database, t) for t in written} == {6}
    tables.create_database(spark, f"{database}_fixed")
    fixed = Workflow(f"{database}_fixed", SPEC, cut, steps=2, metrics=("mae",), select_on="mae", buckets=2)
    fixed.run(spark, path, SCHEMA, models)
    assert rows(tables.read_table(spark, fixed.database, "forecast")) == rows(tables.read_table(spark, database, "forecast"))
    for bad in ({"bucket_cells": 5}, {"buckets": 2, "bucket_cells": 0}):
        with pytest.raises(ValueError):
            Workflow(database, SPEC, cut, **bad)
