"""Results that used to be lost without a word: null keys, missing champions, leftovers of other runs."""

import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from panelcast import Cutoffs, Plugin, Workflow, make_model
from panelcast.functions.metrics import METRICS
from panelcast.functions.arima import ArimaSettings, forecast_block
from panelcast.operators import scoring
from panelcast.operators.models import dropped_settings, forecast_rows, history
from panelcast.operators.panel import label_split, only
from panelcast.operators.vectors import unroll
from panelcast.plans import champion
from panelcast.sources import tables
from tests.conftest import SCHEMA, SPEC, days, rows, vectors_of

FIRST = date(2018, 12, 1)


def test_r2_holds_for_large_means_in_rows_and_arrays(spark):
    from panelcast.functions.metrics import ArrayResiduals, RowResiduals

    ys = [1e8 + 5 * ((i % 3) - 1) for i in range(21)]
    mean = sum(ys) / len(ys)
    df = spark.createDataFrame([(i, y, mean) for i, y in enumerate(ys)], "i int, y double, p double")
    by_row = df.agg(METRICS["r2"](RowResiduals(F.col("y"), F.col("p"), F.col("i"))).alias("v")).first().v
    arrays = df.agg(F.collect_list("y").alias("y"), F.collect_list("p").alias("p"))
    by_array = arrays.select(METRICS["r2"](ArrayResiduals(F.col("y"), F.col("p"))).alias("v")).first().v
    assert math.isclose(by_row, 0, abs_tol=1e-6) and math.isclose(by_array, 0, abs_tol=1e-6)


def test_metrics_leave_out_actuals_without_a_prediction(spark):
    from panelcast.functions.metrics import RowResiduals

    df = spark.createDataFrame([(0, 10.0, 12.0), (1, 20.0, 18.0), (2, 900.0, None)], "i int, y double, p double")
    r = RowResiduals(F.col("y"), F.col("p"), F.col("i"))
    got = df.agg(*[METRICS[n](r).alias(n) for n in ("ope", "r2", "marre")]).first()
    assert got.ope == 0 and math.isclose(got.r2, 1 - 8 / 50) and math.isclose(got.marre, 20.0)


def test_null_keys_are_series_on_both_roads(spark):
    series = [days(FIRST, range(1, 31)), days(FIRST, range(5, 35), store=None, item=2)]
    models = [make_model("NaiveMean"), make_model("NaiveDrift")]
    vectors = vectors_of(spark, *series, test_size=5)
    tested = champion.backtest(vectors, SPEC, models, 5, 3, ("mae",), "mae")
    cut = Cutoffs(FIRST + timedelta(days=30), 400, 5)
    panel = label_split(unroll(vectors, SPEC, "start", "ys"), SPEC, cut)
    joined = scoring.score_join(only(panel, "test"), forecast_rows(history(vectors, SPEC, "train"), SPEC, models, 5), SPEC)
    best = scoring.best_model(scoring.metrics_long(joined, SPEC, ["mae"]), SPEC, "mae")
    ahead = scoring.champion_forecast(forecast_rows(history(vectors, SPEC, "full"), SPEC, models, 3), best, SPEC)
    assert rows(ahead) == rows(champion.best_forecast(tested, SPEC)) and ahead.filter("store IS NULL").count() == 3


def test_series_without_a_champion_are_reported(spark):
    last = FIRST + timedelta(days=29)
    series = [
        days(FIRST, range(1, 31)),
        days(FIRST, [5.0] * 25 + [0.0] * 5, store=2),
        days(last - timedelta(days=2), [1, 2, 3], store=3),
    ]
    vectors = vectors_of(spark, *series, test_size=5)
    tested = champion.backtest(vectors, SPEC, [make_model("NaiveMean")], 5, 3)
    assert rows(champion.no_forecast(tested, SPEC)) == [
        (2, 1, "no model has a defined mape on the test days"),
        (3, 1, "too few training days for every model"),
    ]
    assert {r.store for r in champion.best_forecast(tested, SPEC).collect()} == {1}


class Fussy:
    def fit(self, series):
        if series.iloc[-1] == 0:
            raise ValueError("ends idle")
        self.level = series.iloc[-1]

    def predict(self, n):
        return [self.level] * n


@pytest.mark.parametrize("null_keys", [False, True])
def test_workflow_lists_what_has_no_forecast(spark, tmp_path, null_keys):
    database = f"missing_{int(null_keys)}"
    series = [
        days(FIRST, range(1, 31)),
        days(FIRST, [5.0] * 29 + [0.0], store=2),
        days(FIRST, [5.0] * 26 + [0.0] * 3 + [5.0], store=3),
        days(FIRST + timedelta(days=27), [1, 2, 3], store=None if null_keys else 4),
    ]
    lines = ["store,item,date,sales"] + [f"{'' if s is None else s},{i},{t},{y}" for part in series for s, i, t, y in part]
    (tmp_path / "facts.csv").write_text("\n".join(lines))
    flow = Workflow(database, SPEC, Cutoffs(FIRST + timedelta(days=30), 400, 4), steps=2, metrics=("mape",), buckets=4)
    models = [Plugin("Fussy", Fussy, on_error="report")]
    flow.run(spark, str(tmp_path / "facts.csv"), "store int, item int, date date, sales double", models)
    want = [(2, 1, "Fussy: ValueError: ends idle"), (None if null_keys else 4, 1, "Fussy: needs 1 values")]
    assert rows(tables.read_table(spark, database, "no_forecast")) == sorted(want, key=repr)
    assert tables.read_table(spark, database, "runs").filter("error IS NULL").count() == 2
    # a run without the fault forgets it
    flow.model(spark, [make_model("NaiveMean"), make_model("NaiveDrift", model_id="Fussy")])
    flow.evaluate(spark)
    left = rows(tables.read_table(spark, database, "no_forecast"))
    assert left == [(None if null_keys else 4, 1, "too few training days for every model")]
    if not null_keys:
        with tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            assert "Exchange " not in flow._without(spark, False)._jdf.queryExecution().executedPlan().toString()


def test_reports_give_the_errors_of_plugins(spark):
    vectors = vectors_of(spark, days(FIRST, range(1, 31)), days(FIRST, [5.0] * 30 + [0.0], store=2), test_size=5)
    tested = champion.backtest(vectors, SPEC, [Plugin("Fussy", Fussy, on_error="report")], 5, 3)
    assert rows(champion.no_forecast(tested.withColumn("best", F.lit(None)), SPEC)) == [
        (1, 1, "Fussy: ValueError: ends idle"),
        (2, 1, "Fussy: ValueError: ends idle"),
    ]
    assert champion.metrics_table(tested, SPEC).select("metric").distinct().count() == 3


def test_leftovers_of_a_run_with_other_days_do_not_compete(spark, tmp_path):
    database = "123"  # a name that only quoting lets through
    facts = tmp_path / "facts.csv"
    lines = [f"{FIRST + timedelta(days=i)},1,1,{i + 1}" for i in range(40)]
    facts.write_text("\n".join(["date,store,item,sales", *lines]))
    for end, models in ((30, ["NaiveMean", "NaiveDrift"]), (32, ["NaiveMean"])):
        flow = Workflow(database, SPEC, Cutoffs(FIRST + timedelta(days=end), 400, 5), steps=3, metrics=("mae",), select_on="mae")
        flow.run(spark, str(facts), "date date, store int, item int, sales double", [make_model(m) for m in models])
    assert {r.model for r in tables.read_table(spark, database, "metrics").collect()} == {"NaiveMean"}
    ahead = tables.read_table(spark, database, "forecast").collect()
    assert sorted(r.date for r in ahead) == [FIRST + timedelta(days=d) for d in (32, 33, 34)]


def test_near_ties_go_to_the_first_name(spark):
    metrics = spark.createDataFrame([("b", 1, 1, "mae", 0.3), ("a", 1, 1, "mae", 0.1 + 0.2)], "model string, store int, item int, metric string, value double")
    assert scoring.best_model(metrics, SPEC, "mae").first().model == "a"


@pytest.mark.parametrize("settings", [{}, {"order": (1, 0, 1)}, {"order": (2, 1, 0)}, {"max_p": 5, "max_q": 2}, {"m": 7}, {"m": 4, "order": (1, 1, 1), "seasonal_order": (1, 1, 1)}])
def test_least_length_is_enough_for_any_series(settings):
    import numpy as np

    n = ArimaSettings(**settings).least_length
    for seed in range(5):
        for y in (np.random.default_rng(seed).normal(size=n), np.cumsum(np.random.default_rng(seed).normal(size=n + 1))):
            ahead, _ = forecast_block(y[None], 3, ArimaSettings(**settings))
            assert np.isfinite(ahead).all()
    assert forecast_block(np.zeros((1, n - 1)), 3, ArimaSettings(**settings)) is None


def test_settings_without_a_counterpart_can_be_dropped():
    for name, params in (("PooledXGBModel", {"lags": 1, "lambda": 1, "alpha": 0, "subsample": 0.8, "min_child_weight": 2, "max_bin": 64}), ("Prophet", {"country_holidays": "CL"})):
        with pytest.raises(ValueError):
            make_model(name, params)
        assert make_model(name, params, unsupported="drop").model_id == name
    assert dropped_settings("PooledXGBModel", {"lambda": 1, "lags": 7}) == ["lambda"]


@pytest.mark.parametrize("name", ["XGBModel", "PooledXGBModel"])
def test_one_lag_is_enough_for_trees(spark, name):
    vectors = vectors_of(spark, days(FIRST, [float(i % 2) for i in range(40)]))
    ahead = forecast_rows(history(vectors, SPEC, "full"), SPEC, [make_model(name, {"lags": 1, "n_estimators": 5})], 4)
    assert [round(r.sales) for r in ahead.orderBy("date").collect()] == [0, 1, 0, 1]


def test_search_grids_are_arguments(spark):
    from panelcast.functions.smoothing import COARSE, holt_winters

    vectors = vectors_of(spark, days(FIRST, [float(i % 7) for i in range(40)]))
    same = vectors.select(holt_winters(F.col("ys"), 3).alias("a"), holt_winters(F.col("ys"), 3, coarse=COARSE[:4], fine=[(1, 1, 1)]).alias("b")).first()
    assert len(same.a) == len(same.b) == 3
    with pytest.raises(ValueError):
        make_model("ExponentialSmoothing", {"coarse": [(2, 0, 0)]}).forecast(F.col("ys"), F.col("start"), 3, 1)
