import math
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast import make_model
from panelcast.functions.metrics import METRICS, mape_eps, python_metric, resolve
from panelcast.operators import scoring
from panelcast.operators.models import forecast_rows, history
from panelcast.operators.panel import label_split, only
from panelcast.operators.vectors import unroll
from panelcast.plans import champion
from panelcast.spec import Cutoffs
from tests.conftest import SPEC, days, facts, rows, vectors_of

LONG = "model string, store int, item int, date date, sales double"
FIRST = date(2018, 12, 9)


def forecasts(spark, **values):
    return spark.createDataFrame(
        [(m, s, 1, d, float(v)) for m, cells in values.items() for s, d, v in cells], LONG
    )


def two_models(spark):
    actual = facts(spark, days(FIRST, [9, 10]))
    day = [FIRST, FIRST + timedelta(days=1)]
    made = forecasts(spark, A=[(1, day[0], 7.3), (1, day[1], 11.8)], B=[(1, day[0], 8.5), (1, day[1], 10.7)])
    return scoring.score_join(actual, made, SPEC)


def value_of(df, metric, model="A", store=1):
    return df.filter((F.col("metric") == metric) & (F.col("model") == model) & (F.col("store") == store)).first()["value"]


def test_metrics_of_two_models(spark):
    joined = two_models(spark)
    assert joined.columns == ["store", "item", "date", "sales", "model", "prediction"]
    long = scoring.metrics_long(joined, SPEC, ["rmse", "mae", "mape", mape_eps()])
    assert long.columns == ["model", "store", "item", "metric", "value"] and long.count() == 8
    expected = {"A": (1.750714, 1.75, 18.4444, 0.184444), "B": (0.608276, 0.6, 6.2778, 0.062778)}
    for model, numbers in expected.items():
        got = [value_of(long, m, model) for m in ("rmse", "mae", "mape", "mape_eps")]
        assert got == pytest.approx(numbers, abs=1e-4)
    best = scoring.best_model(scoring.metrics_long(joined, SPEC, ["mae"]), SPEC, "mae")
    assert [(r["model"], r["metric"], round(r["value"], 3)) for r in best.collect()] == [("B", "mae", 0.6)]
    assert best.columns == long.columns


def test_all_metrics_match_pandas(spark):
    y = pd.Series([4.0, 0.0, 7.0, 5.0, 0.0, 3.0])
    p = pd.Series([3.5, 0.0, 9.0, 4.0, 1.0, 3.0])
    made = forecasts(spark, A=[(1, FIRST + timedelta(days=i), v) for i, v in enumerate(p)])
    joined = scoring.score_join(facts(spark, days(FIRST, y)), made, SPEC)
    wide = scoring.metrics_wide(joined, SPEC, [*METRICS, mape_eps(0.5)]).first()
    e, some = p - y, y != 0
    expected = {
        "mse": (e**2).mean(),
        "rmse": math.sqrt((e**2).mean()),
        "mae": e.abs().mean(),
        "mape": 100 * (e[some] / y[some]).abs().mean(),
        "smape": 200 * (e.abs() / (y.abs() + p.abs())).mean(),  # pandas leaves out 0 / 0
        "bias": e.mean(),
        "ope": 100 * abs((y.sum() - p.sum()) / y.sum()),
        "rmsle": math.sqrt((((1 + y).map(math.log) - (1 + p).map(math.log)) ** 2).mean()),
        "r2_score": 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(),
        "coefficient_of_variation": 100 * math.sqrt((e**2).mean()) / y.mean(),
        "mape_eps": (e.abs() / (y + 0.5)).mean(),
    }
    assert {n: wide[n] for n in expected} == {n: pytest.approx(v) for n, v in expected.items()}
    cover = scoring.coverage(joined, SPEC).first()
    assert (cover["n"], cover["n_zero"]) == (6, 2)


def test_undefined_metrics_are_null_and_never_win(spark):
    actual = facts(spark, days(FIRST, [0, 0], 1), days(FIRST, [2, 0], 2))
    day = [FIRST, FIRST + timedelta(days=1)]
    made = forecasts(
        spark,
        A=[(s, d, 1.0) for s in (1, 2) for d in day],
        B=[(2, day[1], 5.0)],  # only meets a zero actual: its mape is undefined
    )
    long = scoring.metrics_long(scoring.score_join(actual, made, SPEC), SPEC)
    assert value_of(long, "mape") is None and value_of(long, "mape", "B", 2) is None
    assert value_of(long, "mape", "A", 2) == 50.0
    assert [(r["model"], r["store"]) for r in scoring.best_model(long, SPEC).collect()] == [("A", 2)]
    mean = scoring.champion_mean_error(scoring.best_model(long, SPEC)).first()
    assert (mean["mean_error"], mean["n_series"]) == (50.0, 1)


def test_nan_never_wins_and_ties_go_to_the_first_name(spark):
    schema = "model string, store int, item int, metric string, value double"
    data = [("B", 1, 1, "mae", 1.0), ("A", 1, 1, "mae", 1.0), ("C", 1, 1, "rmse", 0.1), ("Z", 2, 1, "mae", float("nan")), ("Y", 2, 1, "mae", 9.0)]
    got = scoring.best_model(spark.createDataFrame(data, schema), SPEC, "mae")
    assert rows(got) == [("A", 1, 1, "mae", 1.0), ("Y", 2, 1, "mae", 9.0)]


def test_days_without_a_forecast_drop_out(spark):
    made = forecasts(spark, A=[(1, FIRST, 5.0), (1, FIRST + timedelta(days=9), 5.0)])
    joined = scoring.score_join(facts(spark, days(FIRST, [4, 4, 4])), made, SPEC)
    assert scoring.coverage(joined, SPEC).first()["n"] == 1


def test_only_the_chosen_models_forecast_stays(spark):
    made = forecasts(spark, A=[(1, FIRST, 7.3), (2, FIRST, 1.0)], B=[(1, FIRST, 8.5), (2, FIRST, 2.0)])
    best = spark.createDataFrame([("B", 1, 1, "mae", 0.6), ("A", 2, 1, "mae", 0.1)], "model string, store int, item int, metric string, value double")
    got = scoring.champion_forecast(made, best, SPEC)
    assert got.columns == made.columns
    assert rows(got) == [("A", 2, 1, FIRST, 1.0), ("B", 1, 1, FIRST, 8.5)]


def biggest_error(y, p):
    return (y - p).abs().max()


def test_python_metrics_run_on_rows_and_arrays(spark):
    long = scoring.metrics_long(two_models(spark), SPEC, [python_metric(biggest_error), "mae"])
    assert value_of(long, "biggest_error") == pytest.approx(1.8)
    vec = vectors_of(spark, days(FIRST, range(30)))
    tested = champion.backtest(vec, SPEC, [make_model("NaiveMean")], 7, 2, [python_metric(biggest_error), "mae"], "biggest_error")
    got = champion.metrics_table(tested, SPEC)
    assert value_of(got, "biggest_error", "NaiveMean") == pytest.approx(29 - 11)
    assert champion.best_models(tested, SPEC, "biggest_error").count() == 1


def test_metric_names_are_checked():
    for bad in ([], ["nonsense"], ["mae", "mae"]):
        with pytest.raises(ValueError):
            resolve(bad)


def light():
    return [
        make_model("NaiveMean"), make_model("NaiveDrift"), make_model("Croston"),
        make_model("NaiveSeasonal", {"K": 7}), make_model("ExponentialSmoothing"),
    ]


def test_one_plan_gives_the_results_of_the_single_steps(spark):
    series = [
        days(FIRST, [(i * s) % 7 + s * (i % 2) for i in range(60)], store=s) for s in range(1, 5)
    ]
    series.append(days(FIRST + timedelta(days=50), [3] * 10, store=8))  # short training part
    series.append(days(FIRST + timedelta(days=56), [3] * 4, store=9))  # starts inside the test days
    series.append(days(FIRST, [1] * 40 + [0] * 20, store=7))  # idle test days: mape undefined
    vec = vectors_of(spark, *series)
    panel = label_split(unroll(vec, SPEC, "start", "ys"), SPEC, Cutoffs(FIRST + timedelta(days=60), 400, 7))
    on_test = forecast_rows(history(vec, SPEC, "train"), SPEC, light(), 7)
    future = forecast_rows(history(vec, SPEC, "full"), SPEC, light(), 3)
    joined = scoring.score_join(only(panel, "test"), on_test, SPEC)
    metrics = scoring.metrics_long(joined, SPEC)
    best = scoring.best_model(metrics, SPEC)

    tested = champion.backtest(vec, SPEC, light(), 7, 3).cache()

    def same(one, two):
        digits = lambda df: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)
        assert digits(one) == digits(two)

    same(champion.forecast_on_test(tested, SPEC), on_test)
    same(champion.all_models_forecast(tested, SPEC), future)
    same(champion.metrics_table(tested, SPEC), metrics)
    same(champion.best_models(tested, SPEC), best)
    same(champion.best_forecast(tested, SPEC), scoring.champion_forecast(future, best, SPEC))
    assert sorted(r["store"] for r in best.collect()) == [1, 2, 3, 4, 8]
    tested.unpersist()


def test_one_plan_shuffles_only_to_build_the_series(spark):
    vec = vectors_of(spark, days(FIRST, range(40)))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for result in (champion.best_forecast, champion.metrics_table, champion.best_models):
        text = plan(result(champion.backtest(vec, SPEC, light(), 7, 3), SPEC))
        assert text.count("Exchange ") == plan(vec).count("Exchange ")
        assert text.count("ArrowEvalPython") == 1


def test_one_plan_with_tree_models(spark):
    vec = vectors_of(spark, days(FIRST, [i % 7 for i in range(60)]), days(FIRST, [5] * 60, store=2))
    models = [make_model("NaiveMean"), make_model("RandomForest", {"n_estimators": 5}), make_model("PooledXGBModel", {"n_estimators": 2})]
    tested = champion.backtest(vec, SPEC, models, 7, 3, select_on="mae")
    assert champion.metrics_table(tested, SPEC).count() == 18
    got = {r["store"]: r["model"] for r in champion.best_models(tested, SPEC, "mae").collect()}
    assert got[1] in ("RandomForest", "PooledXGBModel")
    assert champion.best_forecast(tested, SPEC).filter("sales > -100 AND model IS NOT NULL").count() == 6


def test_one_plan_refuses_an_unknown_selection(spark):
    vec = vectors_of(spark, days(FIRST, range(20)))
    with pytest.raises(ValueError):
        champion.backtest(vec, SPEC, [make_model("NaiveMean")], 7, 3, ["mae"], "mape")
