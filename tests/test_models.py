import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast import make_model, model_names
from panelcast.functions import arima, regression
from panelcast.functions.baselines import moving_average_weights
from panelcast.operators.models import Plugin, forecast_rows, history, plugin_report
from tests.conftest import SPEC, days, rows, vectors_of

FIRST = date(2022, 1, 3)
ARRAY_NAMES = [n for n in model_names() if not n.startswith("Pooled") and n != "RegressionEnsembleModel"]
PARAMS = {"NaiveSeasonal": {"K": 7}, "NaiveMovingAverage": {"input_chunk_length": 7}}


def ahead(spark, model, *values, steps=21, which="full"):
    """Forecast values per series, for series of equal end."""
    longest = max(map(len, values))
    series = [days(FIRST + timedelta(days=longest - len(v)), v, store=s) for s, v in enumerate(values, 1)]
    df = forecast_rows(history(vectors_of(spark, *series), SPEC, which), SPEC, [model], steps)
    got = {}
    for r in df.orderBy("store", "date").collect():
        got.setdefault(r["store"], []).append(r["sales"])
    return got


def noise(n, seed=0, scale=1.0):
    return np.random.default_rng(seed).normal(0, scale, n)


# ---------------------------------------------------------------- shape and dates


def test_every_array_model_yields_the_right_days_and_finite_values(spark):
    values = [2450 + 20 * (i % 7) + 3 * i + 5 * math.sin(i * i) for i in range(35)]
    models = [make_model(n, PARAMS.get(n)) for n in ARRAY_NAMES]
    vec = vectors_of(spark, days(date(2022, 8, 8), values), days(date(2022, 8, 8), values[::-1], item=2))
    on_test = forecast_rows(history(vec, SPEC, "train"), SPEC, models, 7)
    future = forecast_rows(history(vec, SPEC, "full"), SPEC, models, 2)
    assert on_test.columns == ["model", "store", "item", "date", "sales"]
    for df, first, n in ((on_test, date(2022, 9, 5), 7), (future, date(2022, 9, 12), 2)):
        got = {}
        for r in df.collect():
            assert math.isfinite(r["sales"])
            got.setdefault((r["model"], r["item"]), []).append(r["date"])
        assert len(got) == 2 * len(models)
        assert all(sorted(d) == [first + timedelta(days=i) for i in range(n)] for d in got.values())


def test_series_too_short_for_a_model_have_no_rows(spark):
    vec = vectors_of(spark, days(FIRST, range(1, 31)), days(FIRST + timedelta(days=27), [5, 6, 7], store=2))
    models = [make_model("NaiveMean"), make_model("ExponentialSmoothing"), make_model("NaiveSeasonal", {"K": 7})]
    got = forecast_rows(history(vec, SPEC, "full"), SPEC, models, 2).groupBy("store", "model").count()
    assert rows(got) == [(1, "ExponentialSmoothing", 2), (1, "NaiveMean", 2), (1, "NaiveSeasonal", 2), (2, "NaiveMean", 2)]
    assert forecast_rows(history(vec, SPEC, "train"), SPEC, models, 2).filter("store = 2").count() == 0


@pytest.mark.parametrize("name", ARRAY_NAMES)
def test_test_days_do_not_leak_into_forecasts_on_them(spark, name):
    values = [10 + (i % 7) + math.cos(i) for i in range(60)]
    other = values[:-7] + [1000.0] * 7
    model = make_model(name, PARAMS.get(name))
    got = ahead(spark, model, values, other, which="train", steps=7)
    assert got[1] == pytest.approx(got[2], rel=1e-9)


def test_weekly_steps_move_the_forecast_days(spark):
    from panelcast.spec import PanelSpec

    spec = PanelSpec(SPEC.keys, SPEC.time, SPEC.value, step_days=7)
    hist = spark.createDataFrame([(1, 1, FIRST, [1.0, 2.0, 3.0])], "store int, item int, start date, ys array<double>")
    got = forecast_rows(hist, spec, [make_model("NaiveDrift"), make_model("Prophet", {"yearly": False})], 2)
    assert {(r["date"], round(r["sales"], 3)) for r in got.filter("model = 'NaiveDrift'").collect()} == {
        (FIRST + timedelta(days=21), 4.0), (FIRST + timedelta(days=28), 5.0),
    }
    assert got.filter("model = 'Prophet'").count() == 2


# ------------------------------------------------------------ recovery of generators


def test_constant_series_stay_constant(spark):
    for name in ARRAY_NAMES:
        got = ahead(spark, make_model(name, PARAMS.get(name)), [5.0] * 60, steps=3)[1]
        expected = 5.0 * 0.95 if name == "Croston" and PARAMS.get(name, {}).get("version") == "sba" else 5.0
        assert got == pytest.approx([expected] * 3, abs=1e-3), name


def test_straight_lines_are_carried_on(spark):
    line = [3 + 2 * i for i in range(80)]
    for model in (make_model("NaiveDrift"), make_model("Prophet", {"yearly": False}), make_model("ExponentialSmoothing"), make_model("AutoARIMA")):
        assert ahead(spark, model, line, steps=4)[1] == pytest.approx([163, 165, 167, 169], rel=0.01), model.model_id


def test_weekly_patterns_are_carried_on(spark):
    week = [1, 5, 2, 8, 3, 9, 4]
    for name in ("NaiveSeasonal", "ExponentialSmoothing", "Prophet", "LinearRegressionModel"):
        got = ahead(spark, make_model(name, PARAMS.get(name)), week * 12, steps=14)[1]
        assert got == pytest.approx(week * 2, abs=0.15), name


def test_arima_finds_an_autoregression(spark):
    y = [0.0]
    for e in noise(800, 11):
        y.append(0.5 * y[-1] + e)
    y = [50 + v for v in y]
    got = ahead(spark, make_model("AutoARIMA"), y[-390:], steps=3)[1]
    expected = [50 + 0.5**k * (y[-1] - 50) for k in (1, 2, 3)]
    assert got == pytest.approx(expected, abs=0.4)


def test_arima_difference_test():
    wrong = arima.needs_difference(np.array([noise(500, seed) for seed in range(100)])).sum()
    assert wrong <= 12  # a test at 5 percent
    found = arima.needs_difference(np.array([np.cumsum(noise(500, seed)) for seed in range(100)])).sum()
    assert found >= 80
    assert not arima.needs_difference(np.full(30, 4.0)).any()


def test_fixed_order_matches_direct_least_squares():
    y = np.cumsum(noise(120, 5)) + 20
    got = arima.forecast_block(y[None], 3, arima.ArimaSettings(order=(2, 1, 0)))[0][0]
    w = np.diff(y)
    x = np.column_stack([np.ones(len(w) - 2), w[1:-1], w[:-2]])
    c, a, b = np.linalg.lstsq(x, w[2:], rcond=None)[0]
    path = list(w)
    for _ in range(3):
        path.append(c + a * path[-1] + b * path[-2])
    assert got == pytest.approx(y[-1] + np.cumsum(path[-3:]))


def test_moving_average_part_matches_two_stage_least_squares():
    e = noise(600, 9)
    y = 10 + e[1:] + 0.6 * e[:-1]
    got = arima.forecast_block(y[None], 2, arima.ArimaSettings(order=(0, 0, 1)))[0][0]
    w, centre = y - y.mean(), y.mean()
    lags = int(np.ceil(np.log(len(w)) * 2)) + 1
    z = np.column_stack([np.ones(len(w) - lags), *[w[lags - j : len(w) - j] for j in range(1, lags + 1)]])
    shock = np.zeros(len(w))
    shock[lags:] = w[lags:] - z @ np.linalg.lstsq(z, w[lags:], rcond=None)[0]
    x = np.column_stack([np.ones(len(w) - lags - 1), shock[lags:-1]])
    c, theta = np.linalg.lstsq(x, w[lags + 1 :], rcond=None)[0]
    assert theta == pytest.approx(0.6, abs=0.1)
    assert got == pytest.approx([centre + c + theta * shock[-1], centre + c])


def test_ridge_matches_an_explicit_solve():
    model = regression.Decomposition(yearly=False, n_changepoints=3)
    n, steps, start = 50, 5, 19000
    y = 5 + 0.3 * np.arange(n) + 2 * np.sin(np.arange(n)) + noise(n, 2)
    got = model.forecast(start, [y, 3 * y], steps, 1)
    t = start + np.arange(n + steps)
    u = (t - start) / (n - 1)
    bends = np.linspace(0, 0.8, 4)[1:]
    x = np.column_stack(
        [np.ones(n + steps), u, *[np.maximum(u - c, 0) for c in bends]]
        + [f(2 * np.pi * k * t / 7) for k in (1, 2, 3) for f in (np.sin, np.cos)]
    )
    penalty = np.array([0, 0] + [(0.1 / 0.05) ** 2] * 3 + [(0.1 / 10) ** 2] * 6)
    scaled = y / np.abs(y).max()
    beta = np.linalg.solve(x[:n].T @ x[:n] + np.diag(penalty), x[:n].T @ scaled)
    assert got[0] == pytest.approx(x[n:] @ beta * np.abs(y).max())
    assert got[1] == pytest.approx(3 * got[0])


def test_holidays_get_an_effect_of_their_own(spark):
    feast = [FIRST + timedelta(days=i) for i in (20, 51, 77, 91)]
    values = [10.0 + 40.0 * (FIRST + timedelta(days=i) in feast) for i in range(90)]
    model = make_model("Prophet", {"yearly": False, "holidays": [(d, "feast") for d in feast]})
    got = ahead(spark, model, values, steps=3)[1]
    assert got[1] == pytest.approx(50, abs=1.5) and got[0] == pytest.approx(10, abs=1.5)


def test_croston_matches_a_plain_loop(spark):
    rng = random.Random(4)
    series = [[float(rng.randrange(1, 9)) if rng.random() < p else 0.0 for _ in range(50)] for p in (0.2, 0.6)]
    series += [[0.0] * 50, [0, 0, 3] * 16 + [0, 0]]

    def loop(y, version, ad=0.1, ap=0.3):
        size = gap = None
        since, chance = 0, float(y[0] != 0)
        for i, v in enumerate(y):
            since += 1
            if i:
                chance += ap * ((v != 0) - chance)
            if v:
                size = v if size is None else size + ad * (v - size)
                gap = since if gap is None else gap + ap * (since - gap)
                since = 0
        if size is None:
            return 0.0
        return {"classic": size / gap, "sba": (1 - ap / 2) * size / gap, "tsb": size * chance}[version]

    for version in ("classic", "sba", "tsb"):
        got = ahead(spark, make_model("Croston", {"version": version, "alpha_p": 0.3}), *series, steps=2)
        for s, y in enumerate(series, 1):
            assert got[s] == pytest.approx([loop(y, version)] * 2), (version, s)


def test_optimized_croston_searches_its_weights(spark):
    y = [0, 4, 0, 0, 6, 5, 0, 9, 0, 12, 15, 0, 0, 0, 14, 20]

    def best(values):
        runs = []
        for i in range(21):
            level, sse = values[0], 0.0
            for v in values[1:]:
                sse += (v - level) ** 2
                level += (0.10 + 0.01 * i) * (v - level)
            runs.append((sse, level))
        return min(runs)[1]

    got = ahead(spark, make_model("Croston", {"version": "optimized"}), y, [0.0] * 16, steps=1)
    assert got[1] == pytest.approx([best([4, 6, 5, 9, 12, 15, 14, 20]) / best([2, 3, 1, 2, 2, 1, 4, 1])])
    assert got[2] == [0.0]


def test_moving_average_weights_equal_the_recursion():
    y = [3.0, 1.0, 4.0]
    path = list(y)
    for _ in range(9):
        path.append(sum(path[-3:]) / 3)
    assert [sum(a * b for a, b in zip(w, y)) for w in moving_average_weights(3, 9)] == pytest.approx(path[3:])


def test_smoothing_matches_a_plain_loop_for_mixed_lengths(spark):
    m, (a, b, g) = 7, (0.4, 0.1, 0.3)
    series = [[10 + (i % 7) + 0.1 * i + math.sin(3 * i) for i in range(n)] for n in (14, 55, 30, 55)]

    def loop(y):
        level = sum(y[:m]) / m
        trend = (sum(y[m : 2 * m]) / m - level) / m
        season = [v - level for v in y[:m]]
        for t in range(m, len(y)):
            old = level
            level = a * (y[t] - season[t % m]) + (1 - a) * (level + trend)
            trend = b * (level - old) + (1 - b) * trend
            season[t % m] = g * (y[t] - level) + (1 - g) * season[t % m]
        return [level + trend * k + season[(len(y) + k - 1) % m] for k in range(1, 10)]

    got = ahead(spark, make_model("ExponentialSmoothing", {"params": (a, b, g)}), *series, steps=9)
    assert {s: pytest.approx(loop(y)) for s, y in enumerate(series, 1)} == got


# --------------------------------------------------------------------------- trees


@pytest.mark.parametrize("name", ["XGBModel", "RandomForest", "PooledXGBModel", "PooledRandomForest"])
def test_tree_models_learn_the_pattern_and_beat_the_mean(spark, name):
    week = [1.0, 9.0, 2.0, 8.0, 3.0, 7.0, 40.0]
    model = make_model(name, {"lags": 7, "n_estimators": 30, "max_depth": 5})
    got = ahead(spark, model, week * 12, [10 * v for v in week * 12], [5.0] * 4, steps=14)
    assert set(got) == {1, 2}  # the third series is too short
    assert all(len(v) == 14 and all(map(math.isfinite, v)) for v in got.values())
    mean = sum(week) / 7
    error = sum(abs(p - y) for p, y in zip(got[1], week * 2))
    assert error < 0.5 * sum(abs(mean - y) for y in week * 2)
    if name != "RandomForest":  # its draws differ by series
        assert got[2] == pytest.approx([10 * v for v in got[1]], rel=1e-6)


@pytest.mark.parametrize("name", ["XGBModel", "PooledXGBModel"])
def test_tree_models_do_not_see_test_days_and_cope_without_data(spark, name):
    values = [10 + (i % 7) for i in range(60)]
    model = make_model(name, {"n_estimators": 2, "max_depth": 3})
    one = ahead(spark, model, values, which="train", steps=7)
    two = ahead(spark, model, values[:-7] + [999] * 7, which="train", steps=7)
    assert one[1] == pytest.approx(two[1])
    assert ahead(spark, model, [1.0, 2.0, 3.0]) == {}


# ------------------------------------------------------------------------ plug-ins


class LastValue:
    def __init__(self, factor=1.0):
        self.factor = factor

    def fit(self, series):
        assert series.index.freq is not None and series.dtype == float
        if series.iloc[-1] < 0:
            raise ValueError("negative end")
        self.last = series.iloc[-1] * self.factor
        return self

    def predict(self, n):
        return np.repeat(self.last, n)


class WrongLength(LastValue):
    def predict(self, n):
        return [self.last]


def test_plugin_runs_per_series(spark):
    got = ahead(spark, make_model(LastValue, {"factor": 2.0}), [1, 2, 3], [4, 5, 6], steps=2)
    assert got == {1: [6.0, 6.0], 2: [12.0, 12.0]}
    assert make_model(LastValue).model_id == "LastValue" and make_model(LastValue, model_id="x").model_id == "x"


def test_plugin_errors_end_the_job_or_become_rows(spark):
    vec = history(vectors_of(spark, days(FIRST, [1, 2]), days(FIRST, [1, -2], store=2)), SPEC, "full")
    with pytest.raises(Exception, match="negative end"):
        forecast_rows(vec, SPEC, [make_model(LastValue)], 2).collect()
    report = {r["store"]: r for r in plugin_report(vec, SPEC, Plugin("p", LastValue, on_error="report"), 2).collect()}
    assert report[1]["forecast"] == [2.0, 2.0] and report[1]["error"] is None
    assert report[2]["forecast"] is None and report[2]["error"] == "ValueError: negative end"
    assert forecast_rows(vec, SPEC, [Plugin("p", LastValue, on_error="report")], 2).count() == 2
    wrong = plugin_report(vec, SPEC, Plugin("p", WrongLength, on_error="report"), 2).filter("store = 1").first()
    assert "returned shape" in wrong["error"]
    short = plugin_report(vec, SPEC, Plugin("p", LastValue, min_length=3, on_error="report"), 2)
    assert short.filter("error = 'needs 3 values'").count() == 2


# ------------------------------------------------------------------------ registry


@pytest.mark.parametrize(
    "name,params",
    [
        ("Nonsense", {}),
        ("NaiveMean", {"surprise": 1}),
        ("Croston", {"version": "other"}),
        ("NaiveMovingAverage", {"input_chunk_length": 0}),
        ("Prophet", {"country_holidays": "CL"}),
        ("Prophet", {"growth": "logistic"}),
        ("PooledXGBModel", {"lambda": 1}),
        ("XGBModel", {"lambda": -1}),
        ("XGBModel", {"objective": "reg:gamma"}),
        ("RandomForest", {"surprise": 1}),
        ("RandomForest", {"lags": 0}),
    ],
)
def test_wrong_models_and_settings_are_refused(name, params):
    with pytest.raises(ValueError):
        make_model(name, params)


def test_known_settings_are_accepted_and_ids_must_differ(spark):
    make_model("AutoARIMA", {"maxiter": 10})
    make_model("XGBModel", {"objective": "reg:squarederror", "lags": 7, "nthread": 1, "max_depth": 6, "learning_rate": 0.3, "gamma": 0, "alpha": 0})
    forest = make_model("PooledRandomForest", {"lags": 7, "n_jobs": 1, "n_estimators": 100, "max_depth": 6})
    assert forest.make_estimator().getNumTrees() == 100 and forest.min_length == 8
    vec = history(vectors_of(spark, days(FIRST, [1, 2, 3])), SPEC, "full")
    with pytest.raises(ValueError):
        forecast_rows(vec, SPEC, [make_model("NaiveMean"), make_model("NaiveMean")], 2)
    both = forecast_rows(vec, SPEC, [make_model("NaiveMean"), make_model("NaiveMean", model_id="again")], 2)
    assert both.select("model").distinct().count() == 2
    with pytest.raises(ValueError):
        forecast_rows(vec, SPEC, [make_model("NaiveMean")], 0)


def test_array_models_add_no_shuffle(spark):
    vec = vectors_of(spark, days(FIRST, range(40)))
    models = [make_model(n, PARAMS.get(n)) for n in ARRAY_NAMES]
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    out = forecast_rows(history(vec, SPEC, "full"), SPEC, models, 3)
    assert plan(out).count("Exchange ") == plan(vec).count("Exchange ")
    assert plan(out).count("ArrowEvalPython") == 1
    assert out.select(F.count("sales")).first()[0] == 3 * len(models)
