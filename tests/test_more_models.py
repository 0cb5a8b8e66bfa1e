"""Theta, ETS, Kalman, FFT, complex smoothing, ensembles and the warping metric against plain loops."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast import make_model
from panelcast.functions import ets, kalman, theta, waves
from panelcast.functions.metrics import ArrayResiduals, dtw_metric
from panelcast.operators.ensemble import ensemble_weights, nonnegative_weights
from panelcast.operators.models import chosen_forms, forecast_rows, history
from panelcast.operators.scoring import metrics_long
from tests.conftest import SPEC, days, vectors_of
from tests.test_models import FIRST, ahead


def some_series(n=80):
    rng = np.random.default_rng(21)
    t = np.arange(n)
    week = np.tile([8.0, 5, 6, 9, 4, 12, 3], n // 7 + 1)[:n]
    return np.array(
        [
            20 + week + 0.1 * t + rng.normal(0, 0.5, n),
            (10 + 0.2 * t) * week / 6 + rng.normal(0, 0.2, n),
            rng.normal(0, 3, n),
            np.where(rng.random(n) < 0.5, 0, week),
            np.full(n, 7.0),
            np.exp(1 + 0.02 * t + rng.normal(0, 0.05, n)),
        ]
    )


def line(z, ahead_steps):
    n = len(z)
    t = range(1, n + 1)
    mt, mz = (n + 1) / 2, sum(z) / n
    b = sum((i - mt) * (v - mz) for i, v in zip(t, z)) / sum((i - mt) ** 2 for i in t)
    return [mz + b * (i - mt) for i in range(1, n + ahead_steps + 1)]


# --------------------------------------------------------------------------- theta


def loop_theta(y, steps, s):
    n, m = len(y), s.season
    mean = sum(y) / n
    e = [v - mean for v in y]
    power = sum(v * v for v in e)
    seasonal = False
    if m > 1 and s.season_mode != "none" and power > 1e-12 * max(1, sum(v * v for v in y)):
        r = [sum(a * b for a, b in zip(e[k:], e)) / power for k in range(1, m + 1)]
        seasonal = r[-1] > 1.645 * math.sqrt((1 + 2 * sum(v * v for v in r[:-1])) / n)
    times, pattern = False, [0.0] * m
    for times in (seasonal and s.season_mode == "multiplicative" and min(y) > 0, False):
        if not seasonal:
            break
        groups = [[] for _ in range(m)]
        for t in range(m // 2, n - m // 2):
            trend = sum(y[t - m // 2 : t + m // 2 + 1]) / m
            groups[t % m].append(y[t] / trend if times else y[t] - trend)
        pattern = [sum(g) / len(g) for g in groups]
        middle = sum(pattern) / m
        pattern = [p / middle if times else p - middle for p in pattern]
        if not times or min(pattern) > 0:
            break
    z = [v / pattern[t % m] if times else v - pattern[t % m] for t, v in enumerate(y)]
    best = None
    for trend_mode, model_mode, q in itertools.product(s.trend_modes, s.model_modes, s.thetas):
        known = line(z, steps)
        if trend_mode == "exponential" and min(z) > 0:
            known = [math.exp(v) for v in line([math.log(v) for v in z], steps)]
        ratio = model_mode == "multiplicative" and min(z) > 0 and min(known) > 0
        away = [v**q * w ** (1 - q) if ratio else q * v + (1 - q) * w for v, w in zip(z, known)]
        tried = []
        for a in s.alphas:
            level, before, sse = away[0], [], 0.0
            for v in away:
                before.append(level)
                sse += (v - level) ** 2
                level += a * (v - level)
            tried.append((sse, before, level))
        _, before, level = min(tried, key=lambda x: x[0])

        def mixed(w, u):
            return w ** (1 - 1 / q) * u ** (1 / q) if ratio else (1 - 1 / q) * w + u / q

        error = sum(abs(v - mixed(w, u)) for v, w, u in zip(z, known, before)) / n
        if best is None or error < best[0] - 1e-12:
            best = (error, [mixed(w, level) for w in known[n:]])
    return [v * pattern[(n + k) % m] if times else v + pattern[(n + k) % m] for k, v in enumerate(best[1])]


@pytest.mark.parametrize(
    "settings",
    [
        theta.ThetaSettings(),
        theta.ThetaSettings(season_mode="additive", thetas=(1.5,)),
        theta.ThetaSettings(season_mode="none", trend_modes=("exponential",), model_modes=("multiplicative",)),
        theta.ThetaSettings((1.0, 2.0, 3.0), trend_modes=("linear", "exponential"), model_modes=("additive", "multiplicative")),
    ],
)
def test_theta_equals_a_plain_loop(settings):
    y = some_series()
    got, names = theta.forecast_block(y, 9, settings)
    assert len(names) == len(y) and all(names)
    for row, one in zip(got, y):
        assert row == pytest.approx(loop_theta(list(one), 9, settings), rel=1e-7)


def test_theta_finds_seasons_only_where_they_are():
    y = some_series()
    assert theta.has_season(y, 7).tolist()[:3] == [True, True, False] and not theta.has_season(y, 7)[4]
    even = np.tile([1.0, 2, 3, 6], 20)[None] + np.arange(80) / 50
    pattern = theta.pattern_of(even, 4, np.array([False]))[0]
    assert pattern == pytest.approx(np.array([1.0, 2, 3, 6]) - 3 + np.array([-1.5, -0.5, 0.5, 1.5]) * 0, abs=0.05)


# ----------------------------------------------------------------------------- ETS


def loop_ets(y, m, form, w):
    """(score, forecasts function) of one form with weights w."""
    error, trend, season = form
    a, b, g, phi = w
    half = m if season != "N" else 5
    one, two = sum(y[:half]) / half, sum(y[half : 2 * half]) / half
    level, growth = one, (two - one) / half if trend != "N" else 0.0
    pattern = [v / one if season == "M" else v - one if season == "A" else 0.0 for v in y[:m]]
    sse = relative = logs = 0.0
    low = math.inf
    for t, v in enumerate(y):
        s = pattern[t % m]
        base = level + phi * growth
        fit = base * s if season == "M" else base + s
        e = v - fit
        low = min(low, fit)
        sse += e * e
        relative += (e / fit) ** 2
        logs += math.log(abs(fit))
        level = base + a * (e / s if season == "M" else e)
        growth = phi * growth + b * (e / s if season == "M" else e)
        if season != "N":
            pattern[t % m] = s + g * (e / base if season == "M" else e)
    n = len(y)
    k = 3 + 2 * (trend != "N") + (trend == "Ad") + m * (season != "N")
    score = n * math.log(sse / n) if error == "A" else n * math.log(relative / n) + 2 * logs
    score += 2 * k + 2 * k * (k + 1) / (n - k - 1)
    if (error == "M" or season == "M") and (min(y) <= 0 or low <= 0):
        score = math.inf

    def forecast(steps):
        out, total = [], 0.0
        for h in range(1, steps + 1):
            total += phi**h
            base = level + total * growth
            out.append(base * pattern[(n + h - 1) % m] if season == "M" else base + pattern[(n + h - 1) % m])
        return out

    return score, forecast


def test_ets_equals_a_plain_loop_over_all_forms():
    y = some_series()[[0, 1, 5]]
    settings = ets.EtsSettings(refine=False)
    got, names = ets.forecast_block(y, 9, settings)
    for row, name, one in zip(got, names, y):
        best = None
        for form in settings.wanted:
            for w in settings.grid(*form[1:]).T:
                score, forecast = loop_ets(list(one), 7, form, w)
                if best is None or score < best[0] - 1e-9:
                    best = (score, form, forecast)
        assert name == "ETS({},{},{})".format(*best[1])
        assert row == pytest.approx(best[2](9), rel=1e-6)


def test_ets_keeps_to_fixed_forms_and_refines():
    y = some_series()
    for form in ("ANN", "AAdA", "AAA"):
        got, names = ets.forecast_block(y[:3], 4, ets.EtsSettings(forms=(form,), weights=(0.3, 0.1, 0.2, 0.9)))
        assert set(names) == {"ETS({},{},{})".format(form[0], form[1:-1], form[-1])}
        for row, one in zip(got, y):
            weights = (0.3, 0.1 if form[1] != "N" else 0.0, 0.2 if form[-1] != "N" else 0.0, 0.9 if "d" in form else 1.0)
            assert row == pytest.approx(loop_ets(list(one), 7, (form[0], form[1:-1], form[-1]), weights)[1](4))
    got, names = ets.forecast_block(y, 5, ets.EtsSettings())
    assert np.isfinite(got).all() and got[4] == pytest.approx([7.0] * 5)
    assert all(n[4] == "A" and n[-2] != "M" for n in (names[2], names[3]))  # values of 0 and below
    for bad in ({"forms": ["AAM"]}, {"forms": ["x"]}, {"seasonal_periods": 1, "forms": ["AAA"]}, {"weights": (1, 2, 0, 0)}, {"seasonal_periods": -1}):
        with pytest.raises(ValueError):
            make_model("AutoETS", bad)


# -------------------------------------------------------------------------- Kalman


def loop_local_level(y, seen, r, q, rounds):
    """Filter, smoother and expectation maximisation of one series, number by number."""

    def forward():
        x, p, rows = 0.0, kalman.DIFFUSE, []
        for t, (v, known) in enumerate(zip(y, seen)):
            if t:
                p += q
            before = (x, p)
            if known:
                gain = p / (p + r)
                x, p = x + gain * (v - x), p - gain * p
            rows.append((*before, x, p))
        return rows

    for _ in range(rounds):
        rows = forward()
        s, c = [rows[-1][2]], [rows[-1][3]]
        cross = []
        for t in range(len(y) - 2, -1, -1):
            back = rows[t][3] / rows[t + 1][1]
            cross.insert(0, c[0] * back)
            s.insert(0, rows[t][2] + back * (s[0] - rows[t + 1][0]))
            c.insert(0, rows[t][3] + back * back * (c[0] - rows[t + 1][1]))
        r = max(sum(((v - a) ** 2 + b) for v, a, b, k in zip(y, s, c, seen) if k) / sum(seen), 1e-9)
        q = max(sum((s[t + 1] - s[t]) ** 2 + c[t + 1] + c[t] - 2 * cross[t] for t in range(len(y) - 1)) / (len(y) - 1), 1e-9)
    return r, q, forward()[-1][2]


@pytest.mark.parametrize("missing", [False, True])
def test_local_level_and_its_noise_equal_a_plain_loop(missing):
    y = some_series()[[0, 2, 3]]
    s = kalman.KalmanSettings(rounds=5, zeros_missing=missing)
    got = kalman.forecast_block(y, 3, s)
    for row, one in zip(got, y):
        seen = [not (missing and v == 0) for v in one]
        held = [v for v, k in zip(one, seen) if k]
        mean, size = np.mean(held), np.std(held)
        *_, level = loop_local_level([(v - mean) / size for v in one], seen, 0.5, 0.1, 5)
        assert row == pytest.approx([mean + size * level] * 3, rel=1e-6)


def test_kalman_follows_lines_over_holes_and_likelihood_grows():
    t = np.arange(60.0)
    y = (5 + 2 * t)[None].copy()
    y[0, 20:30] = np.nan
    assert kalman.forecast_block(y, 3, kalman.KalmanSettings(trend=True, rounds=20))[0] == pytest.approx([125, 127, 129], abs=0.5)
    assert kalman.forecast_block(np.full((1, 9), 4.0), 2, kalman.KalmanSettings())[0] == pytest.approx([4, 4])
    with pytest.raises(ValueError):
        make_model("KalmanForecaster", {"noise": (1.0,)})


# ------------------------------------------------------------- waves, complex smoothing


def test_planted_frequencies_are_found_and_carried_on():
    t = np.arange(140 + 20)
    whole = 30 + 0.2 * t + 5 * np.sin(2 * np.pi * 10 * t / 140 + 0.3) + 2 * np.cos(2 * np.pi * 35 * t / 140)
    noisy = whole[:140] + np.random.default_rng(2).normal(0, 0.05, 140)
    got = waves.strongest_waves(noisy[None], 20, waves.WaveSettings(keep=2, degree=1))[0]
    assert got == pytest.approx(whole[140:], abs=0.7)
    assert waves.strongest_waves(noisy[None], 160, waves.WaveSettings(keep=200, degree=-1))[0] == pytest.approx(np.r_[noisy, noisy[:20]])
    for n in (9, 10):
        y = np.random.default_rng(n).normal(size=n)
        assert waves.strongest_waves(y[None], 3, waves.WaveSettings(keep=9, degree=0))[0] == pytest.approx(y[:3])


def test_complex_smoothing_equals_its_two_real_recursions():
    y = some_series()
    for a0, a1 in ((0.4, 0.98), (1.2, 1.005)):
        got = waves.complex_smoothing(y, 6, waves.ComplexSettings((a0, a1)))
        for row, one in zip(got, y):
            level, potential = one[0], one[0] / 2
            for v in one:
                e = v - level
                level, potential = level - (1 - a1) * potential + (a0 - a1) * e, level + (1 - a0) * potential + (a0 + a1) * e
            out = []
            for _ in range(6):
                out.append(level)
                level, potential = level - (1 - a1) * potential, level + (1 - a0) * potential
            assert row == pytest.approx(out)
    s = waves.ComplexSettings()
    searched = waves.complex_smoothing(y, 3, s)
    assert np.isfinite(searched).all() and searched[4] == pytest.approx([7.0] * 3, abs=0.5)
    assert waves.stable(1.3, 1.0) and not waves.stable(0.5, 1.0)
    with pytest.raises(ValueError):
        waves.ComplexSettings(real=(3.0,))


# ------------------------------------------------------------------------ ensemble


def test_weights_are_the_best_without_negative_ones():
    rng = np.random.default_rng(4)
    for members in (2, 3, 4):
        x = rng.normal(1, 1, (30, members, 40))
        y = np.einsum("sm,smt->st", rng.normal(0.2, 0.5, (30, members)), x) + rng.normal(0, 0.3, (30, 40))
        gram, cross, power = x @ x.transpose(0, 2, 1), (x @ y[..., None])[..., 0], (y * y).sum(axis=1)
        got = nonnegative_weights(gram, cross, power)
        w = np.full((30, members), 0.2)
        for _ in range(20_000):
            for j in range(members):
                w[:, j] = np.maximum(0, w[:, j] - (np.einsum("sk,sk->s", gram[:, j], w) - cross[:, j]) / gram[:, j, j])
            if np.abs(np.where(w > 0, (gram @ w[..., None])[..., 0] - cross, 0)).max() < 1e-8:
                break
        useful = w.sum(axis=1) > 0
        assert got[useful] == pytest.approx(w[useful], abs=1e-5) and (got >= 0).all()
        assert np.allclose(got[~useful], 1 / members)


def test_ensemble_mixes_its_members_and_tells_the_weights(spark):
    week = [1.0, 5, 2, 8, 3, 9, 4]
    model = make_model("RegressionEnsembleModel", {"forecasting_models": [("NaiveSeasonal", {"K": 7}), "NaiveMean"], "origins": 2, "horizon": 14})
    got = ahead(spark, model, week * 12, list(np.random.default_rng(1).normal(50, 1, 84)), week * 4, steps=14)
    assert set(got) == {1, 2}
    assert got[1] == pytest.approx(week * 2, abs=1e-6) and got[2] == pytest.approx([50] * 14, abs=2)
    vec = history(vectors_of(spark, days(FIRST, week * 12)), SPEC, "full")
    weights = {r.member: r.weight for r in ensemble_weights(vec, SPEC, model).collect()}
    assert weights["NaiveSeasonal"] == pytest.approx(1) and weights["NaiveMean"] == pytest.approx(0, abs=1e-9)
    out = model.attach(vec, SPEC, "ys", "start", 3, "f")
    assert out.columns == [*vec.columns, "f"]
    for bad in ({"forecasting_models": ["NaiveMean"]}, {"forecasting_models": ["NaiveMean", "NaiveMean"]}, {"forecasting_models": ["NaiveMean", "PooledXGBModel"]}):
        with pytest.raises(ValueError):
            make_model("RegressionEnsembleModel", bad)


# -------------------------------------------------------------------------- metric


def loop_warp(y, p):
    table = {(0, 0): (0.0, 0)}
    for i, a in enumerate(y, 1):
        for j, b in enumerate(p, 1):
            cost, steps = min(table[k] for k in ((i - 1, j), (i, j - 1), (i - 1, j - 1)) if k in table)
            table[i, j] = (cost + abs(a - b), steps + 1)
    cost, steps = table[len(y), len(p)]
    return cost / steps


def test_warped_error_equals_a_plain_table(spark):
    rng = np.random.default_rng(6)
    pairs = [(rng.integers(0, 6, n).astype(float).tolist(), rng.integers(0, 6, n).astype(float).tolist()) for n in (1, 2, 5, 12, 21)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, y array<double>, p array<double>")
    got = {r.i: r.m for r in df.select("i", dtw_metric(ArrayResiduals(F.col("y"), F.col("p"))).alias("m")).collect()}
    assert got == pytest.approx({i: loop_warp(*p) for i, p in enumerate(pairs)})
    long = [("a", 1, i, FIRST.fromordinal(FIRST.toordinal() + t), y, p) for i, pair in enumerate(pairs) for t, (y, p) in enumerate(zip(*pair))]
    rows = spark.createDataFrame(long[::-1], "model string, store int, item int, date date, sales double, prediction double")
    table = {r.item: r.value for r in metrics_long(rows, SPEC, ["dtw_metric"]).collect()}
    assert table == pytest.approx(got)
    empty = spark.sql("SELECT CAST(array() AS array<double>) AS y, array(cast(null as double)) AS p")
    assert empty.select(dtw_metric(ArrayResiduals(F.col("y"), F.col("p")))).first()[0] is None


def test_forms_are_named(spark):
    vec = history(vectors_of(spark, *[days(FIRST, list(y), store=i) for i, y in enumerate(some_series()[:3])], days(FIRST.fromordinal(FIRST.toordinal() + 75), [1.0] * 5, store=9)), SPEC, "full")
    for model in ("AutoETS", "Theta", "FourTheta"):
        got = {r.store: r.form for r in chosen_forms(vec, SPEC, model).collect()}
        assert got[9] is None and all(got[i] for i in range(3))
    assert forecast_rows(vec, SPEC, [make_model("AutoETS")], 2).count() == 6
    with pytest.raises(ValueError):
        chosen_forms(vec, SPEC, "NaiveMean")
