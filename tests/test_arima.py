"""Stacked seasonal ARIMA against roots, direct solves and known generators."""

import numpy as np
import pytest

from panelcast import make_model
from panelcast.functions.arima import ArimaSettings, Regression, estimated_shocks, forecast_block, long_order, needs_difference, seasonal_strength, settles


def noise(n, seed=0):
    return np.random.default_rng(seed).normal(size=n)


def test_step_down_agrees_with_the_roots():
    rng = np.random.default_rng(1)
    for p in (1, 2, 3, 5):
        ar = rng.normal(0, 0.8, (300, p))
        roots = np.array([np.abs(np.roots([1.0, *-a])).max() for a in ar])
        clear = np.abs(roots - 1) > 1e-6
        assert (settles(ar)[clear] == (roots < 1)[clear]).all()
    assert settles(np.zeros((4, 0))).all()


def test_a_series_does_not_depend_on_its_stack():
    y = np.array([np.cumsum(noise(150, 1)), noise(150, 2) + 5, np.tile([1.0, 5, 2, 8, 3], 30) + noise(150, 3) / 5, np.full(150, 2.0), 1e7 + noise(150, 4)])
    for settings in (ArimaSettings(), ArimaSettings(m=5), ArimaSettings(order=(2, 1, 1), seasonal_order=(1, 0, 1), m=5), ArimaSettings(max_d=2)):
        ahead, orders = forecast_block(y, 6, settings)
        for i in range(len(y)):
            one, order = forecast_block(y[i : i + 1], 6, settings)
            assert (order[0] == orders[i]).all() and one[0] == pytest.approx(ahead[i], rel=1e-6, abs=1e-6)
    assert np.allclose(ahead[3], 2.0)


@pytest.mark.parametrize("p, q", [(0, 0), (1, 0), (3, 0), (0, 2), (2, 1)])
def test_plain_orders_match_a_direct_solve(p, q):
    y = np.array([noise(200, 7), np.convolve(noise(202, 8), [1, 0.5, 0.3], "valid")])
    s = ArimaSettings(order=(p, 0, q))
    shocks = estimated_shocks(y, long_order(200, s))
    regression = Regression(y, shocks, s)
    whole, variance, _ = regression.solve(p, q, 0, 0)
    first = 200 - regression.rows
    for i in range(2):
        x = np.column_stack([np.ones(regression.rows), *(y[i, first - k : 200 - k] for k in range(1, p + 1)), *(shocks[i, first - k : 200 - k] for k in range(1, q + 1))])
        beta, *_ = np.linalg.lstsq(x, y[i, first:], rcond=None)
        assert whole[i] == pytest.approx(beta, abs=1e-8)
        assert variance[i] == pytest.approx(((y[i, first:] - x @ beta) ** 2).mean())


def test_products_of_polynomials_are_found_and_cannot_be_bettered():
    n, m, phi, season = 3000, 7, 0.5, 0.4
    e, w = noise(n, 5), np.zeros(n)
    for t in range(m + 1, n):
        w[t] = phi * w[t - 1] + season * w[t - m] - phi * season * w[t - m - 1] + e[t]
    s = ArimaSettings(order=(1, 0, 0), seasonal_order=(1, 0, 0), m=m)
    regression = Regression(w[None], np.zeros((1, n)), s)
    whole, variance, _ = regression.solve(1, 0, 1, 0)
    found = dict(zip(regression.ar_lags, whole[0, 1:]))
    assert found[1] == pytest.approx(phi, abs=0.06) and found[m] == pytest.approx(season, abs=0.06)
    assert found[m + 1] == pytest.approx(-found[1] * found[m])

    def spread(c, a, b):
        r = w[m + 1 :] - c - a * w[m:-1] - b * w[1:-m] + a * b * w[: -m - 1]
        return (r * r).mean()

    assert variance[0] == pytest.approx(spread(whole[0, 0], found[1], found[m]))
    for dc, da, db in [(0.01, 0, 0), (0, 0.01, 0), (0, 0, 0.01), (0, -0.01, 0.01), (-0.01, 0, -0.01)]:
        assert spread(whole[0, 0] + dc, found[1] + da, found[m] + db) > variance[0]


def test_moving_average_products_have_a_plus():
    s = ArimaSettings(order=(0, 0, 1), seasonal_order=(0, 0, 1), m=4)
    e = noise(2000, 6)
    w = e[5:] + 0.5 * e[4:-1] + 0.4 * e[1:-4] + 0.2 * e[:-5]
    shocks = estimated_shocks(w[None], long_order(len(w), s))
    regression = Regression(w[None], shocks, s)
    whole, _, _ = regression.solve(0, 1, 0, 1)
    found = dict(zip(regression.ma_lags, whole[0, 1:]))
    assert found[1] == pytest.approx(0.5, abs=0.08) and found[4] == pytest.approx(0.4, abs=0.08)
    assert found[5] == pytest.approx(found[1] * found[4])


def test_seasons_are_differenced_where_they_are_strong():
    week = np.tile([1.0, 5, 2, 8, 3, 9, 4], 20)
    y = np.array([week + noise(140, 1) / 4, noise(140, 2), np.full(140, 3.0), week * 0 + np.arange(140)])
    strength = seasonal_strength(y, 7)
    assert strength[0] > 0.95 and (strength[1:] < 0.3).all()
    ahead, orders = forecast_block(y, 14, ArimaSettings(m=7))
    assert orders[:, 4].tolist() == [1, 0, 0, 0]
    assert ahead[0] == pytest.approx(np.tile(week[:7], 2), abs=0.7)
    assert ahead[3] == pytest.approx(np.arange(140, 154), abs=0.5)
    assert seasonal_strength(np.tile([1.0, 5, 2, 8], 10)[None], 4)[0] > 0.95


def test_two_differences_carry_a_parabola_on():
    t = np.arange(120.0)
    ahead, orders = forecast_block((0.5 * t * t)[None], 5, ArimaSettings(max_d=2))
    assert orders[0, 1] == 2
    assert ahead[0] == pytest.approx(0.5 * np.arange(120.0, 125.0) ** 2, rel=1e-3)


def test_needs_difference_is_by_row():
    y = np.array([noise(400, 3), np.cumsum(noise(400, 4)), np.full(400, 1.0)])
    assert needs_difference(y).tolist() == [False, True, False]


def test_criteria_and_settings():
    y = np.array([noise(300, s) for s in range(30)])
    sizes = [forecast_block(y, 1, ArimaSettings(criterion=c))[1][:, [0, 2]].sum() for c in ("aic", "aicc", "bic")]
    assert sizes[0] >= sizes[1] >= sizes[2]
    for bad in ({"m": 0}, {"max_p": -1}, {"seasonal_order": (1, 0, 0)}, {"order": (1, 3, 0)}, {"order": (1, 0)}, {"information_criterion": "x"}, {"m": 7, "seasonal_order": (0, 2, 0)}):
        with pytest.raises(ValueError):
            make_model("AutoARIMA", bad)
    assert make_model("AutoARIMA", {"m": 7, "maxiter": 10}).min_length > make_model("AutoARIMA").min_length
