"""Additive exponential smoothing (Holt 1957, Winters 1960) for many series at once.

The recursion runs over time in Python while numpy carries all series of an
Arrow batch and all candidate parameters side by side, so the interpreter cost
of a step is shared by thousands of (series, candidate) pairs.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Series handled together; bounds the memory of a Python worker.
BLOCK = 1000
COARSE = tuple(product((0.1, 0.3, 0.5, 0.8), (0.01, 0.1, 0.3), (0.05, 0.2, 0.5)))
FINE = tuple(product((0.7, 1.0, 1.4), (0.3, 1.0, 2.0), (0.5, 1.0, 1.6)))


def smooth(series: list[np.ndarray], season: int, params: np.ndarray):
    """Run the recursion for series sorted from longest to shortest.

    ``params`` has shape (3, series, candidates): level, trend and season
    weights. Level and trend start from the first two seasons, the seasonal
    pattern from the first. Returns the squared one-step error and the final
    level, trend and seasonal pattern.
    """
    lengths = np.array([len(y) for y in series])
    values = np.zeros((lengths[0], len(series)))
    for j, y in enumerate(series):
        values[: len(y), j] = y
    shape = params.shape[1:]
    mean_1, mean_2 = values[:season].mean(axis=0), values[season : 2 * season].mean(axis=0)
    level = np.broadcast_to(mean_1[:, None], shape).copy()
    trend = np.broadcast_to(((mean_2 - mean_1) / season)[:, None], shape).copy()
    pattern = np.broadcast_to((values[:season] - mean_1)[:, :, None], (season, *shape)).copy()
    sse = np.zeros(shape)
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    for t in range(season, lengths[0]):
        k = active[t]
        a, b, g = params[:, :k]
        s = pattern[t % season, :k]
        base = level[:k] + trend[:k]
        error = values[t, :k, None] - base - s
        sse[:k] += error * error
        new_level = base + a * error
        trend[:k] += b * (new_level - level[:k] - trend[:k])
        s += g * (values[t, :k, None] - new_level - s)
        level[:k] = new_level
    return sse, level, trend, pattern


def forecast_block(series: list[np.ndarray], season: int, steps: int, fixed, coarse=COARSE, fine=FINE) -> np.ndarray:
    """Forecasts (series, steps) with given parameters or the best of two grid passes."""
    rows = np.arange(len(series))

    def best_of(params: np.ndarray):
        sse, level, trend, pattern = smooth(series, season, params)
        i = sse.argmin(axis=1)
        return params[:, rows, i], level[rows, i], trend[rows, i], pattern[:, rows, i]

    def spread(candidates) -> np.ndarray:
        grid = np.array(candidates).T
        return np.broadcast_to(grid[:, None, :], (3, len(series), grid.shape[1]))

    if fixed is not None:
        _, level, trend, pattern = best_of(spread([fixed]))
    else:
        found, *_ = best_of(spread(coarse))
        around = np.clip(found[:, :, None] * spread(fine), 0.0, 1.0)
        _, level, trend, pattern = best_of(around)
    ahead = np.arange(1, steps + 1)
    n = np.array([len(y) for y in series])
    phase = (n[:, None] + ahead - 1) % season
    return level[:, None] + trend[:, None] * ahead + pattern[phase, rows[:, None]]


def holt_winters(ys: Column, steps: int, seasonal_periods: int = 7, params=None, coarse=COARSE, fine=FINE) -> Column:
    """Forecast array; ``params`` fixes (level, trend, season) weights, else they are searched.

    ``coarse`` are the weights that the search tries first, ``fine`` the factors
    it tries around the best of them. Series shorter than two seasons get a
    null array.
    """
    for name, grid in (("coarse", coarse), ("fine", fine)):
        if not len(grid) or any(len(c) != 3 or min(c) < 0 for c in grid):
            raise ValueError(f"{name} must be a list of three numbers each, none below 0")
    if any(max(c) > 1 for c in coarse):
        raise ValueError("coarse weights must lie between 0 and 1")
    m = seasonal_periods
    if params is not None and (len(params) != 3 or not all(0 <= p <= 1 for p in params)):
        raise ValueError("params must be three weights between 0 and 1")

    @F.pandas_udf("array<double>")
    def fit_and_forecast(batch: pd.Series) -> pd.Series:
        result = pd.Series([None] * len(batch), dtype=object)
        usable = [i for i, y in enumerate(batch) if y is not None and len(y) >= 2 * m]
        usable.sort(key=lambda i: -len(batch.iloc[i]))
        for lo in range(0, len(usable), BLOCK):
            some = usable[lo : lo + BLOCK]
            ahead = forecast_block([batch.iloc[i] for i in some], m, steps, params, coarse, fine)
            for i, row in zip(some, ahead):
                result.iloc[i] = row
        return result

    return fit_and_forecast(ys)
