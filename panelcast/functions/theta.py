"""The theta method (Assimakopoulos and Nikolopoulos 2000; Spiliotis et al. 2020) for stacks of series.

A seasonal pattern is taken out where a test finds one. A series is then a
weighted mean of its trend line and of a theta line, the series bent away from
the trend by ``theta``; the first is carried on, the second smoothed
exponentially. With several thetas or kinds of lines the one whose one-step
errors are least in the mean is taken, series by series.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np

ALPHAS = tuple(round(0.05 * k, 2) for k in range(1, 20))
NINETY_PERCENT = 1.645


@dataclass(frozen=True)
class ThetaSettings:
    """``season`` is the length of a season in steps, 1 for none.

    A multiplicative season, an exponential trend and a multiplicative model
    need values above 0; other series get the additive or linear form.
    """

    thetas: tuple[float, ...] = (2.0,)
    season: int = 7
    season_mode: str = "multiplicative"
    trend_modes: tuple[str, ...] = ("linear",)
    model_modes: tuple[str, ...] = ("additive",)
    alphas: tuple[float, ...] = ALPHAS

    def __post_init__(self) -> None:
        if self.season < 1 or not self.thetas or any(t == 0 for t in self.thetas):
            raise ValueError("the season must be 1 or more, and no theta may be 0")
        if self.season_mode not in ("additive", "multiplicative", "none"):
            raise ValueError(f"season_mode must be 'additive', 'multiplicative' or 'none', got {self.season_mode!r}")
        if not set(self.trend_modes) <= {"linear", "exponential"} or not set(self.model_modes) <= {"additive", "multiplicative"}:
            raise ValueError("trend modes are 'linear' and 'exponential', model modes 'additive' and 'multiplicative'")
        if not self.alphas or not all(0 < a <= 1 for a in self.alphas):
            raise ValueError("smoothing weights must lie in (0, 1]")

    @property
    def least_length(self) -> int:
        return max(3, 2 * self.season + 1 if self.season > 1 else 0)


def has_season(y: np.ndarray, m: int) -> np.ndarray:
    """Whether the autocorrelation at ``m`` stands out at 90 percent, for each row (Bartlett's bounds)."""
    e = y - y.mean(axis=1, keepdims=True)
    power = (e * e).sum(axis=1)
    flat = power <= 1e-12 * np.maximum(1.0, (y * y).sum(axis=1))
    r = np.array([(e[:, k:] * e[:, : e.shape[1] - k]).sum(axis=1) / np.where(flat, 1.0, power) for k in range(1, m + 1)])
    limit = NINETY_PERCENT * np.sqrt((1 + 2 * (r[:-1] ** 2).sum(axis=0)) / y.shape[1])
    return ~flat & (r[-1] > limit)


def pattern_of(y: np.ndarray, m: int, multiplicative: np.ndarray) -> np.ndarray:
    """Seasonal factors (series, m) by place in the season, from deviations from a centred moving mean."""
    n = y.shape[1]
    weights = np.full(m, 1 / m) if m % 2 else np.r_[0.5, np.ones(m - 1), 0.5] / m
    half = len(weights) // 2
    trend = sum(w * y[:, k : n - 2 * half + k] for k, w in enumerate(weights))
    middle = y[:, half : n - half]
    safe = np.where(multiplicative[:, None], trend, 1.0)
    rest = np.where(multiplicative[:, None], middle / np.where(safe == 0, 1.0, safe), middle - trend)
    place = (np.arange(rest.shape[1]) + half) % m
    pattern = np.stack([rest[:, place == k].mean(axis=1) for k in range(m)], axis=1)
    mean = pattern.mean(axis=1, keepdims=True)
    return np.where(multiplicative[:, None], pattern / np.where(mean == 0, 1.0, mean), pattern - mean)


def line_through(z: np.ndarray, ahead: int) -> np.ndarray:
    """Least-squares line of each row over its own steps and ``ahead`` more."""
    n = z.shape[1]
    t = np.arange(1, n + 1) - (n + 1) / 2
    slope = (z * t).sum(axis=1) / (t * t).sum()
    return z.mean(axis=1)[:, None] + slope[:, None] * (np.arange(1, n + ahead + 1) - (n + 1) / 2)


def smoothed(line: np.ndarray, alphas: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """One-step forecasts (series, steps) and last levels of exponential smoothing with the weight of least squared error.

    The level starts at the first value, whose own forecast is itself.
    """
    a = np.array(alphas)
    level = np.repeat(line[:, :1], len(a), axis=1)
    before = np.empty((line.shape[1], len(line), len(a)))
    sse = np.zeros(level.shape)
    for t in range(line.shape[1]):
        before[t] = level
        error = line[:, t, None] - level
        sse += error * error
        level = level + a * error
    rows, best = np.arange(len(line)), sse.argmin(axis=1)
    return before[:, rows, best].T, level[rows, best]


def forecast_block(y: np.ndarray, steps: int, s: ThetaSettings) -> tuple[np.ndarray, list[str]]:
    """Forecasts (series, steps) and the name of the form that each series got."""
    n, m = y.shape[1], s.season
    place = np.arange(n + steps) % m
    pattern, times = np.zeros((len(y), m)), np.zeros(len(y), dtype=bool)
    if m > 1 and s.season_mode != "none":
        seasonal = has_season(y, m)
        times = seasonal & (s.season_mode == "multiplicative") & (y.min(axis=1) > 0)
        pattern = pattern_of(y, m, times)
        times &= pattern.min(axis=1) > 0
        pattern = np.where(seasonal[:, None], np.where(times[:, None], pattern, pattern_of(y, m, np.zeros(len(y), dtype=bool))), 0.0)
    factor = np.where(times[:, None], pattern, 1.0)[:, place]
    shift = np.where(times[:, None], 0.0, pattern)[:, place]
    z = (y - shift[:, :n]) / factor[:, :n]
    above = z.min(axis=1) > 0
    best, out, name = np.full(len(y), np.inf), np.zeros((len(y), steps)), [""] * len(y)
    for trend_mode, model_mode, theta in product(s.trend_modes, s.model_modes, s.thetas):
        line = line_through(z, steps)
        bent = above & (trend_mode == "exponential")
        line[bent] = np.exp(line_through(np.log(z[bent]), steps))
        ratio = above & (line.min(axis=1) > 0) & (model_mode == "multiplicative")
        known = line[:, :n]
        away = theta * z + (1 - theta) * known
        away[ratio] = z[ratio] ** theta * known[ratio] ** (1 - theta)
        before, level = smoothed(away, s.alphas)

        def mixed(trend: np.ndarray, theta_line: np.ndarray) -> np.ndarray:
            made = (1 - 1 / theta) * trend + theta_line / theta
            made[ratio] = trend[ratio] ** (1 - 1 / theta) * theta_line[ratio] ** (1 / theta)
            return made

        error = np.abs(z - mixed(known, before)).mean(axis=1)
        ahead = mixed(line[:, n:], np.repeat(level[:, None], steps, axis=1))
        better = error < best
        best[better], out[better] = error[better], ahead[better]
        for i in np.flatnonzero(better):
            name[i] = f"theta={theta:g}, {'exponential' if bent[i] else 'linear'} trend, {'multiplicative' if ratio[i] else 'additive'}"
    return out * factor[:, n:] + shift[:, n:], name
