"""Exponential smoothing in state-space form (Hyndman et al. 2008), the form chosen per series.

A form names its error, trend and season: additive (A), multiplicative (M) or
none (N), the trend possibly damped (Ad). The recursion of the states depends
on trend and season alone, so one pass over time serves additive and
multiplicative errors; numpy carries all series of a stack and all candidate
weights side by side. Among the forms the least AICc wins.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np

TRENDS, SEASONS = ("N", "A", "Ad"), ("N", "A", "M")
# Weights that are tried: level, trend, season and damping. The states settle for these.
LEVELS, SLOPES, PATTERNS, DAMPINGS = (0.05, 0.2, 0.4, 0.7), (0.01, 0.05, 0.2), (0.02, 0.1, 0.25), (0.8, 0.9, 0.98)
FACTORS = (0.6, 1.0, 1.5)


@dataclass(frozen=True)
class EtsSettings:
    """``season`` in steps, 1 for none; ``forms`` as strings such as ``"AAdM"``, all if empty.

    ``weights`` (level, trend, season, damping) turns the search off.
    ``refine`` tries the weights around the best ones of each form once more.
    """

    season: int = 7
    forms: tuple[str, ...] = ()
    weights: tuple[float, float, float, float] | None = None
    refine: bool = True

    def __post_init__(self) -> None:
        if self.season < 1:
            raise ValueError("the season must be 1 or more")
        known = {e + t + c for e, t, c in product("AM", TRENDS, SEASONS)} - {f"A{t}M" for t in TRENDS}
        if unknown := sorted(set(self.forms) - known):
            raise ValueError(f"unknown forms {unknown}; known: {', '.join(sorted(known))}")
        if self.season == 1 and any(f[-1] != "N" for f in self.forms):
            raise ValueError("seasonal forms need a season above 1")
        if self.weights is not None and (len(self.weights) != 4 or not all(0 <= w <= 1 for w in self.weights)):
            raise ValueError("weights must be four numbers between 0 and 1")

    @property
    def wanted(self) -> list[tuple[str, str, str]]:
        """(error, trend, season) in a fixed order."""
        every = [(e, t, c) for t, c, e in product(TRENDS, SEASONS if self.season > 1 else "N", "AM") if not (e == "A" and c == "M")]
        return [f for f in every if not self.forms or "".join(f) in self.forms]

    @property
    def least_length(self) -> int:
        return max(2 * self.season, 10) + self.season + 4

    def grid(self, trend: str, season: str) -> np.ndarray:
        """Candidate weights (4, candidates) of a form."""
        if self.weights is not None:
            a, b, g, phi = self.weights
            return np.array([[a], [b if trend != "N" else 0.0], [g if season != "N" else 0.0], [phi if trend == "Ad" else 1.0]])
        return np.array(
            [
                w
                for w in product(LEVELS, SLOPES if trend != "N" else (0.0,), PATTERNS if season != "N" else (0.0,), DAMPINGS if trend == "Ad" else (1.0,))
                if w[1] <= w[0] and w[2] <= 1 - w[0]
            ]
        ).T


def starts(y: np.ndarray, m: int, trend: str, season: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level, trend and pattern (m, series) before the first value: means of the first seasons.

    Without a season the first ten values take the place of the first two seasons.
    """
    half = m if season != "N" else 5
    one, two = y[:, :half].mean(axis=1), y[:, half : 2 * half].mean(axis=1)
    slope = (two - one) / half if trend != "N" else np.zeros(len(y))
    if season == "M":
        pattern = (y[:, :m] / np.where(one == 0, 1.0, one)[:, None]).T
    elif season == "A":
        pattern = (y[:, :m] - one[:, None]).T
    else:
        pattern = np.zeros((m, len(y)))
    return one, slope, pattern.copy()


def run(y: np.ndarray, m: int, trend: str, season: str, weights: np.ndarray):
    """The recursion with ``weights`` (4, series, candidates).

    Returns the mean of squared errors, that of squared relative errors, the
    mean logarithm of the forecasts' sizes, and the final states. Forms whose
    forecasts are not above 0 have infinite relative errors.
    """
    shape = weights.shape[1:]
    one, slope, first = starts(y, m, trend, season)
    level = np.broadcast_to(one[:, None], shape).copy()
    growth = np.broadcast_to(slope[:, None], shape).copy()
    pattern = np.broadcast_to(first[:, :, None], (m, *shape)).copy()
    a, b, g, phi = weights
    sse, relative, logs = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    low = np.full(shape, np.inf)
    with np.errstate(all="ignore"):
        for t in range(y.shape[1]):
            s = pattern[t % m]
            growth *= phi
            base = level + growth
            fit = base * s if season == "M" else base + s
            error = y[:, t, None] - fit
            sse += error * error
            relative += (error / fit) ** 2
            logs += np.log(np.abs(fit))
            np.minimum(low, fit, out=low)
            step = error / s if season == "M" else error
            level = base + a * step
            growth += b * step
            if season != "N":
                s += g * (error / base if season == "M" else error)
    n = y.shape[1]
    bad = ~(low > 0)
    relative[bad], logs[bad] = np.inf, 0.0
    sse[~np.isfinite(sse)] = np.inf
    relative[~np.isfinite(relative)] = np.inf
    return sse / n, relative / n, logs / n, (level, growth, pattern)


def scores(form: tuple[str, str, str], m: int, n: int, sse: np.ndarray, relative: np.ndarray, logs: np.ndarray, size: np.ndarray) -> np.ndarray:
    """AICc: twice the negative log-likelihood without its constants, plus the price of the form's weights and first states."""
    error, trend, season = form
    k = 3 + (trend != "N") * 2 + (trend == "Ad") + (season != "N") * m
    spread = sse if error == "A" else relative
    least = 1e-12 * (np.maximum(size, 1e-300)[:, None] if error == "A" else 1.0)
    with np.errstate(all="ignore"):
        score = n * np.log(np.maximum(spread, least)) + (0.0 if error == "A" else 2 * n * logs)
    score += 2 * k + 2 * k * (k + 1) / max(n - k - 1, 1)
    return np.where(np.isfinite(score), score, np.inf)


def forecast_block(y: np.ndarray, steps: int, s: EtsSettings) -> tuple[np.ndarray, list[str]]:
    """Forecasts (series, steps) and the name of each series' form, such as ``ETS(A,Ad,M)``."""
    n, m, rows = y.shape[1], s.season, np.arange(len(y))
    above, size = y.min(axis=1) > 0, (y * y).mean(axis=1)
    best, out, name = np.full(len(y), np.inf), np.repeat(y[:, -1:], steps, axis=1), ["none"] * len(y)
    wanted = s.wanted
    for trend, season in dict.fromkeys((t, c) for _, t, c in wanted):
        grid = s.grid(trend, season)
        forms = [f for f in wanted if f[1:] == (trend, season)]
        around = [np.broadcast_to(grid[:, None, :], (4, len(y), grid.shape[1]))]
        if s.refine and s.weights is None:
            made = run(y, m, trend, season, around[0])
            for form in forms:
                top = scores(form, m, n, *made[:3], size).argmin(axis=1)
                free = [FACTORS, FACTORS if trend != "N" else (1.0,), FACTORS if season != "N" else (1.0,)]
                near = np.array([*product(*free, (1.0,))]).T
                tried = grid[:, top][:, :, None] * near[:, None, :]
                tried[0] = np.clip(tried[0], 0.001, 0.999)
                tried[1], tried[2] = np.minimum(tried[1], tried[0]), np.minimum(tried[2], 1 - tried[0])
                around.append(tried)
            around = around[1:]
        else:
            around = around * len(forms)
        for form, weights in zip(forms, around):
            *errors, (level, growth, pattern) = run(y, m, trend, season, weights)
            score = scores(form, m, n, *errors, size)
            if form[0] == "M" or season == "M":
                score[~above] = np.inf
            i = score.argmin(axis=1)
            better = score[rows, i] < best
            best[better] = score[rows, i][better]
            phi = weights[3][rows, i]
            total = np.cumsum(phi[:, None] ** np.arange(1, steps + 1), axis=1)
            ahead = level[rows, i][:, None] + total * growth[rows, i][:, None]
            own = pattern[:, rows, i].T[:, (n + np.arange(steps)) % m]
            ahead = ahead * own if season == "M" else ahead + own
            out[better] = ahead[better]
            for j in np.flatnonzero(better):
                name[j] = f"ETS({form[0]},{trend},{season})"
    return out, name
