"""Seasonal ARIMA by least squares, for all orders and all series of one length at once.

``phi(B) Phi(B^m) w = c + theta(B) Theta(B^m) e``, w being the series after seasonal
and plain differences. Shocks come from a long autoregression (Hannan and
Rissanen 1982). Whatever the order, its regression uses lags of w and e from one
set; their cross products are summed once per series, and every candidate is
solved from that small matrix, stacked over the series. With both plain and
seasonal terms the products of the polynomials are kept: the plain and the
seasonal coefficients are solved in turn, each with the others held.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KPSS_5_PERCENT = 0.463
SEASONAL_STRENGTH = 0.64  # of Wang, Smith and Hyndman (2006), from which on a seasonal difference is taken
TURNS = 12  # alternations between plain and seasonal coefficients
BLOCK_NUMBERS = 1 << 22  # numbers of lagged values held at once; bounds the memory of a Python worker
CRITERIA = ("aicc", "aic", "bic")
RESULT = "struct<values: array<double>, ar: int, diff: int, ma: int, season_ar: int, season_diff: int, season_ma: int>"


@dataclass(frozen=True)
class ArimaSettings:
    """Which orders are tried; ``order`` (p, d, q) and ``seasonal_order`` (P, D, Q) fix them.

    ``m`` is the length of a season in steps, 1 for none.
    """

    max_p: int = 3
    max_q: int = 3
    max_d: int = 1
    m: int = 1
    max_P: int = 1
    max_Q: int = 1
    max_D: int = 1
    order: tuple[int, int, int] | None = None
    seasonal_order: tuple[int, int, int] | None = None
    criterion: str = "aicc"

    def __post_init__(self) -> None:
        numbers = [self.max_p, self.max_q, self.max_d, self.max_P, self.max_Q, self.max_D, *(self.order or ()), *(self.seasonal_order or ())]
        if self.m < 1 or min(numbers) < 0:
            raise ValueError("orders must not be below 0, the season not below 1")
        for name, given in (("order", self.order), ("seasonal_order", self.seasonal_order)):
            if given is not None and len(given) != 3:
                raise ValueError(f"{name} must be three numbers, got {given!r}")
        if self.m == 1 and self.seasonal_order is not None:
            raise ValueError("seasonal orders need a season m above 1")
        if max(self.max_d, (self.order or (0, 0, 0))[1]) > 2 or max(self.max_D, (self.seasonal_order or (0, 0, 0))[1]) > 1:
            raise ValueError("at most two plain differences and one seasonal difference are supported")
        if self.criterion not in CRITERIA:
            raise ValueError(f"criterion must be one of {CRITERIA}, got {self.criterion!r}")

    @property
    def plain(self) -> list[tuple[int, int]]:
        if self.order:
            return [(self.order[0], self.order[2])]
        return list(product(range(self.max_p + 1), range(self.max_q + 1)))

    @property
    def seasonal(self) -> list[tuple[int, int]]:
        if self.m == 1 or (self.order and not self.seasonal_order):
            return [(0, 0)]
        if self.seasonal_order:
            return [(self.seasonal_order[0], self.seasonal_order[2])]
        return list(product(range(self.max_P + 1), range(self.max_Q + 1)))

    @property
    def tops(self) -> tuple[int, int, int, int]:
        """Largest p, q, P, Q."""
        return *map(max, zip(*self.plain)), *map(max, zip(*self.seasonal))

    @property
    def candidates(self) -> list[tuple[int, int, int, int]]:
        return [(*a, *b) for a, b in product(self.plain, self.seasonal)]

    @property
    def most_differences(self) -> tuple[int, int]:
        d = self.order[1] if self.order else self.max_d
        return d, 0 if self.m == 1 or (self.order and not self.seasonal_order) else self.seasonal_order[1] if self.seasonal_order else self.max_D

    @property
    def least_length(self) -> int:
        """Values from which on a series of any kind gets a forecast."""
        d, season_d = self.most_differences
        need = lambda n: n - first_row(n, self) >= sum(self.tops) + 3
        n = 2
        while not all(need(n + more) for more in range(40)):
            n += 1
        # the strength of a season is judged from two seasons on
        return max(n + d + season_d * self.m, 2 * self.m + 1 if self.m > 1 else 2)


def long_order(n: int, s: ArimaSettings) -> int:
    """Lags of the regression that estimates the shocks of ``n`` values."""
    p, q, _, season_q = s.tops
    if not q and not season_q:
        return 0
    return min(max(int(np.ceil(np.log(max(n, 2)) * 2)), 2 * s.m if s.m > 1 else 0) + p + q, n // 4)


def first_row(n: int, s: ArimaSettings) -> int:
    """Index from which on all lagged values and shocks of ``n`` values exist."""
    p, q, season_p, season_q = s.tops
    return max(p + season_p * s.m, long_order(n, s) + q + season_q * s.m)


# ------------------------------------------------------------------------- tests


def needs_difference(y: np.ndarray) -> np.ndarray:
    """Level-stationarity test of Kwiatkowski et al. (1992) at 5 percent, for each row of ``y``."""
    y = np.atleast_2d(y)
    n = y.shape[1]
    e = y - y.mean(axis=1, keepdims=True)
    lags = min(int(12 * (n / 100) ** 0.25), n - 1)
    variance = (e * e).sum(axis=1) / n
    for k in range(1, lags + 1):
        variance += 2 * (1 - k / (lags + 1)) * (e[:, k:] * e[:, :-k]).sum(axis=1) / n
    flat = variance <= 1e-12 * np.maximum(1.0, (y * y).sum(axis=1) / n)
    statistic = (np.cumsum(e, axis=1) ** 2).sum(axis=1) / (n * n * np.where(flat, 1.0, variance))
    return ~flat & (statistic > KPSS_5_PERCENT)


def seasonal_strength(y: np.ndarray, m: int) -> np.ndarray:
    """Share of the detrended variance that a fixed seasonal pattern explains, for each row of ``y``.

    The trend is a centred moving mean over a season (half weights at the ends
    where the season is even), the pattern the mean of each position in the season.
    """
    n = y.shape[1]
    weights = np.full(m, 1 / m) if m % 2 else np.r_[0.5, np.ones(m - 1), 0.5] / m
    half = len(weights) // 2
    trend = sum(w * y[:, k : n - 2 * half + k] for k, w in enumerate(weights))
    rest = y[:, half : n - half] - trend
    place = (np.arange(rest.shape[1]) + half) % m
    counts = np.bincount(place, minlength=m)
    pattern = np.zeros((len(y), m))
    for k in range(m):
        if counts[k]:
            pattern[:, k] = rest[:, place == k].mean(axis=1)
    noise = (rest - pattern[:, place]).var(axis=1)
    whole = rest.var(axis=1)
    return np.where(whole > 1e-12 * np.maximum(1.0, (y * y).mean(axis=1)), np.maximum(0.0, 1 - noise / np.where(whole > 0, whole, 1.0)), 0.0)


def settles(ar: np.ndarray) -> np.ndarray:
    """Whether each row of coefficients is an autoregression that returns to its mean (step-down of Durbin and Levinson)."""
    a, good = ar.copy(), np.ones(len(ar), dtype=bool)
    for p in range(a.shape[1], 0, -1):
        last = a[:, p - 1].copy()
        good &= np.abs(last) < 1
        safe = np.where(np.abs(last) < 1, 1 - last * last, 1.0)[:, None]
        a = (a[:, : p - 1] + last[:, None] * a[:, : p - 1][:, ::-1]) / safe
    return good


# ----------------------------------------------------------------------- solving


@dataclass
class Fit:
    """Chosen orders and coefficients per series: ``a`` and ``b`` belong to ``ar_lags`` and ``ma_lags``."""

    chosen: np.ndarray
    constant: np.ndarray
    a: np.ndarray
    b: np.ndarray


def lag_set(plain: int, seasonal: int, m: int) -> list[int]:
    return sorted({k * m + i for k in range(seasonal + 1) for i in range(plain + 1)} - {0})


def _solved(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least-squares solutions of stacked normal equations, of least norm where they are singular."""
    inverse = np.linalg.pinv(gram, rcond=gram.shape[-1] * np.finfo(float).eps, hermitian=True)
    return (inverse @ right[..., None])[..., 0]


class Regression:
    """Cross products of all columns that any order uses: 1, lags of w, lags of the shocks, w itself."""

    def __init__(self, w: np.ndarray, shocks: np.ndarray, s: ArimaSettings):
        p, q, season_p, season_q = s.tops
        self.m, n = s.m, w.shape[1]
        self.plain_is_given, self.season_is_given = s.order is not None, s.seasonal_order is not None
        self.ar_lags, self.ma_lags = lag_set(p, season_p, s.m), lag_set(q, season_q, s.m)
        first = first_row(n, s)
        self.rows = n - first
        columns = [np.ones((len(w), self.rows)), *(w[:, first - k : n - k] for k in self.ar_lags)]
        columns += [*(shocks[:, first - k : n - k] for k in self.ma_lags), w[:, first:]]
        x = np.stack(columns, axis=1)
        self.gram = x @ x.transpose(0, 2, 1)
        self.size = len(columns)
        self.ar_at = {0: self.size - 1} | {k: 1 + i for i, k in enumerate(self.ar_lags)}
        self.ma_at = {k: 1 + len(self.ar_lags) + i for i, k in enumerate(self.ma_lags)}

    def solve(self, p: int, q: int, season_p: int, season_q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(coefficients of all columns but the last, residual variance, whether the autoregression settles)."""
        n = len(self.gram)
        phi, theta = np.zeros((n, p)), np.zeros((n, q))
        season_phi, season_theta = np.zeros((n, season_p)), np.zeros((n, season_q))
        constant = np.zeros(n)
        both = (p or q) and (season_p or season_q)
        for _ in range(TURNS if both else 1):
            if p or q or not (season_p or season_q):
                constant, phi, theta = self._half(p, q, 1, season_phi, season_theta, self.m)
            if season_p or season_q:
                constant, season_phi, season_theta = self._half(season_p, season_q, self.m, phi, theta, 1)
        whole = np.zeros((n, self.size - 1))
        whole[:, 0] = constant
        for i, j in product(range(p + 1), range(season_p + 1)):
            if i or j:
                left = phi[:, i - 1] if i else 1.0
                whole[:, self.ar_at[i + j * self.m]] += left * season_phi[:, j - 1] * (-1 if i else 1) if j else left
        for i, j in product(range(q + 1), range(season_q + 1)):
            if i or j:
                left = theta[:, i - 1] if i else 1.0
                whole[:, self.ma_at[i + j * self.m]] += left * season_theta[:, j - 1] if j else left
        r = np.column_stack([-whole, np.ones(n)])
        variance = np.einsum("si,sij,sj->s", r, self.gram, r) / self.rows
        good = np.ones(n, dtype=bool)
        if not self.plain_is_given:
            good &= settles(phi)
        if not self.season_is_given:
            good &= settles(season_phi)
        return whole, variance, good

    def _half(self, p: int, q: int, step: int, held_ar: np.ndarray, held_ma: np.ndarray, held_step: int):
        """Coefficients at multiples of ``step``, those at multiples of ``held_step`` being given."""
        n = len(self.gram)

        def filtered(k: int, at: dict[int, int], held: np.ndarray, sign: float) -> np.ndarray:
            """The column of lag ``k`` with the held polynomial applied, in terms of the summed columns."""
            v = np.zeros((n, self.size))
            if k in at:
                v[:, at[k]] += 1.0
            for j in range(held.shape[1]):
                v[:, at[k + (j + 1) * held_step]] += sign * held[:, j]
            return v

        constant = np.zeros((n, self.size))
        constant[:, 0] = 1.0
        columns = [constant, *(filtered(i * step, self.ar_at, held_ar, -1.0) for i in range(1, p + 1))]
        columns += [filtered(i * step, self.ma_at, held_ma, 1.0) for i in range(1, q + 1)]
        target = filtered(0, self.ar_at, held_ar, -1.0)
        for j in range(held_ma.shape[1]):
            target[:, self.ma_at[(j + 1) * held_step]] -= held_ma[:, j]
        t = np.stack(columns, axis=1)
        half = t @ self.gram
        found = _solved(half @ t.transpose(0, 2, 1), (half @ target[..., None])[..., 0])
        return found[:, 0], found[:, 1 : 1 + p], found[:, 1 + p :]


def estimated_shocks(w: np.ndarray, lags: int) -> np.ndarray:
    """Residuals of an autoregression on ``lags`` values, 0 before it begins."""
    shocks = np.zeros(w.shape)
    if lags:
        n = w.shape[1]
        x = np.stack([np.ones((len(w), n - lags)), *(w[:, lags - k : n - k] for k in range(1, lags + 1))], axis=1)
        beta = _solved(x @ x.transpose(0, 2, 1), (x @ w[:, lags:, None])[..., 0])
        shocks[:, lags:] = w[:, lags:] - np.einsum("sk,skt->st", beta, x)
    return shocks


def fitted(w: np.ndarray, shocks: np.ndarray, s: ArimaSettings) -> tuple[Regression, Fit]:
    """The candidate with the least criterion per row; all candidates are compared on the same rows."""
    regression = Regression(w, shocks, s)
    rows, power = regression.rows, regression.gram[:, -1, -1]
    best = np.full(len(w), np.inf)
    chosen, found = np.zeros((len(w), 4), dtype=int), np.zeros((len(w), regression.size - 1))
    for order in s.candidates:
        whole, variance, good = regression.solve(*order)
        k = sum(order) + 2
        score = rows * np.log(np.maximum(variance, 1e-12 * (1.0 + power / rows)))
        score += k * np.log(rows) if s.criterion == "bic" else 2 * k
        if s.criterion == "aicc":
            score += 2 * k * (k + 1) / max(rows - k - 1, 1)
        # A searched order must not explode; without autoregression it never does.
        score = np.where(good, score, np.inf)
        better = score < best
        best[better], chosen[better], found[better] = score[better], order, whole[better]
    cut = 1 + len(regression.ar_lags)
    return regression, Fit(chosen, found[:, 0], found[:, 1:cut], found[:, cut:])


def carried_on(w: np.ndarray, shocks: np.ndarray, regression: Regression, fit: Fit, steps: int) -> np.ndarray:
    """The recursion with future shocks of 0."""
    back = max([1, *regression.ar_lags, *regression.ma_lags])
    path = np.column_stack([w[:, -back:], np.zeros((len(w), steps))])
    noise = np.column_stack([shocks[:, -back:], np.zeros((len(w), steps))])
    for t in range(back, back + steps):
        path[:, t] = fit.constant
        for j, k in enumerate(regression.ar_lags):
            path[:, t] += fit.a[:, j] * path[:, t - k]
        for j, k in enumerate(regression.ma_lags):
            path[:, t] += fit.b[:, j] * noise[:, t - k]
    return path[:, back:]


def forecast_block(y: np.ndarray, steps: int, s: ArimaSettings) -> tuple[np.ndarray, np.ndarray] | None:
    """Forecasts (series, steps) and orders (p, d, q, P, D, Q) for series of one length; None if they are too short."""
    out, orders = np.zeros((len(y), steps)), np.zeros((len(y), 6), dtype=int)
    plain_top, season_top = s.most_differences
    if y.shape[1] < s.least_length:
        return None
    seasonal = np.full(len(y), bool(season_top))
    if season_top and not s.seasonal_order:
        seasonal = seasonal_strength(y, s.m) >= SEASONAL_STRENGTH
    for season_d in (0, 1):
        own = np.flatnonzero(seasonal == bool(season_d))
        if not len(own):
            continue
        z = y[own, s.m :] - y[own, : -s.m] if season_d else y[own]
        times = np.full(len(own), plain_top)
        if not s.order:
            times[:] = 0
            for d in range(plain_top):
                again = np.flatnonzero(times == d)
                if len(again):
                    times[again] += needs_difference(np.diff(z[again], d, axis=1))
        for d in range(plain_top + 1):
            part = np.flatnonzero(times == d)
            if len(part):
                ahead, chosen = _stationary(np.diff(z[part], d, axis=1), steps, s)
                for k in range(d - 1, -1, -1):
                    ahead = np.diff(z[part], k, axis=1)[:, -1:] + np.cumsum(ahead, axis=1)
                if season_d:
                    longer = np.column_stack([y[own[part], -s.m :], ahead])
                    for t in range(s.m, s.m + steps):
                        longer[:, t] += longer[:, t - s.m]
                    ahead = longer[:, s.m :]
                out[own[part]] = ahead
                p, q, season_p, season_q = chosen.T
                orders[own[part]] = np.column_stack([p, np.full(len(part), d), q, season_p, np.full(len(part), season_d), season_q])
    return out, orders


def _stationary(w: np.ndarray, steps: int, s: ArimaSettings) -> tuple[np.ndarray, np.ndarray]:
    centre = w.mean(axis=1, keepdims=True)
    size = w.std(axis=1, keepdims=True)
    size[size == 0] = 1.0
    w = (w - centre) / size
    shocks = estimated_shocks(w, long_order(w.shape[1], s))
    regression, fit = fitted(w, shocks, s)
    return carried_on(w, shocks, regression, fit, steps) * size + centre, fit.chosen


def arima(ys: Column, steps: int, settings: ArimaSettings) -> Column:
    """Struct ``values, ar, diff, ma, season_ar, season_diff, season_ma``; null for series that are too short."""
    width = max(long_order(10**6, settings), sum(settings.tops) * settings.m) + 4

    @F.pandas_udf(RESULT)
    def fit_and_forecast(batch: pd.Series) -> pd.DataFrame:
        rows: list[tuple] = [(None,) * 7] * len(batch)
        alike: dict[int, list[int]] = {}
        for i, y in enumerate(batch):
            if y is not None:
                alike.setdefault(len(y), []).append(i)
        for n, members in alike.items():
            at_once = max(1, BLOCK_NUMBERS // (n * width + 1))
            for lo in range(0, len(members), at_once):
                some = members[lo : lo + at_once]
                made = forecast_block(np.array([batch.iloc[i] for i in some], dtype=float), steps, settings)
                if made is not None:
                    for i, ahead, order in zip(some, *made):
                        rows[i] = (ahead, *order.tolist())
        return pd.DataFrame(rows, columns=["values", "ar", "diff", "ma", "season_ar", "season_diff", "season_ma"]).astype(
            {c: "Int32" for c in ("ar", "diff", "ma", "season_ar", "season_diff", "season_ma")}
        )

    return fit_and_forecast(ys)
