"""Trend-and-season decomposition by penalised least squares.

Spark gathers and spreads the series; what runs in a Python worker is a small
dense solve per series, fed by Arrow batches of arrays.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = date(1970, 1, 1)
YEAR_DAYS = 365.25


# ---------------------------------------------------------------- decomposition


@dataclass(frozen=True)
class Decomposition:
    """Additive trend, season and holiday effects (Taylor and Letham 2018), by ridge.

    The trend bends at ``n_changepoints`` points in the first
    ``changepoint_range`` of the series. Each prior scale sets how far its
    coefficients may move; an infinite one turns the penalty off.
    ``"auto"`` asks for two weeks of history for the weekly and 730 days for
    the yearly pattern. ``holidays`` holds (day, name) pairs, each name getting
    one effect of its own, and must reach into the forecast days to matter there.
    ``holidays_column`` names an array column of such pairs, so that every series
    has its own; each name is an effect of the series that has it.
    """

    growth: str = "linear"
    n_changepoints: int = 25
    changepoint_range: float = 0.8
    weekly: bool | str = "auto"
    yearly: bool | str = "auto"
    weekly_order: int = 3
    yearly_order: int = 10
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    holidays_prior_scale: float = 10.0
    noise_scale: float = 0.1
    holidays: tuple[tuple[date, str], ...] = field(default=())
    holidays_column: str | None = None

    def __post_init__(self) -> None:
        if self.growth not in ("linear", "flat"):
            raise ValueError(f"growth must be 'linear' or 'flat', got {self.growth!r}")

    def design(self, day: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Columns for epoch days ``day``, of which the first ``n`` are history, and their penalties."""
        span = max(day[n - 1] - day[0], 1)
        u = (day - day[0]) / span
        columns, penalties = [np.ones_like(u)], [0.0]

        def add(column: np.ndarray, scale: float | None) -> None:
            columns.append(column)
            penalties.append(0.0 if scale is None else (self.noise_scale / scale) ** 2)

        if self.growth == "linear":
            add(u, None)
            bends = min(self.n_changepoints, max(int(n * self.changepoint_range) - 1, 0))
            for c in np.linspace(0, self.changepoint_range, bends + 1)[1:]:
                add(np.maximum(u - c, 0.0), self.changepoint_prior_scale)
        seasons = [(self.weekly, 7.0, self.weekly_order, 14), (self.yearly, YEAR_DAYS, self.yearly_order, 730)]
        for wanted, period, order, enough in seasons:
            if wanted is True or (wanted == "auto" and span >= enough):
                for k in range(1, order + 1):
                    angle = 2 * np.pi * k * day / period
                    add(np.sin(angle), self.seasonality_prior_scale)
                    add(np.cos(angle), self.seasonality_prior_scale)
        for name in sorted({name for _, name in self.holidays}):
            days = [(d - EPOCH).days for d, label in self.holidays if label == name]
            add(np.isin(day, days).astype(float), self.holidays_prior_scale)
        return np.column_stack(columns), np.array(penalties)

    def effects(self, first: int, n: int, step_days: int, days: list[list[tuple[int, str]]]) -> np.ndarray:
        """Columns (series, steps, names) that are 1 in the steps that hold a holiday; series with fewer names have columns of 0."""
        names = [sorted({name for _, name in own}) for own in days]
        out = np.zeros((len(days), n, max(map(len, names), default=0)))
        for i, own in enumerate(days):
            for day, name in own:
                at = (day - first) // step_days
                if 0 <= at < n:
                    out[i, at, names[i].index(name)] = 1.0
        return out

    def forecast_with(self, start: int, series: list[np.ndarray], days: list[list[tuple[int, str]]], steps: int, step_days: int) -> np.ndarray:
        """As ``forecast``, each series with holidays of its own, whose effects are solved together with all others."""
        n = len(series[0])
        x, penalty = self.design(start + step_days * np.arange(n + steps, dtype=float), n)
        own = self.effects(start, n + steps, step_days, days)
        y = np.array(series, dtype=float)
        scale = np.abs(y).max(axis=1, keepdims=True)
        scale[scale == 0] = 1.0
        whole = np.concatenate([np.broadcast_to(x, (len(y), *x.shape)), own], axis=2)
        history = whole[:, :n].transpose(0, 2, 1)
        ridge = np.concatenate([penalty, np.full(own.shape[2], (self.noise_scale / self.holidays_prior_scale) ** 2)])
        gram = history @ history.transpose(0, 2, 1) + np.diag(ridge)
        inverse = np.linalg.pinv(gram, rcond=gram.shape[-1] * np.finfo(float).eps, hermitian=True)
        coefficients = inverse @ (history @ (y / scale)[..., None])
        return (whole[:, n:] @ coefficients)[..., 0] * scale

    def forecast(self, start: int, series: list[np.ndarray], steps: int, step_days: int) -> np.ndarray:
        """Forecasts (series, steps) for series of one length that start on one epoch day."""
        n = len(series[0])
        day = start + step_days * np.arange(n + steps, dtype=float)
        x, penalty = self.design(day, n)
        history = x[:n]
        y = np.column_stack(series)
        scale = np.abs(y).max(axis=0)
        scale[scale == 0] = 1.0
        gram = history.T @ history + np.diag(penalty)
        coefficients = np.linalg.lstsq(gram, history.T @ (y / scale), rcond=None)[0]
        return (x[n:] @ coefficients * scale).T


def decomposed(ys: Column, start: Column, steps: int, step_days: int, model: Decomposition) -> Column:
    """Forecast array; series that share start and length share one factorised design."""

    @F.pandas_udf("array<double>")
    def fit_and_forecast(batch: pd.Series, first: pd.Series) -> pd.Series:
        result = pd.Series([None] * len(batch), dtype=object)
        alike: dict[tuple[int, int], list[int]] = {}
        for i, (y, d) in enumerate(zip(batch, first)):
            if y is not None and len(y) >= 2:
                alike.setdefault((int(d), len(y)), []).append(i)
        for (d, _), members in alike.items():
            ahead = model.forecast(d, [batch.iloc[i] for i in members], steps, step_days)
            for i, row in zip(members, ahead):
                result.iloc[i] = row
        return result

    return fit_and_forecast(ys, F.unix_date(start))


def decomposed_with(ys: Column, start: Column, holidays: Column, steps: int, step_days: int, model: Decomposition) -> Column:
    """Forecast array with each series' own holidays; series that share start and length share the other columns."""
    plain = F.transform(holidays, lambda h: F.struct(F.unix_date(h["day"]).alias("day"), h["name"].alias("name")))

    @F.pandas_udf("array<double>")
    def fit_and_forecast(batch: pd.Series, first: pd.Series, days: pd.Series) -> pd.Series:
        result = pd.Series([None] * len(batch), dtype=object)
        alike: dict[tuple[int, int], list[int]] = {}
        for i, (y, d) in enumerate(zip(batch, first)):
            if y is not None and len(y) >= 2:
                alike.setdefault((int(d), len(y)), []).append(i)
        for (d, n), members in alike.items():
            at_once = max(1, (1 << 22) // (80 * n))
            for lo in range(0, len(members), at_once):
                some = members[lo : lo + at_once]
                own = [[(int(h["day"]), h["name"]) for h in (days.iloc[i] if days.iloc[i] is not None else ())] for i in some]
                for i, row in zip(some, model.forecast_with(d, [batch.iloc[i] for i in some], own, steps, step_days)):
                    result.iloc[i] = row
        return result

    return fit_and_forecast(ys, F.unix_date(start), plain)


def holiday_pairs(holidays: Iterable[tuple[date, str]]) -> tuple[tuple[date, str], ...]:
    return tuple(sorted(set(holidays)))
