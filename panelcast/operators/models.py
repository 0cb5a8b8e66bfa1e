"""Forecast models by name, and the frames they produce.

A model adds one array column of forecasts to a frame with one row per series.
Several models therefore share one pass over the series, and neither fitting
nor forecasting shuffles anything.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any, NamedTuple, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions import baselines, ets, kalman, waves
from panelcast.functions import theta as theta_kernel
from panelcast.functions.arima import ArimaSettings, arima
from panelcast.functions.regression import Decomposition, decomposed, decomposed_with, holiday_pairs
from panelcast.functions.smoothing import COARSE, FINE, holt_winters
from panelcast.functions.stacks import stacked, stacked_named
from panelcast.functions.trees import TreeSettings, boosting_settings, forest_settings, lag_trees
from panelcast.operators.ensemble import Ensemble
from panelcast.operators.trees import LagTrees, tree_model
from panelcast.operators.vectors import next_day, train_part, unfold, unroll
from panelcast.sources.spool import spool
from panelcast.spec import PanelSpec, positive


class Model(Protocol):
    """What the rest of the library needs from a model."""

    model_id: str
    min_length: int  # values a series needs; shorter ones get a null array

    def attach(self, df: DataFrame, spec: PanelSpec, ys: str, start: str, steps: int, out: str) -> DataFrame:
        """Add the array column ``out`` with ``steps`` forecasts after the values in ``ys``."""


@dataclass(frozen=True)
class ArrayModel:
    """A model that is one expression of (values, first day, steps, step length)."""

    model_id: str
    min_length: int
    forecast: Callable[[Column, Column, int, int], Column]

    def attach(self, df: DataFrame, spec: PanelSpec, ys: str, start: str, steps: int, out: str) -> DataFrame:
        ahead = self.forecast(F.col(ys), F.col(start), steps, spec.step_days)
        return df.withColumn(out, F.when(F.size(ys) >= self.min_length, ahead))


# ---------------------------------------------------------------------- plug-ins


@dataclass(frozen=True)
class Plugin:
    """A model from user code: ``factory(**params)`` with ``fit(series)`` and ``predict(n)``.

    ``fit`` receives a pandas Series of floats on a DatetimeIndex and
    ``predict`` returns ``n`` numbers. One object is made per series. With
    ``on_error="report"`` a failing series gets a null forecast and its error
    text instead of ending the job.
    """

    model_id: str
    factory: Callable[..., Any]
    params: tuple[tuple[str, Any], ...] = ()
    min_length: int = 1
    on_error: str = "raise"

    def __post_init__(self) -> None:
        if self.on_error not in ("raise", "report"):
            raise ValueError(f"on_error must be 'raise' or 'report', got {self.on_error!r}")

    def run(self, ys: Column, start: Column, steps: int, step_days: int) -> Column:
        """Struct column ``(values array<double>, error string)``."""
        factory, params, need, strict = self.factory, dict(self.params), self.min_length, self.on_error == "raise"

        def one(y: np.ndarray, first: Any) -> tuple[list[float] | None, str | None]:
            if y is None or len(y) < need:
                return None, f"needs {need} values"
            try:
                index = pd.date_range(first, periods=len(y), freq=pd.Timedelta(days=step_days))
                model = factory(**params)
                fitted = model.fit(pd.Series(np.array(y, dtype=float), index=index))
                values = np.asarray((model if fitted is None else fitted).predict(steps), dtype=float)
                if values.shape != (steps,):
                    raise ValueError(f"predict({steps}) returned shape {values.shape}")
                return values.tolist(), None
            except Exception as error:
                if strict:
                    raise
                return None, f"{type(error).__name__}: {error}"

        @F.pandas_udf("struct<values: array<double>, error: string>")
        def fit_and_forecast(batch: pd.Series, first: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([one(y, d) for y, d in zip(batch, first)], columns=["values", "error"])

        return fit_and_forecast(ys, start)

    def attach(self, df: DataFrame, spec: PanelSpec, ys: str, start: str, steps: int, out: str) -> DataFrame:
        """Also adds ``<out>_error``, null where the forecast succeeded."""
        ran = f"{out}_run"
        result = self.run(F.col(ys), F.col(start), steps, spec.step_days)
        return df.withColumn(ran, result).withColumns({out: F.col(ran)["values"], f"{out}_error": F.col(ran)["error"]}).drop(ran)


# ---------------------------------------------------------------------- registry


def _naive_mean() -> tuple[int, Callable]:
    return 1, lambda ys, start, h, step: baselines.naive_mean(ys, h)


def _naive_seasonal(K: int = 1) -> tuple[int, Callable]:
    positive("K", K)
    return K, lambda ys, start, h, step: baselines.naive_seasonal(ys, h, K)


def _naive_drift() -> tuple[int, Callable]:
    return 2, lambda ys, start, h, step: baselines.naive_drift(ys, h)


def _moving_average(input_chunk_length: int = 1) -> tuple[int, Callable]:
    k = positive("input_chunk_length", input_chunk_length)
    return k, lambda ys, start, h, step: baselines.naive_moving_average(ys, h, k)


def _croston(version: str = "classic", alpha_d: float = 0.1, alpha_p: float = 0.1) -> tuple[int, Callable]:
    if version not in baselines.CROSTON_VERSIONS:
        raise ValueError(f"Croston version must be one of {baselines.CROSTON_VERSIONS}, got {version!r}")
    return 1, lambda ys, start, h, step: baselines.croston(ys, h, version, alpha_d, alpha_p)


def _smoothing(
    seasonal_periods: int = 7, params: Sequence[float] | None = None, coarse: Sequence = COARSE, fine: Sequence = FINE
) -> tuple[int, Callable]:
    m = positive("seasonal_periods", seasonal_periods)
    return 2 * m, lambda ys, start, h, step: holt_winters(ys, h, m, params, coarse, fine)


def arima_settings(
    order: Sequence[int] | None = None, seasonal_order: Sequence[int] | None = None, information_criterion: str = "aicc", **tops: int
) -> ArimaSettings:
    """``max_p, max_q, max_d``, and with a season ``m`` also ``max_P, max_Q, max_D``; or the orders themselves."""
    fixed = {"order": order, "seasonal_order": seasonal_order}
    return ArimaSettings(criterion=information_criterion, **{k: None if v is None else tuple(v) for k, v in fixed.items()}, **tops)


def _auto_arima(**settings: Any) -> tuple[int, Callable]:
    chosen = arima_settings(**settings)
    return chosen.least_length, lambda ys, start, h, step: arima(ys, h, chosen)["values"]


def _arima(p: int = 12, d: int = 1, q: int = 0, seasonal_order: Sequence[int] | None = None, m: int = 1) -> tuple[int, Callable]:
    return _auto_arima(order=(p, d, q), seasonal_order=seasonal_order, m=m)


def _linear_lags(lags: int = 7) -> tuple[int, Callable]:
    return _auto_arima(order=(positive("lags", lags), 0, 0))


def _decomposed(holidays: Sequence | None = None, **settings: Any) -> tuple[int, Callable]:
    if "country_holidays" in settings:
        raise ValueError("no holiday calendar is built in: pass holidays=[(day, name), …] or holidays_column instead of country_holidays")
    model = Decomposition(holidays=holiday_pairs(holidays or ()), **settings)
    if column := model.holidays_column:
        return 2, lambda ys, start, h, step: decomposed_with(ys, start, F.col(column), h, step, model)
    return 2, lambda ys, start, h, step: decomposed(ys, start, h, step, model)


def _trees(settings: TreeSettings) -> tuple[int, Callable]:
    return settings.lags + 1, lambda ys, start, h, step: lag_trees(ys, h, settings)


def _boosted_trees(**settings: Any) -> tuple[int, Callable]:
    return _trees(boosting_settings(settings))


def _forest(**settings: Any) -> tuple[int, Callable]:
    return _trees(forest_settings(settings))


def _listed(value: Any) -> tuple:
    return tuple(value) if isinstance(value, (list, tuple)) else (value,)


def theta_settings(theta: float | Sequence[float] = 2.0, seasonality_period: int | None = 7, **settings: Any) -> theta_kernel.ThetaSettings:
    """One theta or several, ``trend_mode`` and ``model_mode`` likewise; of several forms the best is taken per series."""
    lists = {f"{name}s": _listed(settings.pop(name)) for name in ("trend_mode", "model_mode") if name in settings}
    return theta_kernel.ThetaSettings(thetas=_listed(theta), season=seasonality_period or 1, **lists, **settings)


def _theta_model(**settings: Any) -> tuple[int, Callable]:
    s = theta_settings(**settings)
    width = 2 + len(s.alphas)
    return s.least_length, lambda ys, start, h, step: stacked_named(ys, s.least_length, lambda y: theta_kernel.forecast_block(y, h, s), width)["values"]


# What FourTheta chooses from unless settings say otherwise.
FOUR_THETA = {"theta": (1.0, 2.0, 3.0), "trend_mode": ("linear", "exponential"), "model_mode": ("additive", "multiplicative")}


def _four_theta(**settings: Any) -> tuple[int, Callable]:
    return _theta_model(**(FOUR_THETA | settings))


def ets_settings(seasonal_periods: int | None = 7, forms: Sequence[str] = (), weights: Sequence[float] | None = None, refine: bool = True) -> ets.EtsSettings:
    return ets.EtsSettings(seasonal_periods or 1, tuple(forms), None if weights is None else tuple(weights), refine)


def _auto_ets(**settings: Any) -> tuple[int, Callable]:
    s = ets_settings(**settings)
    return s.least_length, lambda ys, start, h, step: stacked_named(ys, s.least_length, lambda y: ets.forecast_block(y, h, s), ETS_WIDTH)["values"]


def _kalman(trend: bool = False, rounds: int = 10, noise: Sequence[float] | None = None, zeros_missing: bool = False) -> tuple[int, Callable]:
    s = kalman.KalmanSettings(trend, rounds, None if noise is None else tuple(noise), zeros_missing)
    return 3, lambda ys, start, h, step: stacked(ys, 3, lambda y: kalman.forecast_block(y, h, s), 16 * s.size**2)


def _waves(nr_freqs_to_keep: int = 10, trend_poly_degree: int = 1) -> tuple[int, Callable]:
    s = waves.WaveSettings(nr_freqs_to_keep, trend_poly_degree)
    return s.least_length, lambda ys, start, h, step: stacked(ys, s.least_length, lambda y: waves.strongest_waves(y, h, s), 8)


def _complex(weights: Sequence[float] | None = None, **grid: Sequence[float]) -> tuple[int, Callable]:
    s = waves.ComplexSettings(None if weights is None else tuple(weights), **{k: tuple(v) for k, v in grid.items()})
    return 3, lambda ys, start, h, step: stacked(ys, 3, lambda y: waves.complex_smoothing(y, h, s))


def _ensemble(model_id: str, forecasting_models: Sequence = (), origins: int = 3, horizon: int = 21) -> Ensemble:
    """Members are models, or names, or pairs of a name and its settings."""
    made = [make_model(m) if isinstance(m, str) else make_model(*m) if isinstance(m, (tuple, list)) else m for m in forecasting_models]
    return Ensemble(model_id, tuple(distinct_ids(made)), positive("origins", origins), positive("horizon", horizon))


ETS_WIDTH = 64  # candidate weights that are carried side by side, for the size of a stack

# Public names of the models, and settings that only steer local threads or optimisers.
ARRAY_MODELS: dict[str, Callable[..., tuple[int, Callable]]] = {
    "NaiveMean": _naive_mean,
    "NaiveSeasonal": _naive_seasonal,
    "NaiveDrift": _naive_drift,
    "NaiveMovingAverage": _moving_average,
    "Croston": _croston,
    "ExponentialSmoothing": _smoothing,
    "ARIMA": _arima,
    "AutoARIMA": _auto_arima,
    "LinearRegressionModel": _linear_lags,
    "Prophet": _decomposed,
    "XGBModel": _boosted_trees,
    "RandomForest": _forest,
    "Theta": _theta_model,
    "FourTheta": _four_theta,
    "AutoETS": _auto_ets,
    "KalmanForecaster": _kalman,
    "FFT": _waves,
    "AutoCES": _complex,
}
COMBINED_MODELS = ("RegressionEnsembleModel",)
POOLED_MODELS = ("PooledXGBModel", "PooledRandomForest")
THREADS = {"nthread", "n_jobs"}
DROPPED_SETTINGS = {"AutoARIMA": {"maxiter"}} | {name: THREADS for name in ("XGBModel", "RandomForest", *POOLED_MODELS)}


# Settings of usual configurations that have no counterpart here.
UNSUPPORTED = {"PooledXGBModel": {"lambda", "alpha"}, "Prophet": {"country_holidays"}}


def dropped_settings(model: str, params: dict | None) -> list[str]:
    """The settings that ``unsupported="drop"`` leaves out."""
    return sorted(UNSUPPORTED.get(model, set()) & set(params or {}))


def model_names() -> list[str]:
    return sorted([*ARRAY_MODELS, *COMBINED_MODELS, *POOLED_MODELS])


def make_model(
    model: str | Callable[..., Any], params: dict | None = None, model_id: str | None = None, unsupported: str = "raise"
) -> Model:
    """A model from its name, or a plug-in from a class with ``fit`` and ``predict``.

    ``model_id`` names the results and defaults to the name, so two settings of
    one model can run side by side under different ids. Settings without a
    counterpart here are errors; with ``unsupported="drop"`` those of
    ``UNSUPPORTED`` are left out, and ``dropped_settings`` names them.
    """
    if unsupported not in ("raise", "drop"):
        raise ValueError(f"unsupported must be 'raise' or 'drop', got {unsupported!r}")
    params = dict(params or {})
    if unsupported == "drop" and isinstance(model, str):
        for name in dropped_settings(model, params):
            params.pop(name)
    if not isinstance(model, str):
        return Plugin(model_id or getattr(model, "__name__", type(model).__name__), model, tuple(params.items()))
    if model not in model_names():
        raise ValueError(f"unknown model {model!r}; known: {', '.join(model_names())}")
    for name in DROPPED_SETTINGS.get(model, ()):
        params.pop(name, None)
    if model in POOLED_MODELS:
        return tree_model(model.removeprefix("Pooled"), params, model_id or model)
    try:
        if model in COMBINED_MODELS:
            return _ensemble(model_id or model, **params)
        min_length, forecast = ARRAY_MODELS[model](**params)
    except TypeError as error:
        raise ValueError(f"bad settings for {model}: {error}") from None
    return ArrayModel(model_id or model, min_length, forecast)


def least_lengths(models: Sequence[Model]) -> dict[str, int]:
    """Values that a series needs for each model."""
    return {m.model_id: m.min_length for m in distinct_ids(models)}


def distinct_ids(models: Sequence[Model]) -> Sequence[Model]:
    ids = [m.model_id for m in models]
    if not ids or len(set(ids)) != len(ids):
        raise ValueError(f"models need distinct ids, got {ids}")
    return models


# ------------------------------------------------------------------------ frames


class Fit(NamedTuple):
    """One model, the array column it learns from, its number of steps and its result column."""

    model: Model
    ys: str
    steps: int
    out: str


def attach_all(df: DataFrame, spec: PanelSpec, fits: Sequence[Fit]) -> DataFrame:
    """Add the result columns of several fits.

    Models that train over the whole frame read it several times and predict
    step by step, so the frame is written out before them and after them;
    all the others follow as expressions on the stored rows.
    """
    pooled = [fit for fit in fits if isinstance(fit.model, LagTrees)]
    if pooled:
        df = stored = spool(df)
        for model, ys, steps, out in pooled:
            df = model.fit(stored, ys).attach(df, spec, ys, "start", steps, out)
        df = spool(df)
    for model, ys, steps, out in fits:
        if not isinstance(model, LagTrees):
            df = model.attach(df, spec, ys, "start", steps, out)
    return df


def history(vectors: DataFrame, spec: PanelSpec, which: str, carry: Sequence[str] = ()) -> DataFrame:
    """``keys…, start, ys, carry…`` with the training values (``train``) or all of them (``full``)."""
    if which not in ("train", "full"):
        raise ValueError(f"history must be 'train' or 'full', got {which!r}")
    ys = train_part() if which == "train" else F.col("ys")
    return vectors.select(*spec.keys, "start", ys.alias("ys"), *carry).filter(F.size("ys") > 0)


def forecast_arrays(hist: DataFrame, spec: PanelSpec, models: Sequence[Model], steps: int) -> DataFrame:
    """One row per (model, series): ``model, keys…, first, forecast``.

    Series too short for a model have no row for it.
    """
    positive("steps", steps)
    df = attach_all(hist, spec, [Fit(m, "ys", steps, f"f{i}") for i, m in enumerate(distinct_ids(models))])
    runs = [F.struct(F.lit(m.model_id).alias("model"), F.col(f"f{i}").alias("forecast")) for i, m in enumerate(models)]
    return (
        df.select(*spec.keys, next_day(F.col("start"), F.col("ys"), spec.step_days).alias("first"), unfold(F.array(*runs)).alias("run"))
        .select("run.model", *spec.keys, "first", "run.forecast")
        .filter(F.col("forecast").isNotNull())
    )


def forecast_rows(hist: DataFrame, spec: PanelSpec, models: Sequence[Model], steps: int) -> DataFrame:
    """Long forecasts ``model, keys…, time, value``, ``steps`` rows per (model, series)."""
    return unroll(forecast_arrays(hist, spec, models, steps), spec, "first", "forecast", "model")


def arima_orders(hist: DataFrame, spec: PanelSpec, settings: dict | None = None) -> DataFrame:
    """The orders that ``AutoARIMA`` chooses: ``keys…, ar, diff, ma, season_ar, season_diff, season_ma``, null for short series."""
    found = hist.select(*spec.keys, arima(F.col("ys"), 1, arima_settings(**(settings or {}))).alias("run"))
    return found.select(*spec.keys, *[f"run.{c}" for c in ("ar", "diff", "ma", "season_ar", "season_diff", "season_ma")])


def chosen_forms(hist: DataFrame, spec: PanelSpec, model: str, settings: dict | None = None) -> DataFrame:
    """The form that ``AutoETS``, ``Theta`` or ``FourTheta`` gives each series: ``keys…, form``, null for short series."""
    if model == "AutoETS":
        s = ets_settings(**(settings or {}))
        run = stacked_named(F.col("ys"), s.least_length, lambda y: ets.forecast_block(y, 1, s), ETS_WIDTH)
    elif model in ("Theta", "FourTheta"):
        s = theta_settings(**((FOUR_THETA if model == "FourTheta" else {}) | (settings or {})))
        run = stacked_named(F.col("ys"), s.least_length, lambda y: theta_kernel.forecast_block(y, 1, s), 2 + len(s.alphas))
    else:
        raise ValueError(f"{model!r} has no forms to choose from")
    return hist.select(*spec.keys, run["name"].alias("form"))


def plugin_report(hist: DataFrame, spec: PanelSpec, plugin: Plugin, steps: int) -> DataFrame:
    """One row per series: ``keys…, forecast, error``."""
    ran = plugin.attach(hist, spec, "ys", "start", steps, "forecast")
    return ran.select(*spec.keys, "forecast", F.col("forecast_error").alias("error"))
