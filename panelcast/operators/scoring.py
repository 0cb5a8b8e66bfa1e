"""Score forecasts on test days, choose the best model per series, keep its forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.metrics import Metric, RowResiduals, resolve
from panelcast.spec import PanelSpec


def same_series(left: DataFrame, right: DataFrame, on: Sequence[str], keys: Sequence[str], null_keys: bool = True) -> DataFrame:
    """Inner join on ``on``; a null in one of the series ``keys`` is a key like any other.

    Tables bucketed on the keys join without a shuffle only by plain equality,
    so a caller that knows of no null keys may say so.
    """
    if not null_keys:
        return left.join(right, list(on), "inner")
    renamed = right.withColumnsRenamed({c: f"__{c}" for c in on})
    match = F.lit(True)
    for c in on:
        match = match & (F.col(c).eqNullSafe(F.col(f"__{c}")) if c in keys else F.col(c) == F.col(f"__{c}"))
    return left.join(renamed, match, "inner").drop(*[f"__{c}" for c in on])


def series_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_keys: bool = True) -> DataFrame:
    """Join of any kind on the series ``keys``, with the columns of ``left`` and the others of ``right``."""
    if not null_keys:
        return left.join(right, list(keys), how)
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(renamed, match, how).drop(*[f"__{k}" for k in keys])


def score_join(test: DataFrame, forecast: DataFrame, spec: PanelSpec, null_keys: bool = True) -> DataFrame:
    """Actual and ``prediction`` side by side for the days both frames have."""
    predicted = forecast.select("model", *spec.keys, spec.time, F.col(spec.value).alias("prediction"))
    actual = test.select(*spec.columns)
    return same_series(actual, predicted, [*spec.keys, spec.time], spec.keys, null_keys)


def fully_scored(joined: DataFrame, test: DataFrame, spec: PanelSpec, null_keys: bool = True) -> DataFrame:
    """The rows of ``joined`` whose (model, series) covers every test day of the series.

    Forecasts left over from a run with other days reach a part of them at most.
    """
    wanted = test.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("__days"))
    found = joined.groupBy("model", *spec.keys).agg(F.count(F.lit(1)).alias("__n"))
    short = same_series(found, wanted, spec.keys, spec.keys, null_keys).filter("__n < __days")
    keys = ["model", *spec.keys]
    match = F.lit(True)
    for c in keys:
        match = match & (joined[c].eqNullSafe(short[c]) if null_keys else joined[c] == short[c])
    return joined.join(short.select(*keys), match if null_keys else keys, "left_anti")


def metrics_wide(joined: DataFrame, spec: PanelSpec, metrics: Sequence[str | Metric]) -> DataFrame:
    """One row per (model, series) with a column per metric."""
    r = RowResiduals(F.col(spec.value), F.col("prediction"), F.col(spec.time))
    columns = [metric(r).alias(name) for name, metric in resolve(list(metrics)).items()]
    return joined.groupBy("model", *spec.keys).agg(*columns)


def coverage(joined: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per (model, series): days scored, and how many of them have a zero actual."""
    return joined.groupBy("model", *spec.keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(spec.value) == 0).alias("n_zero")
    )


def metrics_long(joined: DataFrame, spec: PanelSpec, metrics: Sequence[str | Metric] = ("rmse", "mae", "mape")) -> DataFrame:
    """Rows ``model, keys…, metric, value``; an undefined metric has a null value."""
    names = list(resolve(list(metrics)))
    wide = metrics_wide(joined, spec, metrics)
    return wide.unpivot(["model", *spec.keys], names, "metric", "value")


def defined(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def best_model(metrics: DataFrame, spec: PanelSpec, select_on: str = "mape") -> DataFrame:
    """The row of the lowest ``select_on`` per series; ties go to the first model name.

    Errors are compared to nine decimals, as sums differ beyond them with the
    order of addition. Undefined values cannot win, and a series that has no
    other gets no row.
    """
    return (
        metrics.filter((F.col("metric") == select_on) & defined(F.col("value")))
        .groupBy(*spec.keys)
        .agg(F.min(F.struct(F.round("value", 9).alias("rank"), "model", "value")).alias("best"))
        .select("best.model", *spec.keys, F.lit(select_on).alias("metric"), "best.value")
    )


def champion_mean_error(best: DataFrame) -> DataFrame:
    """Mean error of the chosen models over all series, as one row."""
    return best.agg(F.avg("value").alias("mean_error"), F.count("value").alias("n_series"))


def champion_forecast(forecasts: DataFrame, best: DataFrame, spec: PanelSpec, null_keys: bool = True) -> DataFrame:
    """The forecast rows of the chosen model of each series.

    The chosen models grow with the number of series, so the join carries no
    broadcast hint; Spark decides from the measured size.
    """
    chosen = best.select("model", *spec.keys)
    return same_series(forecasts, chosen, ["model", *spec.keys], spec.keys, null_keys).select(*forecasts.columns)
