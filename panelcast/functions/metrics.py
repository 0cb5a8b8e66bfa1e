"""Error metrics, each written once and evaluated over rows or over arrays.

A metric is a function of a ``Residuals`` object, which can count, sum and
average an expression of (actual, predicted). ``RowResiduals`` turns these into
aggregates of a grouped frame, ``ArrayResiduals`` into folds over two array
columns of one row, so the same metric serves joined tables and series arrays.
Undefined metrics are null.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Term = Callable[[Column, Column], Column]


class Residuals(Protocol):
    def total(self, term: Term) -> Column:
        """Sum of a term; null terms do not count."""

    def count(self, condition: Term) -> Column:
        """Number of points that satisfy a condition."""

    def variation(self, term: Term) -> Column:
        """Sum of squared deviations of a term from its mean, from the mean first; null terms do not count."""

    def extent(self, term: Term) -> Column:
        """Largest minus smallest value of a term; null terms do not count."""

    def warped(self) -> Column:
        """Mean absolute error along the cheapest warping path of the two courses."""

    def apply(self, function: Callable[[pd.Series, pd.Series], float]) -> Column:
        """Result of Python code over all points."""


@dataclass(frozen=True)
class RowResiduals:
    """Points in the rows of a group; ``order`` is their day."""

    actual: Column
    predicted: Column
    order: Column

    def total(self, term: Term) -> Column:
        return F.sum(term(self.actual, self.predicted))

    def count(self, condition: Term) -> Column:
        return F.count_if(condition(self.actual, self.predicted))

    def variation(self, term: Term) -> Column:
        value = term(self.actual, self.predicted)
        return F.var_pop(value) * F.count(value)

    def extent(self, term: Term) -> Column:
        value = term(self.actual, self.predicted)
        return F.max(value) - F.min(value)

    def gathered(self) -> ArrayResiduals:
        # A group holds one horizon of points, so it may be gathered; a grouped
        # Python aggregate could not stand next to the built-in ones.
        point = F.struct(self.order.alias("t"), self.actual.alias("y"), self.predicted.alias("p"))
        points = F.sort_array(F.collect_list(point))
        return ArrayResiduals(F.transform(points, lambda c: c["y"]), F.transform(points, lambda c: c["p"]))

    def warped(self) -> Column:
        return self.gathered().warped()

    def apply(self, function: Callable[[pd.Series, pd.Series], float]) -> Column:
        return self.gathered().apply(function)


@dataclass(frozen=True)
class ArrayResiduals:
    """Points in two arrays of equal length."""

    actual: Column
    predicted: Column

    def total(self, term: Term) -> Column:
        terms = F.zip_with(self.actual, self.predicted, term)
        return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))

    def count(self, condition: Term) -> Column:
        hits = F.filter(F.zip_with(self.actual, self.predicted, condition), lambda hit: hit)
        return F.size(hits).cast("bigint")

    def _values(self, term: Term) -> Column:
        return F.filter(F.zip_with(self.actual, self.predicted, term), lambda x: x.isNotNull())

    def variation(self, term: Term) -> Column:
        def squares(points: Column) -> Column:
            n = F.nullif(F.size(points), F.lit(0))
            mean = F.aggregate(points, F.lit(0.0), lambda acc, x: acc + x) / n
            return F.aggregate(points, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean))

        return squares(self._values(term))

    def extent(self, term: Term) -> Column:
        values = self._values(term)
        return F.array_max(values) - F.array_min(values)

    def warped(self) -> Column:
        """Row by row through the table of path costs; a cell is (cost, steps of the path), the least of its three ways in."""
        pairs = F.filter(F.arrays_zip(self.actual.alias("y"), self.predicted.alias("p")), lambda c: every(c["y"], c["p"]))

        def cell(cost: Column, steps: Column) -> Column:
            return F.struct(cost.cast("double").alias("cost"), steps.cast("int").alias("steps"))

        def way(points: Column) -> Column:
            none = cell(F.lit(float("inf")), F.lit(0))
            columns = F.sequence(F.lit(1), F.size(points))
            first = F.concat(F.array(cell(F.lit(0), F.lit(0))), F.array_repeat(none, F.size(points)))

            def next_row(above: Column, here: Column) -> Column:
                def next_cell(row: Column, j: Column) -> Column:
                    before = F.array_min(F.array(F.get(row, j - 1), F.get(above, j), F.get(above, j - 1)))
                    cost = before["cost"] + F.abs(here["y"] - F.get(points, j - 1)["p"])
                    return F.concat(row, F.array(cell(cost, before["steps"] + 1)))

                return F.aggregate(columns, F.array(none), next_cell)

            last = F.element_at(F.aggregate(points, first, next_row), -1)
            return last["cost"] / last["steps"]

        return F.when(F.size(pairs) > 0, way(pairs))

    def apply(self, function: Callable[[pd.Series, pd.Series], float]) -> Column:
        @F.pandas_udf("double")
        def evaluate(ys: pd.Series, ps: pd.Series) -> pd.Series:
            return pd.Series(
                [None if p is None or not len(p) else float(function(pd.Series(y), pd.Series(p))) for y, p in zip(ys, ps)],
                dtype="float64",
            )

        return evaluate(self.actual, self.predicted)


def every(y: Column, p: Column) -> Column:
    return y.isNotNull() & p.isNotNull()


def squared(y: Column, p: Column) -> Column:
    return (y - p) * (y - p)


def mean_of(r: Residuals, term: Term, where: Term = every) -> Column:
    """Mean of a term over the points that satisfy ``where``; null when there are none."""
    n = r.count(where)
    return F.when(n > 0, r.total(lambda y, p: F.when(where(y, p), term(y, p))) / n)


def mse(r: Residuals) -> Column:
    return mean_of(r, squared)


def rmse(r: Residuals) -> Column:
    return F.sqrt(mse(r))


def mae(r: Residuals) -> Column:
    return mean_of(r, lambda y, p: F.abs(y - p))


def mape(r: Residuals) -> Column:
    """Mean absolute error in percent of the actual, over the non-zero actuals."""
    return 100.0 * mean_of(r, lambda y, p: F.abs((y - p) / y), lambda y, p: every(y, p) & (y != 0))


def mape_eps(epsilon: float = 0.0) -> Callable[[Residuals], Column]:
    """Mean of ``|y - p| / (y + epsilon)``, a fraction; points with a zero divisor do not count."""

    def mape_eps(r: Residuals) -> Column:
        return mean_of(
            r,
            lambda y, p: F.abs(y - p) / (y + F.lit(float(epsilon))),
            lambda y, p: every(y, p) & (y + F.lit(float(epsilon)) != 0),
        )

    return mape_eps


def smape(r: Residuals) -> Column:
    """Symmetric percentage error, 0 to 200; points where both are 0 do not count."""
    return 200.0 * mean_of(
        r, lambda y, p: F.abs(y - p) / (F.abs(y) + F.abs(p)), lambda y, p: F.abs(y) + F.abs(p) > 0
    )


def bias(r: Residuals) -> Column:
    """Mean of predicted minus actual."""
    return mean_of(r, lambda y, p: p - y)


def ope(r: Residuals) -> Column:
    """Overall error in percent: difference of the sums over the sum of the actuals."""
    total = r.total(lambda y, p: F.when(every(y, p), y))
    return 100.0 * F.abs((total - r.total(lambda y, p: F.when(every(y, p), p))) / F.nullif(total, F.lit(0.0)))


def marre(r: Residuals) -> Column:
    """Mean absolute error in percent of the range of the actuals; null when they do not vary."""
    extent = r.extent(lambda y, p: F.when(every(y, p), y))
    return 100.0 * mae(r) / F.nullif(extent, F.lit(0.0))


def r2(r: Residuals) -> Column:
    """Share of the variance explained; null when the actuals do not vary."""
    spread = r.variation(lambda y, p: F.when(every(y, p), y))
    return F.when(spread > 0, 1.0 - r.total(squared) / spread)


def rmsle(r: Residuals) -> Column:
    """Root mean squared error of ``log(1 + value)``; null when a value is -1 or less."""
    usable = r.count(lambda y, p: (y <= -1) | (p <= -1)) == 0
    return F.when(usable, F.sqrt(mean_of(r, lambda y, p: squared(F.log1p(y), F.log1p(p)))))


def cv(r: Residuals) -> Column:
    """Root mean squared error in percent of the mean actual."""
    return 100.0 * rmse(r) / F.nullif(mean_of(r, lambda y, p: y), F.lit(0.0))


def dtw_metric(r: Residuals) -> Column:
    """Mean absolute error along the cheapest warping path, the shortest of equal ones; the days must be in order."""
    return r.warped()


Metric = Callable[[Residuals], Column]

METRICS: dict[str, Metric] = {
    "rmse": rmse,
    "mae": mae,
    "mape": mape,
    "mse": mse,
    "smape": smape,
    "bias": bias,
    "ope": ope,
    "rmsle": rmsle,
    "r2": r2,
    "r2_score": r2,
    "coefficient_of_variation": cv,
    "marre": marre,
    "dtw_metric": dtw_metric,
}


def python_metric(function: Callable[[pd.Series, pd.Series], float]) -> Metric:
    """A metric from Python code on (actual, predicted); slower than an expression."""

    def metric(r: Residuals) -> Column:
        return r.apply(function)

    metric.__name__ = function.__name__
    metric.in_python = True
    return metric


def resolve(metrics: list[str | Metric]) -> dict[str, Metric]:
    """Metrics by name, from known names and metric functions."""
    found: dict[str, Metric] = {}
    for metric in metrics:
        name = metric if isinstance(metric, str) else metric.__name__
        if isinstance(metric, str) and metric not in METRICS:
            raise ValueError(f"unknown metric {metric!r}; known: {', '.join(sorted(METRICS))}")
        if name in found:
            raise ValueError(f"metric {name!r} is given twice")
        found[name] = METRICS[metric] if isinstance(metric, str) else metric
    if not found:
        raise ValueError("at least one metric is needed")
    return found
