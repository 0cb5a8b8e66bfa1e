"""Forecast models written as Catalyst expressions over the array of a series.

Each function takes the array column and the number of steps and returns an
array column with that many forecasts. Nothing here leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(ys: Column) -> Column:
    return F.aggregate(ys, F.lit(0.0), lambda acc, y: acc + y)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it.

    A column inside a lambda is computed again for every element; a lambda
    variable is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def naive_mean(ys: Column, steps: int) -> Column:
    """The mean of all values, repeated."""
    return F.array_repeat(total(ys) / F.size(ys), steps)


def naive_seasonal(ys: Column, steps: int, k: int = 1) -> Column:
    """The last ``k`` values over and over; with ``k=1`` the last value."""
    turns = F.sequence(F.lit(0), F.lit(steps - 1))
    return bind(F.slice(ys, F.lit(-k), F.lit(k)), lambda recent: F.transform(turns, lambda i: F.get(recent, i % k)))


def naive_drift(ys: Column, steps: int) -> Column:
    """The straight line through the first and the last value, carried on."""
    first, last = F.get(ys, F.lit(0)), F.get(ys, F.size(ys) - 1)
    line = F.struct(last.alias("last"), ((last - first) / (F.size(ys) - 1)).alias("slope"))
    ahead = F.sequence(F.lit(1), F.lit(steps))
    return bind(line, lambda at: F.transform(ahead, lambda i: at["last"] + at["slope"] * i))


def moving_average_weights(k: int, steps: int) -> list[list[float]]:
    """Weights of the last ``k`` values in each step of the recursive mean.

    A step is the mean of the ``k`` values before it, forecasts included, so
    every forecast is a fixed linear mix of the ``k`` last observed values.
    """
    rows = [[float(i == j) for j in range(k)] for i in range(k)]
    for _ in range(steps):
        rows.append([sum(column) / k for column in zip(*rows[-k:])])
    return rows[k:]


def naive_moving_average(ys: Column, steps: int, input_chunk_length: int = 7) -> Column:
    """Each step is the mean of the last ``input_chunk_length`` values, forecasts included."""
    k = input_chunk_length
    rows = [", ".join(f"{w!r}D" for w in row) for row in moving_average_weights(k, steps)]
    weights = F.expr("array(" + ", ".join(f"array({row})" for row in rows) + ")")

    def mix(recent: Column) -> Column:
        return F.transform(weights, lambda w: total(F.zip_with(w, recent, lambda a, y: a * y)))

    return bind(F.slice(ys, F.lit(-k), F.lit(k)), mix)


# Names of the variants, and the range in which "optimized" looks for its weights.
CROSTON_VERSIONS = ("classic", "optimized", "sba", "tsb")
CROSTON_SEARCH = tuple(round(0.10 + 0.01 * i, 2) for i in range(21))


def croston(
    ys: Column,
    steps: int,
    version: str = "classic",
    alpha_d: float = 0.1,
    alpha_p: float = 0.1,
) -> Column:
    """Intermittent demand: smoothed demand size over smoothed demand interval.

    ``classic`` is Croston (1972), ``sba`` shrinks it by ``1 - alpha_p / 2``
    (Syntetos and Boylan 2005) and ``tsb`` smooths the demand probability of
    every period instead of the interval (Teunter et al. 2011). ``optimized``
    is the classic form with the two weights of least one-step error, each
    searched on a grid. A series that never had any demand is forecast as 0.
    """
    if version not in CROSTON_VERSIONS:
        raise ValueError(f"version must be one of {CROSTON_VERSIONS}, got {version!r}")
    sizes = F.filter(ys, lambda y: y != 0)
    at = F.filter(F.transform(ys, lambda y, i: F.when(y != 0, i + 1.0)), lambda i: i.isNotNull())
    gaps = bind(at, lambda a: F.zip_with(a, F.slice(F.concat(F.array(F.lit(0.0)), a), F.lit(1), F.size(a)), lambda i, j: i - j))
    if version == "tsb":
        hits = F.transform(ys, lambda y: F.when(y != 0, 1.0).otherwise(0.0))
        level = smoothed(sizes, alpha_d) * smoothed(hits, alpha_p)
    elif version == "optimized":
        level = best_smoothed(sizes) / best_smoothed(gaps)
    else:
        level = smoothed(sizes, alpha_d) / smoothed(gaps, alpha_p)
        level = level * (1 - alpha_p / 2) if version == "sba" else level
    return F.array_repeat(F.coalesce(level, F.lit(0.0)), steps)


def smoothed(values: Column, alpha: float) -> Column:
    """Simple exponential smoothing that starts from the first value; null for an empty array."""
    return F.aggregate(
        values,
        F.lit(None).cast("double"),
        lambda level, v: F.when(level.isNull(), v).otherwise(level + alpha * (v - level)),
    )


def best_smoothed(values: Column) -> Column:
    """The same with the weight of least squared one-step error."""
    start = F.struct(F.lit(0.0).alias("sse"), F.lit(None).cast("double").alias("level"))

    def fold(v: Column, alpha: Column) -> Column:
        return F.aggregate(
            v,
            start,
            lambda s, v: F.struct(
                (s["sse"] + F.coalesce((v - s["level"]) * (v - s["level"]), F.lit(0.0))).alias("sse"),
                F.coalesce(s["level"] + alpha * (v - s["level"]), v).alias("level"),
            ),
        )

    weights = F.expr("array(" + ", ".join(f"{a!r}D" for a in CROSTON_SEARCH) + ")")
    return bind(values, lambda v: F.array_min(F.transform(weights, lambda alpha: fold(v, alpha)))["level"])
