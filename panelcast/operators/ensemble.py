"""A weighted mean of several models, weighted per series by rolling-origin backtests.

The backtests are further array columns of the row of a series: prefixes that end
at earlier origins, the members' forecasts from there, and the values that came.
Weights are least squares without negative ones. Nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.vectors import unfold
from panelcast.spec import PanelSpec

MOST_MEMBERS = 8


def nonnegative_weights(gram: np.ndarray, cross: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Weights (series, members) of least squared error, none below 0.

    Every set of members is solved without a bound; the best of those whose
    weights are all above 0 is the solution, as the weights it leaves out would
    only be better below 0. Equal weights where no member helps.
    """
    members = gram.shape[1]
    best, out = power.copy(), np.full((len(gram), members), 0.0)
    for size in range(1, members + 1):
        for use in combinations(range(members), size):
            part = gram[:, use][:, :, use]
            inverse = np.linalg.pinv(part, rcond=members * np.finfo(float).eps, hermitian=True)
            weights = (inverse @ cross[:, use, None])[..., 0]
            error = power - 2 * (weights * cross[:, use]).sum(axis=1) + np.einsum("si,sij,sj->s", weights, part, weights)
            better = (weights > 0).all(axis=1) & (error < best - 1e-9 * power)
            best[better] = error[better]
            out[better] = 0.0
            for j, m in enumerate(use):
                out[better, m] = weights[better, j]
    out[out.sum(axis=1) == 0] = 1 / members
    return out


@dataclass(frozen=True)
class Ensemble:
    """``members`` weighted by their forecasts of ``horizon`` steps from ``origins`` earlier points in time."""

    model_id: str
    members: tuple
    origins: int = 3
    horizon: int = 21

    def __post_init__(self) -> None:
        if not 2 <= len(self.members) <= MOST_MEMBERS:
            raise ValueError(f"an ensemble has 2 to {MOST_MEMBERS} members")
        if self.origins < 1 or self.horizon < 1:
            raise ValueError("origins and horizon must be 1 or more")
        if any(hasattr(m, "fit") for m in self.members):
            raise ValueError("models that train over all series cannot be members")

    @property
    def min_length(self) -> int:
        return max(m.min_length for m in self.members) + self.origins * self.horizon

    def weighted(self, df: DataFrame, spec: PanelSpec, ys: str, start: str, out: str) -> DataFrame:
        """Add ``out``, an array of one weight per member; null for short series."""
        long_enough, used = F.size(ys) >= self.min_length, []
        for j in range(1, self.origins + 1):
            known, came = f"{out}_known{j}", f"{out}_came{j}"
            n = F.greatest(F.size(ys) - j * self.horizon, F.lit(0))
            df = df.withColumns(
                {known: F.when(long_enough, F.slice(ys, F.lit(1), n)), came: F.when(long_enough, F.slice(ys, n + 1, F.lit(self.horizon)))}
            )
            used += [known, came]
            for i, member in enumerate(self.members):
                df = member.attach(df, spec, known, start, self.horizon, f"{out}_from{j}_{i}")
                used += [c for c in (f"{out}_from{j}_{i}", f"{out}_from{j}_{i}_error") if c in df.columns]
        origins = range(1, self.origins + 1)
        actual = F.concat(*[f"{out}_came{j}" for j in origins])
        made = [F.concat(*[f"{out}_from{j}_{i}" for j in origins]) for i in range(len(self.members))]
        return df.withColumn(out, F.when(whole([c for c in used if "_error" not in c]), solved(actual, *made))).drop(*used)

    def attach(self, df: DataFrame, spec: PanelSpec, ys: str, start: str, steps: int, out: str) -> DataFrame:
        weights = f"{out}_weights"
        df = self.weighted(df, spec, ys, start, weights)
        parts = [f"{out}_member{i}" for i in range(len(self.members))]
        errors = []
        for part, member in zip(parts, self.members):
            df = member.attach(df, spec, ys, start, steps, part)
            errors += [c for c in (f"{part}_error",) if c in df.columns]

        return df.withColumn(out, F.when(whole([weights, *parts]), mixed(F.col(weights), *map(F.col, parts)))).drop(weights, *parts, *errors)


def whole(columns: list[str]) -> Column:
    """Whether no column is null.

    Naming every column a second time also keeps Spark from folding the
    members' expressions into the arguments of a Python function, which it
    cannot take apart where they hold a lambda inside a lambda.
    """
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def mixed(weights: Column, *parts: Column) -> Column:
    """The arrays ``parts`` added up by weight; null where one is null.

    In Python like the weights: Python results cannot stand inside a lambda of an expression.
    """

    @F.pandas_udf("array<double>")
    def mix(weights: pd.Series, *arrays: pd.Series) -> pd.Series:
        rows = zip(weights, zip(*arrays))
        return pd.Series([None if w is None or any(a is None for a in own) else w @ np.array(own, dtype=float) for w, own in rows], dtype=object)

    return mix(weights, *parts)


def solved(actual: Column, *made: Column) -> Column:
    """Weights of the arrays ``made`` that come nearest to ``actual``; null where one is null."""

    @F.pandas_udf("array<double>")
    def solve(*arrays: pd.Series) -> pd.Series:
        result = pd.Series([None] * len(arrays[0]), dtype=object)
        whole = [i for i in range(len(result)) if all(a.iloc[i] is not None for a in arrays)]
        if whole:
            y, *parts = (np.array([a.iloc[i] for i in whole], dtype=float) for a in arrays)
            x = np.stack(parts, axis=1)
            weights = nonnegative_weights(x @ x.transpose(0, 2, 1), (x @ y[..., None])[..., 0], (y * y).sum(axis=1))
            for i, w in zip(whole, weights):
                result.iloc[i] = w
        return result

    return solve(actual, *made)


def ensemble_weights(hist: DataFrame, spec: PanelSpec, model: Ensemble) -> DataFrame:
    """Rows ``keys…, member, weight`` for every series that is long enough."""
    found = model.weighted(hist, spec, "ys", "start", "weights")
    names = F.array(*[F.lit(m.model_id) for m in model.members])
    pairs = F.arrays_zip(names.alias("member"), F.col("weights").alias("weight"))
    rows = found.select(*spec.keys, unfold(pairs).alias("w")).select(*spec.keys, F.col("w.member"), F.col("w.weight"))
    return rows.filter("weight IS NOT NULL")
