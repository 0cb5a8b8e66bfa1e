"""One boosted or bagged ensemble over the lag windows of all series, fitted by MLlib.

Each series is divided by the mean size of its own training values; this is the
form MLlib distributes, for many short series that are alike. (One ensemble per
series is in ``functions.trees``.) The forecast then feeds its own values back,
step by step, as a chain of narrow projections.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.baselines import total
from panelcast.sources.spool import spool
from panelcast.spec import PanelSpec, positive


@dataclass(frozen=True)
class LagTrees:
    """A pooled tree ensemble on the last ``lags`` values."""

    model_id: str
    make_estimator: Callable[[], GBTRegressor | RandomForestRegressor]  # needs a running session
    lags: int

    @property
    def min_length(self) -> int:
        return self.lags + 1

    def windows(self, df: DataFrame, ys: str) -> DataFrame:
        """Training rows ``features, label``: each value with the ``lags`` values before it."""
        n = self.lags
        ends = F.sequence(F.lit(n + 1), F.size(ys))
        return (
            df.filter(F.size(ys) >= self.min_length)
            .withColumn("unit", _unit(ys))
            .select(F.col(ys).alias("y"), "unit", F.explode(ends).alias("end"))
            .select(
                array_to_vector(F.transform(F.slice("y", F.col("end") - n, F.lit(n)), lambda v: v / F.col("unit"))).alias("features"),
                (F.get("y", F.col("end") - 1) / F.col("unit")).alias("label"),
            )
        )

    def fit(self, df: DataFrame, ys: str) -> FittedTrees:
        """Train on all windows of the array column; ``df`` is read several times."""
        training = self.windows(df, ys)
        model = None if training.isEmpty() else self.make_estimator().fit(training)
        return FittedTrees(self.model_id, model, self.lags)

    def attach(self, df: DataFrame, spec: PanelSpec, ys: str, start: str, steps: int, out: str) -> DataFrame:
        df = spool(df)
        return spool(self.fit(df, ys).attach(df, spec, ys, start, steps, out))


@dataclass(frozen=True)
class FittedTrees:
    """A trained ensemble, ready to continue any series; without training data it yields nulls."""

    model_id: str
    model: GBTRegressionModel | RandomForestRegressionModel | None
    lags: int

    @property
    def min_length(self) -> int:
        return self.lags + 1

    def attach(self, df: DataFrame, spec: PanelSpec, ys: str, start: str, steps: int, out: str) -> DataFrame:
        if self.model is None:
            return df.withColumn(out, F.lit(None).cast("array<double>"))
        long_enough = F.size(ys) >= self.min_length
        recent = F.when(long_enough, F.slice(ys, F.lit(-self.lags), F.lit(self.lags)))
        recent = F.coalesce(recent, F.array_repeat(F.lit(0.0), self.lags))
        unit = F.col("unit")
        ahead = df.withColumn("unit", _unit(ys)).withColumn("recent", F.transform(recent, lambda v: v / unit))
        ahead = ahead.withColumn("features", array_to_vector("recent"))
        kept = [*df.columns, "unit"]
        for step in range(steps):
            moved = F.concat(F.slice("recent", 2, self.lags - 1), F.array("prediction"))
            ahead = self.model.transform(ahead).select(
                *kept, F.col("prediction").alias(f"step_{step}"), moved.alias("recent"), array_to_vector(moved).alias("features")
            )
            kept.append(f"step_{step}")
        values = F.transform(F.array(*[f"step_{i}" for i in range(steps)]), lambda v: v * unit)
        return ahead.select(*df.columns, F.when(long_enough, values).alias(out))


def _unit(ys: str):
    """Mean absolute value of a series, or 1 where that is 0."""
    size = total(F.transform(ys, F.abs)) / F.size(ys)
    return F.when(size > 0, size).otherwise(1.0)


# Settings that MLlib knows under another name.
MLLIB_SETTINGS = (
    ("subsample", "subsamplingRate", float),
    ("min_child_weight", "minInstancesPerNode", int),
    ("min_samples_leaf", "minInstancesPerNode", int),
    ("max_bin", "maxBins", int),
    ("colsample_bynode", "featureSubsetStrategy", str),
    ("max_features", "featureSubsetStrategy", str),
)


def tree_model(name: str, params: dict, model_id: str) -> LagTrees:
    """Pooled ``XGBModel`` (gradient boosting) or ``RandomForest`` with MLlib's counterparts of the settings.

    Leaf penalties have no counterpart in MLlib; a non-zero one is an error.
    """
    params = dict(params)
    lags = positive("lags", params.pop("lags", 7))
    common = {
        "maxDepth": params.pop("max_depth", 6),
        "minInfoGain": float(params.pop("gamma", 0.0)),
        "seed": params.pop("random_state", 7),
    }
    for theirs, ours, kind in MLLIB_SETTINGS:
        if theirs in params:
            common[ours] = kind(params.pop(theirs))
    if name == "XGBModel":
        for penalty in ("lambda", "alpha"):
            if params.pop(penalty, 0):
                raise ValueError(f"{penalty} has no counterpart here; leave it out or set it to 0")
        objective = params.pop("objective", "reg:squarederror")
        if objective != "reg:squarederror":
            raise ValueError(f"only squared error is supported, got {objective!r}")
        settings = {"maxIter": params.pop("n_estimators", 20), "stepSize": float(params.pop("learning_rate", 0.3))}
        estimator = GBTRegressor
    else:
        settings = {"numTrees": params.pop("n_estimators", 100)}
        estimator = RandomForestRegressor
    if params:
        raise ValueError(f"unknown settings for {name}: {sorted(params)}")
    return LagTrees(model_id, partial(estimator, **settings, **common), lags)
