"""One row per series: the ordered values as an array.

This is the frame all models work on. Building it shuffles the non-empty cells
once, on the keys; afterwards each model, metric and choice is a narrow step.
An array holds at most ``window`` numbers, whatever the size of the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.panel import last_point, on_grid
from panelcast.spec import Cutoffs, PanelSpec


def series_vectors(daily: DataFrame, spec: PanelSpec, cut: Cutoffs, tasks: int | None = None) -> DataFrame:
    """Columns ``keys…, start, n_train, ys`` from a daily (filled or sparse) panel.

    ``ys`` runs from the first day of the series to the end of the window with
    0 in the holes, and its first ``n_train`` entries are training points.
    ``tasks`` fixes the number of partitions of the one shuffle on the keys;
    left out, Spark sizes them by bytes, which suits cheap models only.
    """
    if tasks:
        daily = daily.repartition(tasks, *spec.keys)
    step = F.lit(spec.step_days)
    cells = F.sort_array(F.collect_list(F.struct(F.col(spec.time).alias("t"), F.col(spec.value).alias("y"))))
    gathered = on_grid(daily, spec, cut).groupBy(*spec.keys).agg(cells.alias("cells"))
    start = F.col("cells")[0]["t"]
    stop = F.date_add(last_point(start, spec, cut), spec.step_days)
    n_train = F.floor(F.datediff(F.lit(cut.train_end), start) / step) + 1

    def with_zeros(cell: Column, i: Column) -> Column:
        following = F.coalesce(F.get("cells", i + 1)["t"], F.col("stop"))
        holes = (F.datediff(following, cell["t"]) / step).cast("int") - 1
        return F.concat(F.array(cell["y"]), F.array_repeat(F.lit(0.0), holes))

    return gathered.withColumn("stop", stop).select(
        *spec.keys,
        start.alias("start"),
        F.greatest(n_train, F.lit(0)).cast("int").alias("n_train"),
        F.flatten(F.transform("cells", with_zeros)).alias("ys"),
    )


def train_part() -> Column:
    """The training values of a vector."""
    return F.slice("ys", F.lit(1), F.col("n_train"))


def test_part() -> Column:
    """The values after the training part."""
    return F.slice("ys", F.col("n_train") + 1, F.greatest(F.size("ys"), F.lit(1)))


def next_day(start: Column, ys: Column, step_days: int) -> Column:
    """The grid point after the last value of a vector."""
    return F.date_add(start, F.size(ys) * step_days)


def horizon(first: Column, steps: int, step_days: int) -> Column:
    """Array of the ``steps`` grid points that begin with ``first``."""
    return F.sequence(first, F.date_add(first, (steps - 1) * step_days), F.expr(f"interval {step_days} day"))


# A filter on a computed array is pushed below the expressions that compute it and
# evaluates them a second time; Spark also infers such filters for ``explode``. The
# outer generators infer none, and what a generator puts out cannot be pushed below
# it. Results of models and metrics are therefore unfolded with these two functions.


def unfold(array: Column | str) -> Column:
    """``explode`` that leaves its input alone; filter the nulls of empty arrays afterwards."""
    return F.explode_outer(array)


def unroll(df: DataFrame, spec: PanelSpec, first: str, values: str, *carry: str) -> DataFrame:
    """Rows ``carry…, keys…, time, value`` from one array of values per row."""
    cells = F.transform(
        values,
        lambda v, i: F.struct(
            *carry, F.date_add(F.col(first), i * spec.step_days).alias(spec.time), v.alias(spec.value)
        ),
    )
    rows = df.select(*spec.keys, F.inline_outer(cells))
    return rows.filter(F.col(spec.time).isNotNull()).select(*carry, *spec.columns)
