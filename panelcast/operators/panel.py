"""From dated facts to a regular panel: clip, aggregate, fill, label, inspect.

Everything here is plain DataFrame code. Raw facts are always reduced to one
row per (series, day) by a partial aggregate before a series is gathered
anywhere, so a series that owns a large share of the facts reaches a task as
at most one row per day of the window.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.spec import Cutoffs, PanelSpec


def filter_keys(df: DataFrame, key: str, wanted: Iterable | DataFrame | None) -> DataFrame:
    """Keep the rows whose ``key`` is wanted; ``None`` and an empty list keep all.

    A DataFrame of wanted keys becomes a semi join that Spark sizes itself,
    which is the way to pass a list too long for a plan.
    """
    if wanted is None:
        return df
    if isinstance(wanted, DataFrame):
        return df.join(wanted.select(key), key, "left_semi")
    wanted = list(wanted)
    return df.filter(F.col(key).isin(wanted)) if wanted else df


def execution_window(facts: DataFrame, spec: PanelSpec, window: int = 728, test_size: int = 21) -> DataFrame:
    """The run bounds that follow from the newest fact, as one row.

    The execution date is the day after the newest fact; the other days are
    those of ``Cutoffs`` for it.
    """
    newest = facts.agg(F.max(F.col(spec.time).cast("date")).alias("end_date"))
    n = spec.step_days
    return newest.select(
        F.date_add("end_date", 1).alias("execution_date"),
        F.date_sub("end_date", window * n - 1).alias("start_date"),
        F.date_sub("end_date", test_size * n).alias("train_end"),
        "end_date",
    )


def clip(facts: DataFrame, spec: PanelSpec, cut: Cutoffs) -> DataFrame:
    """Rows from ``cut.start`` to ``cut.end``, both days included.

    The bounds are compared with the raw column (half open), so the filter
    reaches the scan for dates and timestamps alike.
    """
    t = F.col(spec.time)
    return facts.filter((t >= F.lit(cut.start)) & (t < F.lit(cut.execution_date)))


def daily_panel(facts: DataFrame, spec: PanelSpec, tasks: int | None = None) -> DataFrame:
    """One row per (series, day); several facts of a day add up, nulls count as 0.

    By default partial sums are shuffled by (series, day), which withstands a
    series that owns most of the facts; gathering the series later is a second,
    smaller shuffle. Where a series has few facts per day anyway, ``tasks``
    sends the facts to that many partitions by series instead, and no step
    that works per series needs another shuffle.
    """
    day = F.col(spec.time).cast("date").alias(spec.time)
    facts = facts.select(*spec.keys, day, spec.value)
    if tasks:
        facts = facts.repartition(tasks, *spec.keys)
    total = F.coalesce(F.sum(spec.value), F.lit(0.0)).cast("double").alias(spec.value)
    return facts.groupBy(*spec.keys, spec.time).agg(total)


def on_grid(daily: DataFrame, spec: PanelSpec, cut: Cutoffs) -> DataFrame:
    """Move each day to the grid point of its period and add up the period.

    The grid of a series starts at its first day and steps by ``step_days``;
    periods that reach past the execution date are incomplete and left out.
    For a step of one day every day already is a grid point.
    """
    if spec.step_days == 1:
        return daily
    step = F.lit(spec.step_days)
    first = F.min(spec.time).over(Window.partitionBy(*spec.keys))
    offset = F.datediff(F.col(spec.time), F.col("first_day"))
    point = F.date_add(F.col("first_day"), (F.floor(offset / step) * step).cast("int"))
    return (
        daily.withColumn("first_day", first)
        .withColumn(spec.time, point)
        .filter(F.date_add(F.col(spec.time), spec.step_days) <= F.lit(cut.execution_date))
        .groupBy(*spec.keys, spec.time)
        .agg(F.sum(spec.value).alias(spec.value))
    )


def left_out(facts: DataFrame, spec: PanelSpec, cut: Cutoffs) -> DataFrame:
    """``keys…, n_rows, total, first_day``: the facts of each series that ``on_grid`` leaves out, series without any not listed.

    They lie in the window, but in a period that reaches past the execution date.
    """
    day = F.col(spec.time).cast("date").alias(spec.time)
    days = clip(facts, spec, cut).groupBy(*spec.keys, day).agg(F.count(F.lit(1)).alias("n"), F.sum(spec.value).alias(spec.value))
    first = F.min(spec.time).over(Window.partitionBy(*spec.keys))
    beyond = F.date_add(last_point(F.col("first_day"), spec, cut), spec.step_days)
    return (
        days.withColumn("first_day", first)
        .filter(F.col(spec.time) >= beyond)
        .groupBy(*spec.keys)
        .agg(F.sum("n").alias("n_rows"), F.sum(spec.value).alias("total"), F.min(spec.time).alias("first_day"))
    )


def gap_fill(daily: DataFrame, spec: PanelSpec, cut: Cutoffs) -> DataFrame:
    """Give each series a row on every grid point from its own first day to the end.

    Each row spans the days up to the next one, so exploding that span fills
    the holes with 0 after a single shuffle on the keys; no calendar is joined.
    """
    following = F.lead(spec.time).over(Window.partitionBy(*spec.keys).orderBy(spec.time))
    until = F.coalesce(F.date_sub(following, spec.step_days), last_point(F.col(spec.time), spec, cut))
    points = F.sequence(F.col(spec.time), F.col("until"), F.expr(f"interval {spec.step_days} day"))
    value = F.when(F.col("point") == F.col(spec.time), F.col(spec.value)).otherwise(F.lit(0.0))
    return (
        on_grid(daily, spec, cut)
        .withColumn("until", until)
        .withColumn("point", F.explode(points))
        .select(*spec.keys, F.col("point").alias(spec.time), value.alias(spec.value))
    )


def last_point(t: Column, spec: PanelSpec, cut: Cutoffs) -> Column:
    """Last grid point of a complete period at or after ``t``."""
    whole = F.floor(F.datediff(F.lit(cut.execution_date), t) / F.lit(spec.step_days)) - 1
    return F.date_add(t, (whole * spec.step_days).cast("int"))


def label_split(panel: DataFrame, spec: PanelSpec, cut: Cutoffs) -> DataFrame:
    """Add ``split``: ``test`` after the last training day, ``train`` up to it."""
    is_test = F.col(spec.time) > F.lit(cut.train_end)
    return panel.select(*spec.columns, F.when(is_test, "test").otherwise("train").alias("split"))


def make_panel(
    facts: DataFrame, spec: PanelSpec, cut: Cutoffs, tasks: int | None = None, few_per_day: bool = False
) -> DataFrame:
    """Clip, aggregate, fill and label in one plan.

    ``tasks`` places the series in that many hash partitions ahead of the fill,
    so that a table bucketed on the keys is written without another shuffle
    and with one file per bucket. ``few_per_day`` places the facts themselves;
    see ``daily_panel``.
    """
    clipped = clip(facts, spec, cut)
    if few_per_day and not tasks:
        raise ValueError("few_per_day needs the number of tasks")
    if few_per_day:
        daily = daily_panel(clipped, spec, tasks)
    else:
        daily = daily_panel(clipped, spec)
        daily = daily.repartition(tasks, *spec.keys) if tasks else daily
    return label_split(gap_fill(daily, spec, cut), spec, cut)


def only(panel: DataFrame, split: str) -> DataFrame:
    """The ``train`` or the ``test`` rows of a labelled panel."""
    if split not in ("train", "test"):
        raise ValueError(f"split must be 'train' or 'test', got {split!r}")
    return panel.filter(F.col("split") == split)


def series_count(df: DataFrame, spec: PanelSpec, approximate: bool = False) -> DataFrame:
    """Number of distinct series as a one-row frame; null keys form a series too."""
    series = F.struct(*spec.keys)
    if approximate:
        return df.agg(F.approx_count_distinct(F.xxhash64(*spec.keys)).alias("n_series"))
    return df.agg(F.count_distinct(series).alias("n_series"))


def grid_check(panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per series: rows, rows expected from first to last day, and whether they agree.

    ``irregular`` counts neighbouring days that are not one step apart and
    ``duplicates`` the surplus rows of a day. Rows are counted per day first.
    """
    gap = F.datediff(
        F.col(spec.time),
        F.lag(spec.time).over(Window.partitionBy(*spec.keys).orderBy(spec.time)),
    )
    days = (
        panel.groupBy(*spec.keys, F.col(spec.time).cast("date").alias(spec.time))
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("gap", gap)
    )
    span = F.datediff(F.max(spec.time), F.min(spec.time))
    return (
        days.groupBy(*spec.keys)
        .agg(
            F.sum("copies").alias("n_rows"),
            (F.floor(span / F.lit(spec.step_days)) + 1).cast("bigint").alias("n_expected"),
            F.count_if(F.col("gap") != spec.step_days).alias("irregular"),
            F.sum(F.col("copies") - 1).alias("duplicates"),
        )
        .withColumn("regular", (F.col("irregular") == 0) & (F.col("duplicates") == 0))
    )


def series_profile(daily: DataFrame, spec: PanelSpec, cut: Cutoffs, min_lengths: dict[str, int]) -> DataFrame:
    """Per series: span, activity, share of zero points, and the models it is long enough for.

    Lengths come from the first day by arithmetic, so the holes are counted
    without being filled. ``min_lengths`` maps a model name to the training
    points it needs.
    """
    t, y = F.col(spec.time), F.col(spec.value)
    grid = on_grid(daily, spec, cut)
    step = F.lit(spec.step_days)
    n_points = F.floor(F.datediff(F.lit(cut.execution_date), F.col("first_day")) / step)
    n_train = F.floor(F.datediff(F.lit(cut.train_end), F.col("first_day")) / step) + 1
    fits = [F.when(F.col("n_train") >= need, F.lit(name)) for name, need in sorted(min_lengths.items())]
    return (
        grid.groupBy(*spec.keys)
        .agg(
            F.min(t).alias("first_day"),
            F.max(F.when(y != 0, t)).alias("last_active_day"),
            F.count_if(y != 0).alias("n_active"),
            F.sum(y).alias("total"),
        )
        .withColumn("n_points", n_points.cast("bigint"))
        .withColumn("n_train", F.greatest(n_train, F.lit(0)).cast("bigint"))
        .withColumn("zero_share", 1.0 - F.col("n_active") / F.col("n_points"))
        .withColumn("eligible", F.concat_ws(",", *fits))
    )


def lag_features(panel: DataFrame, spec: PanelSpec, lags: int) -> DataFrame:
    """Columns ``lag_1`` to ``lag_<lags>``; rows without a full history are dropped."""
    w = Window.partitionBy(*spec.keys).orderBy(spec.time)
    lagged = [F.lag(spec.value, i).over(w).alias(f"lag_{i}") for i in range(1, lags + 1)]
    return panel.select(*spec.columns, *lagged).filter(F.col(f"lag_{lags}").isNotNull())
