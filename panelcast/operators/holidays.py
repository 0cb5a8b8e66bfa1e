"""Holidays from a table, by series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.scoring import series_join
from panelcast.spec import Cutoffs, PanelSpec, positive

COLUMN = "holidays"


def with_holidays(vectors: DataFrame, holidays: DataFrame, spec: PanelSpec, cut: Cutoffs, steps: int, day: str = "day", name: str = "name") -> DataFrame:
    """``vectors`` with the column ``holidays``, the (day, name) pairs of each series in order.

    ``holidays`` has one row per holiday with a day, a name and some of the
    series' keys; its rows count for all series with these keys. Days outside
    the window and the ``steps`` after it are left out, so an array is bounded
    by the run and not by the table. Series without holidays get null, null
    keys are keys like any other, null days and names are left out and repeated
    rows count once.
    """
    keys = [k for k in spec.keys if k in holidays.columns]
    if not keys:
        raise ValueError(f"the holidays need one of the key columns {list(spec.keys)}; days that hold for all series are a setting of the model")
    positive("steps", steps)
    d = F.col(day).cast("date")
    after = F.date_add(F.lit(cut.end), steps * spec.step_days)
    pairs = F.struct(d.alias("day"), F.col(name).cast("string").alias("name"))
    known = (
        holidays.filter((d >= F.lit(cut.start)) & (d <= after) & F.col(name).isNotNull())
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set(pairs)).alias(COLUMN))
    )
    return series_join(vectors, known, keys, "left")
