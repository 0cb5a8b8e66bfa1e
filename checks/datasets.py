"""The panels that the registered queries read from the given tables.

Every panel covers all facts of its table: the windows start before the first
fact and end on the last one.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from panelcast.operators.panel import clip, daily_panel
from panelcast.operators.vectors import series_vectors
from panelcast.spec import Cutoffs, PanelSpec


@dataclass(frozen=True)
class Dataset:
    tables: tuple[str, ...]
    on: tuple[str, str] | None
    spec: PanelSpec
    cut: Cutoffs

    @property
    def keys(self) -> str:
        return ", ".join(self.spec.keys)

    @property
    def from_sql(self) -> str:
        if self.on is None:
            return self.tables[0]
        return f"{self.tables[0]} JOIN {self.tables[1]} ON {self.on[0]} = {self.on[1]}"

    def facts(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        first, *rest = [spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in self.tables]
        for other in rest:
            first = first.join(other, first[self.on[0]] == other[self.on[1]])
        return first.select(*self.spec.columns)

    def daily(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return daily_panel(clip(self.facts(spark, sf_dir), self.spec, self.cut), self.spec)

    def vectors(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """Series arrays, spread over the cores: the models that follow cost far more than the bytes suggest."""
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return series_vectors(self.daily(spark, sf_dir), self.spec, self.cut, tasks)


# Six dense series: quantity shipped per return flag and line status.
DENSE = Dataset(
    ("lineitem",),
    None,
    PanelSpec(("l_returnflag", "l_linestatus"), "l_shipdate", "l_quantity"),
    Cutoffs(date(2001, 11, 5), 2555, 21),
)
# The same facts over the last two years only, the usual window of a run.
RECENT = Dataset(DENSE.tables, None, DENSE.spec, Cutoffs(date(2001, 11, 5), 728, 21))
# One series per supplier: their number grows with the tables.
SUPPLIERS = Dataset(("lineitem",), None, PanelSpec(("l_suppkey",), "l_shipdate", "l_quantity"), DENSE.cut)
# 125 sparse series: order value per nation and market segment.
SPARSE = Dataset(
    ("orders", "customer"),
    ("o_custkey", "c_custkey"),
    PanelSpec(("c_nationkey", "c_mktsegment"), "o_orderdate", "o_totalprice"),
    Cutoffs(date(2001, 8, 2), 2555, 21),
)
# Five short series: value of the events of a month per type.
SHORT = Dataset(("events",), None, PanelSpec(("event_type",), "ts", "value"), Cutoffs(date(2024, 1, 31), 30, 7))
# Weekly steps over the dense facts.
WEEKLY = Dataset(
    ("lineitem",),
    None,
    PanelSpec(("l_returnflag", "l_linestatus"), "l_shipdate", "l_quantity", step_days=7),
    Cutoffs(date(2001, 11, 5), 365, 8, step_days=7),
)
