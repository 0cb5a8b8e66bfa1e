"""The table-to-table workflow: ingest, split, model, evaluate.

Every step reads catalog tables and writes catalog tables, so a step can be
run again by itself. With ``buckets`` the tables are bucketed on the series
keys by one shared count; reading the split, joining actuals with forecasts
and joining forecasts with chosen models then need no further shuffle. A
bucket is read by one task; ``bucket_cells`` makes their number follow the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.metrics import Metric, resolve
from panelcast.operators.models import Model
from panelcast.operators.panel import clip, filter_keys, make_panel, only, series_count
from panelcast.operators.scoring import best_model, champion_forecast, champion_mean_error, fully_scored, metrics_long, score_join, series_join
from panelcast.operators.vectors import series_vectors
from panelcast.plans import champion
from panelcast.sources import tables
from panelcast.sources.spool import spool
from panelcast.spec import Cutoffs, PanelSpec, positive


@dataclass(frozen=True)
class Workflow:
    """Settings shared by the steps; wrong ones are refused here.

    With ``bucket_cells``, ``buckets`` is the least number of buckets, and there
    are so many that the panel has about that many cells in each. Tables
    that already hold forecasts of other models keep the number they have.
    """

    database: str
    spec: PanelSpec
    cut: Cutoffs
    steps: int = 21
    metrics: tuple[str | Metric, ...] = ("rmse", "mae", "mape")
    select_on: str = "mape"
    buckets: int | None = None
    bucket_cells: int | None = None
    few_per_day: bool = False
    location: str | None = None
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def __post_init__(self) -> None:
        positive("steps", self.steps)
        if self.buckets is not None:
            positive("buckets", self.buckets)
        if self.bucket_cells is not None and not self.buckets:
            raise ValueError("bucket_cells needs buckets")
        if self.bucket_cells is not None:
            positive("bucket_cells", self.bucket_cells)
        if self.few_per_day and not self.buckets:
            raise ValueError("few_per_day needs buckets")
        if self.spec.step_days != self.cut.step_days:
            raise ValueError("spec and cut must have the same step_days")
        if self.select_on not in resolve(list(self.metrics)):
            raise ValueError(f"selection metric {self.select_on!r} is not among the metrics")

    @property
    def settings(self) -> dict[str, object]:
        return {
            "keys": ",".join(self.spec.keys),
            "execution_date": self.cut.execution_date,
            "window": self.cut.window,
            "test_size": self.cut.test_size,
            "step_days": self.spec.step_days,
            "steps": self.steps,
        }

    # ---------------------------------------------------------------- steps

    def create_database(self, spark: SparkSession) -> None:
        tables.create_database(spark, self.database, self.location)
        self._log(spark, "create_database")

    def ingest(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType | str,
        sep: str = ",",
        keep: tuple[str, Iterable] | None = None,
    ) -> None:
        """CSV to table ``input``; ``keep`` is (key column, wanted keys)."""
        facts = tables.read_csv(spark, path, schema, sep)
        if keep:
            facts = filter_keys(facts, *keep)
        tables.write_table(facts, self.database, "input")
        self._log(spark, "ingest", path=path)

    def split(self, spark: SparkSession) -> None:
        """Table ``input`` to table ``split``."""
        facts = self._read(spark, "input")
        buckets = self._wanted_buckets(spark, facts)
        panel = make_panel(facts, self.spec, self.cut, buckets, self.few_per_day)
        self._replace(panel, "split", buckets)
        self._log(spark, "split")

    def model(self, spark: SparkSession, models: Sequence[Model]) -> None:
        """Table ``split`` to ``forecast_on_test``, ``all_models_forecast`` and ``runs``.

        Fits on the training days and on all days. All models share one pass
        over the arrays, whose results are kept in the shared folder for all
        tables; only the models' own ``model`` partitions are replaced.
        """
        vectors = series_vectors(self._read(spark, "split"), self.spec, self.cut)
        tested = champion.backtest(vectors, self.spec, models, self.cut.test_size, self.steps, self.metrics, self.select_on)
        tested = spool(tested.select(*self.spec.keys, "test_start", "future_start", "runs"))
        buckets = self._buckets(spark)
        for table, rows in (
            ("forecast_on_test", champion.forecast_on_test(tested, self.spec)),
            ("all_models_forecast", champion.all_models_forecast(tested, self.spec)),
            ("runs", champion.run_errors(tested, self.spec)),
        ):
            sort = [self.spec.time] if self.spec.time in rows.columns else []
            tables.create_table(spark, self.database, table, rows.schema, ["model"], self.spec.keys, sort, buckets)
            tables.overwrite_partitions(rows, self.database, table)
        self._log(spark, "model", models=",".join(m.model_id for m in models))

    def evaluate(self, spark: SparkSession) -> float | None:
        """Forecast tables to ``metrics``, ``best_models``, ``forecast`` and ``no_forecast``; returns the mean error.

        Each table is written once and the next one is derived from what is
        stored. Only models that cover every test day of a series are scored,
        so forecasts of a run with other days do not compete, and only days
        after the window are forecast. ``no_forecast`` lists the series without
        one, with the errors that plug-ins reported or what else is the reason.
        """
        spec, buckets = self.spec, self._buckets(spark)
        # Tables bucketed on the keys may be joined on (keys, day) without a shuffle.
        with tables.setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
            test = only(self._read(spark, "split"), "test")
            nulls = F.lit(False)
            for key in spec.keys:
                nulls = nulls | F.col(key).isNull()
            null_keys = not test.filter(nulls).isEmpty()
            joined = score_join(test, self._read(spark, "forecast_on_test"), spec, null_keys)
            joined = fully_scored(joined, test, spec, null_keys)
            self._replace(metrics_long(joined, spec, self.metrics), "metrics", buckets, sort=False)
            best = best_model(self._read(spark, "metrics"), spec, self.select_on)
            self._replace(best, "best_models", buckets, sort=False)
            best = self._read(spark, "best_models")
            ahead = self._read(spark, "all_models_forecast").filter(
                F.col(spec.time) > F.date_sub(F.lit(self.cut.execution_date), spec.step_days)
            )
            self._replace(champion_forecast(ahead, best, spec, null_keys), "forecast", buckets)
            self._replace(self._without(spark, null_keys), "no_forecast", buckets, sort=False)
        error = champion_mean_error(best).first()["mean_error"]
        self._log(spark, "evaluate", metric=self.select_on, value=error)
        return error

    def run(
        self, spark: SparkSession, path: str, schema: T.StructType | str, models: Sequence[Model], **ingest
    ) -> float | None:
        """All steps in order."""
        self.create_database(spark)
        self.ingest(spark, path, schema, **ingest)
        self.split(spark)
        self.model(spark, models)
        return self.evaluate(spark)

    # -------------------------------------------------------------- helpers

    def _without(self, spark: SparkSession, null_keys: bool) -> DataFrame:
        """Rows ``keys…, reason`` of the series in ``split`` that have no row in ``forecast``."""
        keys = list(self.spec.keys)
        failed = F.sort_array(F.collect_list(F.concat("model", F.lit(": "), "error")))
        errors = self._read(spark, "runs").groupBy(*keys).agg(F.array_join(failed, "; ").alias("errors"))
        scored = self._read(spark, "metrics").groupBy(*keys).agg(F.count(F.lit(1)).alias("scores"))
        missing = self._read(spark, "split").select(*keys).distinct()
        missing = series_join(missing, self._read(spark, "forecast").select(*keys).distinct(), keys, "left_anti", null_keys)
        missing = series_join(missing, errors, keys, "left", null_keys)
        missing = series_join(missing, scored, keys, "left", null_keys)
        other = F.when(F.col("scores").isNull(), champion.TOO_FEW).otherwise(champion.undefined(self.select_on))
        return missing.select(*keys, F.coalesce(F.nullif("errors", F.lit("")), other).alias("reason"))

    def _read(self, spark: SparkSession, table: str) -> DataFrame:
        return tables.read_table(spark, self.database, table)

    def _wanted_buckets(self, spark: SparkSession, facts: DataFrame) -> int | None:
        if not self.bucket_cells:
            return self.buckets
        if tables.has_table(spark, self.database, "forecast_on_test"):
            return tables.bucket_count(spark, self.database, "forecast_on_test")
        n_series = series_count(clip(facts, self.spec, self.cut), self.spec, approximate=True).first()["n_series"]
        return max(self.buckets, -(-n_series * self.cut.window // self.bucket_cells))

    def _buckets(self, spark: SparkSession) -> int | None:
        """The number of buckets that ``split`` has been written with."""
        return tables.bucket_count(spark, self.database, "split") if self.bucket_cells else self.buckets

    def _replace(self, df: DataFrame, table: str, buckets: int | None, sort: bool = True) -> None:
        by = [*self.spec.keys, self.spec.time] if sort else []
        tables.write_table(
            df, self.database, table, bucket_cols=self.spec.keys, sort_cols=by[-1:], buckets=buckets
        )

    def _log(self, spark: SparkSession, step: str, metric: str | None = None, value: float | None = None, **extra) -> None:
        tables.log_run(spark, self.database, self.run_id, step, {**self.settings, **extra}, metric, value)
