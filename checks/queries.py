"""The registered queries: each takes (spark, folder of the tables) and returns a frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.datasets import DENSE, RECENT, SHORT, SPARSE, SUPPLIERS, WEEKLY, Dataset
from panelcast.functions.metrics import mape_eps, python_metric
from panelcast.operators import models, scoring
from panelcast.operators import panel as ops
from panelcast.operators.compare import frame_diff, numbered
from panelcast.operators.ensemble import Ensemble
from panelcast.operators.ensemble import ensemble_weights as member_weights
from panelcast.operators.holidays import with_holidays
from panelcast.operators.models import Model, Plugin, forecast_rows, history, make_model, plugin_report
from panelcast.operators.vectors import horizon, next_day
from panelcast.plans import champion
from panelcast.plans.pipeline import Workflow
from panelcast.sources import tables
from panelcast.sources.spool import shared_folder

STEPS = 21
BUCKET_CELLS = 1 << 21  # panel cells of one task of the table workflow
Query = Callable[[SparkSession, str], DataFrame]


def light_models() -> list[Model]:
    """The models that are plain expressions."""
    return [
        make_model("NaiveMean"),
        make_model("NaiveSeasonal", {"K": 7}),
        make_model("NaiveDrift"),
        make_model("NaiveMovingAverage", {"input_chunk_length": 7}),
        make_model("Croston", {"version": "sba"}),
    ]


def usual_models() -> list[Model]:
    """The eight models of a full run."""
    return [
        make_model("NaiveMean"),
        make_model("NaiveMovingAverage", {"input_chunk_length": 7}),
        make_model("Croston", {"version": "sba"}),
        make_model("ExponentialSmoothing", {"seasonal_periods": 7}),
        make_model("AutoARIMA", {"maxiter": 10}),
        make_model("Prophet"),
        make_model("XGBModel", {"lags": 7, "max_depth": 6, "learning_rate": 0.3, "gamma": 0, "lambda": 1, "alpha": 0}),
        make_model("RandomForest", {"lags": 7, "n_estimators": 100, "max_depth": 6}),
    ]


def recent_mean_factory():
    """A plug-in class that forecasts the mean of the last 28 values."""

    class RecentMean:
        def __init__(self, last: int = 28):
            self.last = last

        def fit(self, series):
            self.level = series.iloc[-self.last :].mean()

        def predict(self, n):
            return [self.level] * n

    return RecentMean


def picky_factory():
    """A plug-in class that repeats the last value and refuses series that end with 0."""

    class Picky:
        def fit(self, series):
            if series.iloc[-1] == 0:
                raise ValueError("ends idle")
            self.level = series.iloc[-1]

        def predict(self, n):
            return [self.level] * n

    return Picky


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def cents(d: Dataset, df: DataFrame) -> DataFrame:
    """Values are sums of whole cents; rounding removes the trace of the order of addition."""
    return rounded(df, d.spec.value, digits=2)


def forecast_of(d: Dataset, model: Model, which: str = "full") -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        hist = history(d.vectors(spark, sf_dir), d.spec, which)
        return rounded(forecast_rows(hist, d.spec, [model], STEPS), d.spec.value)

    return query


# ------------------------------------------------------------------ panel queries


def filter_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ops.filter_keys(DENSE.facts(spark, sf_dir), "l_returnflag", ["A", "R"])
    return kept.groupBy(*DENSE.spec.keys).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("total"))


def window_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    return (
        ops.clip(RECENT.facts(spark, sf_dir), RECENT.spec, RECENT.cut)
        .groupBy(*RECENT.spec.keys)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("l_quantity").alias("total"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
        )
    )


def execution_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.execution_window(DENSE.facts(spark, sf_dir), DENSE.spec)


def daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DENSE.daily(spark, sf_dir)


def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(SPARSE, ops.gap_fill(SPARSE.daily(spark, sf_dir), SPARSE.spec, SPARSE.cut))


def gap_fill_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.gap_fill(WEEKLY.daily(spark, sf_dir), WEEKLY.spec, WEEKLY.cut)


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.make_panel(RECENT.facts(spark, sf_dir), RECENT.spec, RECENT.cut)


def series_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_text = F.array_join(F.transform("ys", lambda y: y.cast("bigint").cast("string")), ",")
    vectors = DENSE.vectors(spark, sf_dir)
    return vectors.select(*DENSE.spec.keys, "start", F.size("ys").cast("bigint").alias("n"), as_text.alias("ys"))


def grid_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.grid_check(DENSE.facts(spark, sf_dir), DENSE.spec)


def forecast_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = SPARSE
    hist = history(d.vectors(spark, sf_dir), d.spec, "train")
    days = horizon(next_day(F.col("start"), F.col("ys"), 1), STEPS, 1)
    return hist.select(*d.spec.keys, F.posexplode(days).alias("pos", d.spec.time)).select(
        *d.spec.keys, (F.col("pos") + 1).cast("bigint").alias("step"), d.spec.time
    )


def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = cents(SPARSE, ops.gap_fill(SPARSE.daily(spark, sf_dir), SPARSE.spec, SPARSE.cut))
    return ops.lag_features(filled, SPARSE.spec, 7)


def series_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.series_count(SPARSE.facts(spark, sf_dir), SPARSE.spec)


def profiled_models() -> list[Model]:
    """Models that need from one value to more than a series of the window has."""
    return [
        make_model("NaiveMean"),
        make_model("ExponentialSmoothing"),
        make_model("NaiveSeasonal", {"K": 2400}, "Long"),
        make_model("AutoARIMA", {"m": 365, "seasonal_order": (6, 1, 1)}, "TooLong"),
    ]


def series_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    least = models.least_lengths(profiled_models())
    profile = ops.series_profile(SPARSE.daily(spark, sf_dir), SPARSE.spec, SPARSE.cut, least)
    return profile.withColumns({"total": F.round("total", 2), "zero_share": F.round("zero_share", 6)})


def compare_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = SPARSE.daily(spark, sf_dir)
    return frame_diff(daily, ops.gap_fill(daily, SPARSE.spec, SPARSE.cut), digits=2)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All facts written as CSV and read back with a declared schema."""
    spec = DENSE.spec
    facts = DENSE.facts(spark, sf_dir).withColumn(spec.time, F.col(spec.time).cast("date"))
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    facts.write.csv(path, sep=";", header=True)
    return (
        tables.read_csv(spark, path, facts.schema, sep=";")
        .groupBy(*spec.keys)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(spec.value).alias("total"),
            F.min(spec.time).alias("first_day"),
        )
    )


# ------------------------------------------------------- scoring and choice queries


def scored(d: Dataset, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test days joined with the forecasts of the light models, in long form."""
    panel = ops.label_split(ops.gap_fill(d.daily(spark, sf_dir), d.spec, d.cut), d.spec, d.cut)
    hist = history(d.vectors(spark, sf_dir), d.spec, "train")
    return scoring.score_join(ops.only(panel, "test"), forecast_rows(hist, d.spec, light_models(), STEPS), d.spec)


def metrics_of(*metrics) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(scoring.metrics_long(scored(DENSE, spark, sf_dir), DENSE.spec, metrics), "value")

    return query


def metric_plugin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric from Python code next to built-in ones."""

    def worst_error(ys, ps):
        return (ys - ps).abs().max()

    return metrics_of("mae", python_metric(worst_error))(spark, sf_dir)


def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums numbered in order of series and day."""
    d = DENSE
    daily = cents(d, d.daily(spark, sf_dir)).orderBy(*d.spec.keys, d.spec.time)
    return numbered(daily)


def score_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scored(DENSE, spark, sf_dir), "prediction")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.coverage(scored(DENSE, spark, sf_dir), DENSE.spec)


def best_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = scoring.metrics_long(scored(SUPPLIERS, spark, sf_dir), SUPPLIERS.spec, ["mape"])
    return scoring.best_model(long, SUPPLIERS.spec, "mape")


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(best_of_suppliers(spark, sf_dir), "value")


def champion_mean_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scoring.champion_mean_error(best_of_suppliers(spark, sf_dir)), "mean_error")


def futures(d: Dataset, spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_rows(history(d.vectors(spark, sf_dir), d.spec, "full"), d.spec, light_models(), STEPS)


def champion_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step by step: forecasts joined with actuals, chosen models joined with forecasts."""
    d = SUPPLIERS
    chosen = scoring.champion_forecast(futures(d, spark, sf_dir), best_of_suppliers(spark, sf_dir), d.spec)
    return rounded(chosen, d.spec.value)


def all_models_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(futures(SUPPLIERS, spark, sf_dir), SUPPLIERS.spec.value)


def tested(d: Dataset, models: list[Model], spark: SparkSession, sf_dir: str) -> DataFrame:
    return champion.backtest(d.vectors(spark, sf_dir), d.spec, models, d.cut.test_size, STEPS)


def champion_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result as ``champion_forecast`` from one plan over series arrays."""
    run = tested(SUPPLIERS, light_models(), spark, sf_dir)
    return rounded(champion.best_forecast(run, SUPPLIERS.spec), SUPPLIERS.spec.value)


def forecast_on_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = tested(DENSE, light_models(), spark, sf_dir)
    return rounded(champion.forecast_on_test(run, DENSE.spec), DENSE.spec.value)


def no_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse series that get no champion, and why."""
    run = tested(SPARSE, light_models(), spark, sf_dir)
    return champion.no_forecast(run, SPARSE.spec)


def champion_usual_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight usual models over the supplier series, tree models included."""
    run = tested(SUPPLIERS, usual_models(), spark, sf_dir)
    return rounded(champion.best_forecast(run, SUPPLIERS.spec), SUPPLIERS.spec.value)


def ran_workflow(d: Dataset, models: list[Model], spark: SparkSession, sf_dir: str) -> Workflow:
    """The table-to-table workflow on bucketed tables in a database of its own."""
    name = f"panelcast_{uuid.uuid4().hex}"
    folder = f"{shared_folder(spark)}/{name}"
    facts = d.facts(spark, sf_dir).withColumn(d.spec.time, F.col(d.spec.time).cast("date"))
    facts.write.csv(f"{folder}/facts", header=True)
    flow = Workflow(name, d.spec, d.cut, steps=STEPS, buckets=8, bucket_cells=BUCKET_CELLS, location=f"{folder}/db")
    flow.run(spark, f"{folder}/facts", facts.schema, models)
    return flow


def workflow_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = ran_workflow(SUPPLIERS, light_models(), spark, sf_dir)
    return rounded(tables.read_table(spark, flow.database, "forecast"), SUPPLIERS.spec.value)


def workflow_no_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series that end without a forecast, with the plug-in's own words where it failed."""
    flow = ran_workflow(SPARSE, [Plugin("Picky", picky_factory(), on_error="report")], spark, sf_dir)
    return tables.read_table(spark, flow.database, "no_forecast")


def workflow_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of a run, what each of them has logged and the mean error of the chosen models."""
    flow = ran_workflow(DENSE, light_models(), spark, sf_dir)
    log = tables.read_table(spark, flow.database, "run_log").filter(F.col("run_id") == flow.run_id)
    return log.select("step", "metric", F.round("value", 4).alias("value"), F.col("params")["test_size"].cast("int").alias("test_size"))


def table_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, types and place of a table of daily sums, and the values that each column holds."""
    d, name = DENSE, f"panelcast_{uuid.uuid4().hex}"
    tables.create_database(spark, name, f"{shared_folder(spark)}/{name}")
    tables.write_table(d.daily(spark, sf_dir), name, "daily")
    info = tables.table_info(spark, name, "daily")
    stored = tables.read_table(spark, name, "daily")
    counts = stored.agg(*[F.count(c).alias(c) for c in stored.columns]).unpivot([], stored.columns, "column", "n_values")
    kinds = F.create_map(*[F.lit(x) for c in stored.columns for x in (c, info[c])])
    return counts.select("column", kinds[F.col("column")].alias("type"), "n_values", F.lit(info["Database"] == name).alias("in_place"))


def tree_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and sums of the lag windows that the tree models learn from."""
    d = SUPPLIERS
    hist = history(d.vectors(spark, sf_dir), d.spec, "train")
    windows = make_model("PooledRandomForest", {"lags": 7}).windows(hist, "ys").withColumn("lags", vector_to_array("features"))
    oldest, newest = F.col("lags")[0], F.col("lags")[6]
    return windows.agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.round(F.sum("label"), 3).alias("labels"),
        F.round(F.sum(oldest), 3).alias("oldest"),
        F.round(F.sum(newest), 3).alias("newest"),
        F.round(F.sum(F.col("label") * newest), 3).alias("with_newest"),
    )


def arima_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order that the search chooses for each supplier."""
    return models.arima_orders(history(SUPPLIERS.vectors(spark, sf_dir), SUPPLIERS.spec, "full"), SUPPLIERS.spec)


def fc_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of days and of holidays, which differ by nation: a day of each month, and the last week of the year for half of them."""
    d = SPARSE
    every = F.sequence(F.lit(d.cut.start), F.date_add(F.lit(d.cut.end), STEPS))
    days = d.facts(spark, sf_dir).select("c_nationkey").distinct().select("c_nationkey", F.explode(every).alias("day"))
    month_end = (F.col("c_nationkey") < 12) & (F.month("day") == 12) & (F.dayofmonth("day") > 24)
    payday = F.dayofmonth("day") == F.col("c_nationkey") % 24 + 1
    named = days.withColumn("name", F.when(payday, "payday").when(month_end, "year end")).filter("name IS NOT NULL")
    vectors = with_holidays(d.vectors(spark, sf_dir), named, d.spec, d.cut, STEPS)
    model = make_model(
        "Prophet", {"growth": "flat", "weekly": False, "yearly": False, "holidays_prior_scale": NO_LIMIT, "holidays_column": "holidays"}
    )
    return rounded(forecast_rows(history(vectors, d.spec, "full", ["holidays"]), d.spec, [model], STEPS), d.spec.value)


def left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the last, incomplete week of each series."""
    return ops.left_out(WEEKLY.facts(spark, sf_dir), WEEKLY.spec, WEEKLY.cut)


def ets_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form that the search over state-space forms chooses."""
    return models.chosen_forms(history(DENSE.vectors(spark, sf_dir), DENSE.spec, "full"), DENSE.spec, "AutoETS", {"refine": False})


def naive_ensemble() -> Ensemble:
    return make_model("RegressionEnsembleModel", {"forecasting_models": [("NaiveSeasonal", {"K": 7}), "NaiveMean"], "horizon": STEPS}, "Ensemble")


def ensemble_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each member counts for each supplier."""
    hist = history(SUPPLIERS.vectors(spark, sf_dir), SUPPLIERS.spec, "full")
    return rounded(member_weights(hist, SUPPLIERS.spec, naive_ensemble()), "weight", digits=6)


# ----------------------------------------------------------------- plug-in queries


def fc_plugin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast_of(SUPPLIERS, make_model(recent_mean_factory(), {"last": 28}, "RecentMean"))(spark, sf_dir)


def fc_plugin_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    picky = Plugin("Picky", picky_factory(), on_error="report")
    hist = history(SPARSE.vectors(spark, sf_dir), SPARSE.spec, "full")
    report = plugin_report(hist, SPARSE.spec, picky, 3)
    first = F.round(F.get("forecast", F.lit(0)), 2).alias("first_forecast")
    return report.select(*SPARSE.spec.keys, first, "error")


NO_LIMIT = float("inf")
EXACT_BINS = 32767  # more than a window has distinct values


def queries() -> dict[str, Query]:
    return {
        "filter_keys": filter_keys,
        "window_clip": window_clip,
        "execution_window": execution_window,
        "daily_panel": daily_panel,
        "gap_fill": gap_fill,
        "gap_fill_weekly": gap_fill_weekly,
        "train_test_split": train_test_split,
        "series_vector": series_vector,
        "grid_check": grid_check,
        "forecast_horizon": forecast_horizon,
        "lag_features": lag_features,
        "series_count": series_count,
        "series_profile": series_profile,
        "frame_diff": compare_panels,
        "csv_scan": csv_scan,
        "fc_naive_mean": forecast_of(DENSE, make_model("NaiveMean")),
        "fc_seasonal_naive": forecast_of(SHORT, make_model("NaiveSeasonal", {"K": 7})),
        "fc_drift": forecast_of(DENSE, make_model("NaiveDrift")),
        "fc_moving_average": forecast_of(SUPPLIERS, make_model("NaiveMovingAverage", {"input_chunk_length": 7})),
        "fc_croston_sba": forecast_of(SPARSE, make_model("Croston", {"version": "sba"})),
        "fc_croston_classic": forecast_of(SPARSE, make_model("Croston", {"version": "classic"})),
        "fc_croston_tsb": forecast_of(SPARSE, make_model("Croston", {"version": "tsb"})),
        "fc_croston_optimized": forecast_of(SUPPLIERS, make_model("Croston", {"version": "optimized"})),
        "fc_holt_winters": forecast_of(DENSE, make_model("ExponentialSmoothing", {"params": (0.3, 0.1, 0.2)})),
        "fc_exp_smoothing": forecast_of(DENSE, make_model("ExponentialSmoothing")),
        "fc_arima_110": forecast_of(DENSE, make_model("ARIMA", {"p": 1, "d": 1, "q": 0})),
        "fc_arma_11": forecast_of(DENSE, make_model("AutoARIMA", {"order": (1, 0, 1)}, "ARMA11")),
        "fc_ar1": forecast_of(DENSE, make_model("LinearRegressionModel", {"lags": 1})),
        "fc_auto_arima": forecast_of(SUPPLIERS, make_model("AutoARIMA")),
        "fc_seasonal_arima": forecast_of(DENSE, make_model("ARIMA", {"p": 1, "d": 0, "q": 0, "m": 7, "seasonal_order": (1, 1, 0)})),
        "arima_orders": arima_orders,
        "fc_linear_trend": forecast_of(
            SPARSE, make_model("Prophet", {"n_changepoints": 0, "weekly": False, "yearly": False})
        ),
        "fc_weekday_means": forecast_of(
            SUPPLIERS,
            make_model("Prophet", {"growth": "flat", "weekly": True, "yearly": False, "seasonality_prior_scale": NO_LIMIT}),
        ),
        "fc_decomposed": forecast_of(DENSE, make_model("Prophet")),
        "fc_holidays": fc_holidays,
        "left_out": left_out,
        "fc_theta": forecast_of(DENSE, make_model("Theta", {"season_mode": "additive"})),
        "fc_four_theta": forecast_of(DENSE, make_model("FourTheta", {"season_mode": "additive", "model_mode": "additive"})),
        "fc_damped": forecast_of(DENSE, make_model("AutoETS", {"forms": ["AAdA"], "weights": (0.3, 0.05, 0.1, 0.9)})),
        "fc_auto_ets": forecast_of(DENSE, make_model("AutoETS", {"refine": False})),
        "ets_forms": ets_forms,
        "fc_local_level": forecast_of(DENSE, make_model("KalmanForecaster", {"noise": (0.8, 0.05)})),
        "fc_waves": forecast_of(DENSE, make_model("FFT", {"nr_freqs_to_keep": 10, "trend_poly_degree": 1})),
        "fc_complex_smoothing": forecast_of(DENSE, make_model("AutoCES", {"weights": (1.3, 0.98)})),
        "fc_ensemble": forecast_of(SUPPLIERS, naive_ensemble()),
        "ensemble_weights": ensemble_weights,
        "fc_boosted_stumps": forecast_of(
            DENSE, make_model("XGBModel", {"n_estimators": 5, "max_depth": 1, "lambda": 1, "alpha": 25, "max_bin": EXACT_BINS})
        ),
        "fc_boosted_trees": forecast_of(
            DENSE,
            make_model(
                "XGBModel",
                {"lags": 5, "n_estimators": 3, "max_depth": 2, "learning_rate": 0.5, "lambda": 10, "min_child_weight": 30, "max_bin": EXACT_BINS},
            ),
        ),
        "fc_single_tree": forecast_of(
            SPARSE, make_model("RandomForest", {"n_estimators": 1, "bootstrap": False, "max_depth": 3, "min_samples_leaf": 5, "max_bin": EXACT_BINS})
        ),
        "tree_windows": tree_windows,
        "fc_gbt_lags": forecast_of(SUPPLIERS, make_model("XGBModel")),
        "fc_forest_lags": forecast_of(SUPPLIERS, make_model("RandomForest")),
        "fc_plugin": fc_plugin,
        "fc_plugin_report": fc_plugin_report,
        "score_join": score_join,
        "metrics_long": metrics_of("rmse", "mae", "mape"),
        "metrics_extra": metrics_of("mse", "smape", "bias", "ope", "r2_score", "rmsle", "coefficient_of_variation", "marre"),
        "mape_epsilon": metrics_of(mape_eps(1.0)),
        "metric_warped": metrics_of("dtw_metric"),
        "coverage": coverage,
        "best_model": best_model,
        "champion_mean_error": champion_mean_error,
        "champion_forecast": champion_forecast,
        "champion_plan": champion_plan,
        "no_forecast": no_forecast,
        "metric_plugin": metric_plugin,
        "numbered_rows": numbered_rows,
        "forecast_on_test": forecast_on_test,
        "all_models_forecast": all_models_forecast,
        "champion_usual_models": champion_usual_models,
        "workflow_tables": workflow_tables,
        "workflow_no_forecast": workflow_no_forecast,
        "workflow_log": workflow_log,
        "table_description": table_description,
    }
