import sys
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from panelcast.spec import Cutoffs, PanelSpec  # noqa: E402

SPEC = PanelSpec(("store", "item"), "date", "sales")
SCHEMA = "store int, item int, date date, sales double"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("panelcast-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def days(first: date, values, store=1, item=1):
    """Daily rows of one series."""
    return [(store, item, first + timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]


def facts(spark, *series):
    return spark.createDataFrame([row for rows in series for row in rows], SCHEMA)


def vectors_of(spark, *series, test_size=7, window=400):
    """Series arrays for daily rows that all end on the same day."""
    from panelcast.operators.panel import clip, daily_panel
    from panelcast.operators.vectors import series_vectors

    end = max(row[2] for rows in series for row in rows)
    cut = Cutoffs(end + timedelta(days=1), window, test_size)
    return series_vectors(daily_panel(clip(facts(spark, *series), SPEC, cut), SPEC), SPEC, cut)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
