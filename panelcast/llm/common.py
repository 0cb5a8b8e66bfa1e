"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def one_row_each(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per value of ``key``: rows alone with theirs pass, others meet in an aggregate.

    Of several the smallest by ``order`` stays. The aggregate combines in each
    task before the shuffle, so a value with many rows is no hot group.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns if c != key]
    lead = [F.col(f"`{c}`") for c in order]
    best = F.min_by(F.struct(*columns), F.struct(*lead) if len(lead) > 1 else lead[0])
    some = F.coalesce(best, F.any_value(F.struct(*columns)))
    return rows.groupBy(F.col(f"`{key}`")).agg(some.alias("__row")).select("__row.*")
