"""Sources and sinks: CSV facts, catalog tables, and the run log."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("ts", T.TimestampType()),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    """A headed CSV with a declared schema; nothing is inferred."""
    return spark.read.csv(path, sep=sep, header=True, schema=schema)


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.read.table(_full(database, table))


def use_catalog(spark: SparkSession, catalog: str) -> None:
    spark.catalog.setCurrentCatalog(catalog)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database if it is absent, in the warehouse or at ``location``."""
    text = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    place = f" LOCATION '{text}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{place}")


def create_table(
    spark: SparkSession,
    database: str,
    table: str,
    schema: T.StructType,
    partition_cols: Sequence[str] = (),
    bucket_cols: Sequence[str] = (),
    sort_cols: Sequence[str] = (),
    buckets: int | None = None,
    source: str = "parquet",
) -> None:
    """Create the table if it is absent, optionally partitioned and bucketed."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {_full(database, table)} ({columns}) USING {source}"
    if partition_cols:
        ddl += f" PARTITIONED BY ({_names(partition_cols)})"
    if buckets:
        ddl += f" CLUSTERED BY ({_names(bucket_cols)})"
        ddl += f" SORTED BY ({_names(sort_cols)})" if sort_cols else ""
        ddl += f" INTO {buckets} BUCKETS"
    spark.sql(ddl)


def write_table(
    df: DataFrame,
    database: str,
    table: str,
    mode: str = "overwrite",
    bucket_cols: Sequence[str] = (),
    sort_cols: Sequence[str] = (),
    buckets: int | None = None,
    source: str = "parquet",
) -> None:
    """Replace (or append to) a whole table."""
    writer = df.write.format(source).mode(mode)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_cols)
        writer = writer.sortBy(*sort_cols) if sort_cols else writer
    writer.saveAsTable(_full(database, table))


def overwrite_partitions(df: DataFrame, database: str, table: str) -> None:
    """Replace only the partitions that occur in ``df``; the table must exist.

    Columns are matched by name. Files are swapped partition by partition and
    without a transaction log, so one writer at a time must own the table.
    """
    spark = df.sparkSession
    columns = read_table(spark, database, table).columns
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.select(*columns).write.insertInto(_full(database, table), overwrite=True)


def table_info(spark: SparkSession, database: str, table: str) -> dict[str, str]:
    """``DESCRIBE EXTENDED`` as a dict; section headings are left out."""
    rows = spark.sql(f"DESCRIBE EXTENDED {_full(database, table)}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"] and not r["col_name"].startswith("#")}


def has_table(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(_full(database, table))


def bucket_count(spark: SparkSession, database: str, table: str) -> int | None:
    found = table_info(spark, database, table).get("Num Buckets")
    return None if found is None else int(found)


def log_run(
    spark: SparkSession,
    database: str,
    run_id: str,
    step: str,
    params: Mapping[str, object],
    metric: str | None = None,
    value: float | None = None,
) -> None:
    """Append one row about a finished step to ``<database>.run_log``."""
    create_table(spark, database, "run_log", RUN_LOG)
    row = (run_id, step, {k: str(v) for k, v in params.items()}, metric, value, datetime.now(timezone.utc))
    spark.createDataFrame([row], RUN_LOG).coalesce(1).write.insertInto(_full(database, "run_log"))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the actions inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _full(database: str, table: str) -> str:
    return f"{_quoted(database)}.{_quoted(table)}"


def _names(columns: Sequence[str]) -> str:
    return ", ".join(map(_quoted, columns))
