"""Write a frame once so that later passes read it instead of computing it again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or a temporary one in local mode.

    A cluster must name a folder that every executor reaches; a folder of one
    machine would be lost with it.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    _own_folder = _own_folder or tempfile.mkdtemp(prefix="panelcast-")
    return _own_folder


def spool(df: DataFrame) -> DataFrame:
    """``df`` read back from a table in the shared folder, with its lineage cut there.

    Unlike cached blocks the rows survive the loss of an executor. A frame
    that came from here is returned as it is.
    """
    if getattr(df, "_panelcast_spooled", False):
        return df
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/panelcast-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._panelcast_spooled = True
    return stored
