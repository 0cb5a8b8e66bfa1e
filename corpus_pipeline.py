"""A training corpus from raw documents: five operators in a row, each on what the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm.common import table
from panelcast.llm.exact_dedup import without_exact_duplicates
from panelcast.llm.mixing import mix
from panelcast.llm.near_dedup import without_near_duplicates
from panelcast.llm.packing import Capacity, pack
from panelcast.llm.quality import accepted
from panelcast.sources.spool import shared_folder

TEXT_BATCHES = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def in_small_batches(spark: SparkSession) -> None:
    """Texts go to Python in small Arrow batches from here on: each is held several times, by the executor and by its worker."""
    spark.conf.set(*TEXT_BATCHES)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    in_small_batches(spark)
    return accepted(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    in_small_batches(spark)
    return without_near_duplicates(docs, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs, alpha=0.5, epochs=1.0, seed=17).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    in_small_batches(spark)
    return pack(docs, Capacity(tokens=2048))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

ORACLE_SQL = None  # a trained classifier and a tokenizer are beyond SQL; the tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written to the shared folder and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
