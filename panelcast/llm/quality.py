"""Quality of whole texts: naive Bayes scaled n-gram indicators and a linear hinge-loss model.

The model is fitted on the driver, on at most ``SAMPLE`` labelled rows chosen by
a hash of their id; scoring is one pass over all texts without a shuffle.
Defined results: a null or empty text has no features and gets the score of the
bias; repeated rows score alike; without labels of both classes every text gets
the smoothed share of label 1, which is 0.5 without any; an empty table gives no
rows; only id and text are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm import nbsvm
from panelcast.llm.features import DIMS, indicators
from panelcast.sources.spool import spool

SAMPLE = 6000  # labelled rows that the model is fitted on at most
ACCEPT = 0.3


def remainder(modulus: int) -> Column:
    """crc32 of the id as text, mod ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, size: int) -> DataFrame:
    """``doc_id, label, text`` of at most ``size`` labelled documents, the same at every run.

    The chosen ids, at most ``size``, are what is broadcast.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.max(F.col(label)).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(size)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(spool(chosen)), "doc_id")
    return found


def sample_rows(sample: DataFrame, features, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and feature rows of the sample; repeated rows of an id can't exceed the bound."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [row.astype("<u4").tobytes() for row in features(batch.column("text"))]
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("label"), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "row"])

    made = sample.select("doc_id", "text", "label").mapInArrow(rows, "doc_id long, label int, row binary")
    found = made.limit(size).collect()
    found.sort(key=lambda r: (r["doc_id"], r["row"]))
    label = np.array([r["label"] for r in found], dtype=int)
    return label, [np.frombuffer(r["row"], dtype="<u4").astype(np.int64) for r in found]


def quality_model(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> nbsvm.LinearModel:
    """Fitted on labels of ids whose remainder by 5 is not 0."""
    sample = labelled_sample(docs, labels, "quality", remainder(5) != 0, size)
    label, rows = sample_rows(sample, indicators, size)
    return nbsvm.fit(rows, label, DIMS)


def score_quality(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    model = quality_model(docs, labels, size)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), model.scores(indicators(batch.column("text")))], ["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scored, "doc_id long, score double")
    return out.select(
        "doc_id",
        F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``ACCEPT``, all columns unchanged."""
    model = quality_model(docs, labels, size)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.filter(pa.array([s >= ACCEPT for s in model.scores(indicators(batch.column("text"))).to_pylist()], pa.bool_()))
            if kept.num_rows:
                yield kept

    return docs.mapInArrow(good, docs.schema)
