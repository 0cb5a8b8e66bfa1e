"""Best-fit packing of token pieces into sequences, over a histogram of lengths.

A piece of n tokens takes n tokens, one document and n * n of attention cost
from its sequence, so pieces of one length are alike. The packing is therefore
chosen for the histogram of lengths, at most one row per possible length
whatever the size of the corpus: longest first, each run of equal pieces goes
to the kind of open sequence that fits best under all three capacities. The
result is a table of runs ("pieces number a to b of length n go to sequences s
to t at offset o"); documents then find their place by joining on length and
their number among the pieces of that length, in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.tokens import TOKENIZER, encoder
from panelcast.sources.spool import spool

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, rank_in_task long"
RUNS = "length int, first long, last long, sequence long, per_sequence long, offset long"


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds. ``cost`` bounds the sum of squared lengths, by default never below what ``tokens`` allow."""

    tokens: int = 2048
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"  # or "dot"

    def __post_init__(self):
        if self.rule not in ("norm", "dot"):
            raise ValueError(f"unknown rule {self.rule!r}")
        if self.tokens < 1 or self.most_documents < 1:
            raise ValueError("a sequence must hold a token and a document")

    @property
    def most_documents(self) -> int:
        return self.tokens if self.documents is None else self.documents

    @property
    def most_cost(self) -> int:
        return self.tokens**2 if self.cost is None else self.cost


def best_fit_runs(histogram: Iterable[tuple[int, int]], capacity: Capacity) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first piece, last piece, first sequence, pieces per sequence, offset) for (length, count) pairs.

    Sequences of equal contents form one kind; a run fills a kind's sequences
    one after another, with as many pieces in each as fit.
    """
    whole = np.array([capacity.tokens, capacity.most_documents, capacity.most_cost], dtype=np.int64)
    weight = np.array(capacity.weights) / whole**2
    kinds: dict[tuple[int, int, int], list[tuple[int, int]]] = {}  # residuals -> (first sequence, how many)
    runs, next_sequence = [], 0
    for length, count in sorted(histogram, reverse=True):
        need = np.array([length, 1, length * length], dtype=np.int64)
        if (need > whole).any():
            raise ValueError(f"a piece of {length} tokens exceeds an empty sequence")
        done = 0
        while done < count:
            residuals = np.array(list(kinds), dtype=np.int64).reshape(-1, 3)
            residuals = residuals[(residuals >= need).all(axis=1)]
            if len(residuals):
                if capacity.rule == "norm":
                    rank = ((residuals - need).astype(float) ** 2) @ weight
                else:  # the smallest product is the tightest place
                    rank = residuals.astype(float) @ (weight * need)
                state = tuple(int(v) for v in residuals[int(np.argmin(rank))])
                sequence, available = kinds[state].pop()
                if not kinds[state]:
                    del kinds[state]
            else:
                state = tuple(int(v) for v in whole)
                each = int((whole // need).min())
                sequence, available = next_sequence, -(-(count - done) // each)
                next_sequence += available
            each = int((np.array(state) // need).min())
            used = min(available, -(-(count - done) // each))
            placed = min(used * each, count - done)
            runs.append((length, done, done + placed - 1, sequence, each, capacity.tokens - state[0]))
            if available > used:
                kinds.setdefault(state, []).append((sequence + used, available - used))
            full, rest = divmod(placed, each)
            for at, number, pieces in ((sequence, full, each), (sequence + full, 1 if rest else 0, rest)):
                left = tuple(int(v) for v in np.array(state) - pieces * need)
                if number and left[0] > 0 and left[1] > 0 and left[2] > 0:
                    kinds.setdefault(left, []).append((at, number))
            done += placed
    return runs


def cut(length: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for the first, which takes what is over."""
    first = length % limit or limit
    edges = [0, *range(first, length + 1, limit)]
    return list(zip(edges, np.diff(edges).tolist(), strict=False))


def token_pieces(docs: DataFrame, tokens: int, name: str = TOKENIZER) -> DataFrame:
    """One row per piece of a document's ids and the closing id 0, numbered within task and length."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = encoder(name).encode, TaskContext.get().partitionId(), {}
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = memoryview(encode(text.as_py() or "") + b"\0\0\0\0")
                for i, (start, length) in enumerate(cut(len(ids) // 4, tokens)):
                    rank = seen.get(length, 0)
                    seen[length] = rank + 1
                    out.append((doc_id, i, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), task, rank))
            if out:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECES)


def pack(docs: DataFrame, capacity: Capacity = Capacity(), name: str = TOKENIZER) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every document.

    A null or empty text is the closing id alone, repeated rows are packed
    each, an empty table gives no rows, ids may be null, other columns are not
    looked at.
    """
    spark = docs.sparkSession
    limit = min(capacity.tokens, int(capacity.most_cost**0.5))
    pieces = spool(token_pieces(docs, limit, name))
    counts = spool(pieces.groupBy("length", "task").count())
    # At most one row per length from 1 to the limit reaches the driver.
    histogram = [(r["length"], r["n"]) for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()]
    runs = spark.createDataFrame(best_fit_runs(histogram, capacity), RUNS)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    number = F.col("before") + F.col("rank_in_task")
    numbered = pieces.join(before, ["length", "task"]).withColumn("number", number)
    # A few runs per length: bounded by the lengths, not by the corpus.
    placed = numbered.join(F.broadcast(runs), "length").filter("number BETWEEN first AND last")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        (F.col("sequence") + F.expr("(number - first) DIV per_sequence")).alias("sequence_id"),
        (F.col("offset") + F.expr("(number - first) % per_sequence") * F.col("length")).alias("offset"),
    )
