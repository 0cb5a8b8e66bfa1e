"""Token sequences written in training order to fixed-stride binary shards.

The ids of a task's documents, each closed by id 0, run on into sequences of
equal length; only a task's last one is padded. A keyed Feistel permutation
over the number of all sequences, walking its cycle until it falls below that
number, gives every sequence its global slot. A shard is a range of slots; each
is one file of records of equal size, so that record r begins at byte
r * stride and reading may start at any slot.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.textkernels import mix64
from panelcast.llm.tokens import TOKENIZER, encoder
from panelcast.sources.spool import shared_folder, spool

LENGTH = 2048
SHARD_BYTES = 32 << 20
WIDE = "<u2"  # ids of this vocabulary are below 65,536
ROUNDS = 4
SPANS = "array<struct<doc_id: long, start: long, offset: int, length: int>>"
_SPAN = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("offset", pa.int32()), ("length", pa.int32())]))


class Permutation:
    """A keyed permutation of 0..n-1 and its inverse."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 % (1 << 64)))

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = step(np.asarray(x, dtype=np.uint64))
        out = np.flatnonzero(x >= self.n)
        while len(out):
            x[out] = step(x[out])
            out = out[x[out] >= self.n]
        return x.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        def step(v):
            left, right = v >> self.half, v & self.mask
            for k in self.keys:
                left, right = right, left ^ (mix64(right ^ k) & self.mask)
            return (left << self.half) | right

        return self._walk(x, step)

    def backward(self, x: np.ndarray) -> np.ndarray:
        def step(v):
            left, right = v >> self.half, v & self.mask
            for k in self.keys[::-1]:
                left, right = right ^ (mix64(left ^ k) & self.mask), left
            return (left << self.half) | right

        return self._walk(x, step)


def token_sequences(docs: DataFrame, length: int, name: str = TOKENIZER) -> DataFrame:
    """``task, number, ids, spans``: sequences in the order of each task's documents, ids as 16-bit bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, number = encoder(name).encode, TaskContext.get().partitionId(), 0
        held, filled, spans = [], 0, []
        ids, notes = [], []

        def ready() -> pa.RecordBatch:
            first = number - len(ids)
            columns = [pa.array([task] * len(ids), pa.int32()), pa.array(range(first, number), pa.int64()), pa.array(ids, pa.binary()), pa.array(notes, _SPAN)]
            return pa.RecordBatch.from_arrays(columns, ["task", "number", "ids", "spans"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                codes = np.frombuffer(encode(text.as_py() or "") + b"\0\0\0\0", dtype="<u4").astype(WIDE)
                at = 0
                while at < len(codes):
                    part = codes[at : at + length - filled]
                    held.append(part.tobytes())
                    spans.append({"doc_id": doc_id, "start": at, "offset": filled, "length": len(part)})
                    at, filled = at + len(part), filled + len(part)
                    if filled == length:
                        ids.append(b"".join(held))
                        notes.append(spans)
                        held, filled, spans, number = [], 0, [], number + 1
                        if len(ids) == 256:
                            yield ready()
                            ids, notes = [], []
        if filled:
            ids.append(b"".join(held) + bytes(2 * (length - filled)))
            notes.append(spans)
            number += 1
        if ids:
            yield ready()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, f"task int, number long, ids binary, spans {SPANS}")


def _files(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")


def _shard_file(path: str, shard: int) -> str:
    return f"{path}/shard-{shard:08d}.bin"


def write_shards(docs: DataFrame, folder: str, length: int = LENGTH, key: int = 2029, shard_bytes: int = SHARD_BYTES, name: str = TOKENIZER) -> DataFrame:
    """Writes the shards and returns their index: ``slot, shard, record, spans``, one row per sequence.

    A shard is written under a name of its own and renamed at its end, so a
    task that runs again after a lost executor leaves the same file. A null or
    empty text is its closing id, repeated rows are written each, ids may be
    null, other columns are not looked at, an empty table writes no file.
    """
    spark = docs.sparkSession
    stored = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    made = token_sequences(docs, length, name)
    made.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "6").parquet(stored)
    sequences = spark.read.schema(made.schema).parquet(stored)
    starts, total = {}, 0
    for r in sequences.groupBy("task").agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect():  # a row per task
        starts[r["task"]], total = total, total + r["n"]
    per_shard = max(1, shard_bytes // (2 * length))
    order = Permutation(total, key)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            begin = np.array([starts[t] for t in batch.column("task").to_pylist()], dtype=np.int64)
            slot = order.forward(begin + np.asarray(batch.column("number")))
            ids = [pack.compress(r.as_py()) for r in batch.column("ids")]
            columns = [pa.array((slot // per_shard).astype(np.int32)), pa.array(slot), pa.array(ids, pa.binary()), batch.column("spans")]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "slot", "ids", "spans"])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _files(folder)
        files.create_dir(path, recursive=True)
        unpack = zstandard.ZstdDecompressor()
        shard, out, temporary = -1, None, ""

        def done() -> None:
            if out is not None:
                out.close()
                files.move(temporary, _shard_file(path, shard))

        for batch in batches:
            for own, ids in zip(batch.column("shard").to_pylist(), batch.column("ids"), strict=True):
                if own != shard:
                    done()
                    shard, temporary = own, f"{path}/_{own:08d}-{uuid.uuid4().hex}"
                    out = files.open_output_stream(temporary)
                out.write(unpack.decompress(ids.as_py()))
            slot = np.asarray(batch.column("slot"))
            columns = [batch.column("slot"), batch.column("shard"), pa.array(slot % per_shard), batch.column("spans")]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "shard", "record", "spans"])
        done()

    dealt = sequences.mapInArrow(placed, f"shard int, slot long, ids binary, spans {SPANS}")
    shards = max(1, -(-total // per_shard))
    sorted_shards = dealt.repartition(shards, "shard").sortWithinPartitions("slot")
    return spool(sorted_shards.mapInArrow(written, f"slot long, shard int, record long, spans {SPANS}"))


def read_records(folder: str, shard: int, first: int = 0, count: int | None = None, length: int = LENGTH) -> Iterator[np.ndarray]:
    """Sequences of a shard from record ``first`` on, read one after another."""
    files, path = _files(folder)
    stride = 2 * length
    with files.open_input_file(_shard_file(path, shard)) as f:
        f.seek(first * stride)
        while count is None or count > 0:
            record = f.read(stride)
            if not record:
                return
            yield np.frombuffer(record, dtype=WIDE)
            count = None if count is None else count - 1


def shard_checksums(spark: SparkSession, index: DataFrame, folder: str, length: int = LENGTH) -> DataFrame:
    """``shard, record, ids_crc32`` read from the files, in one pass over each; ids as unsigned 32-bit numbers."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                sums = [zlib.crc32(r.astype("<u4").tobytes()) for r in read_records(folder, shard, length=length)]
                columns = [pa.array([shard] * len(sums), pa.int32()), pa.array(range(len(sums)), pa.int64()), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "record", "ids_crc32"])

    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    # By their own number, as sizes of numbers would put all shards into one task.
    return index.select("shard").distinct().repartition(shards, "shard").mapInArrow(summed, "shard int, record long, ids_crc32 long")


def token_shards(docs: DataFrame, folder: str, length: int = LENGTH, key: int = 2029, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the shards; one row per stretch of a document in a sequence, with the checksum of the record as read back.

    ``doc_id, start`` (its ids before the stretch), ``length, slot, shard,
    record, offset`` (place in the sequence) and ``ids_crc32`` of the sequence.
    """
    index = write_shards(docs, folder, length, key, shard_bytes)
    sums = shard_checksums(docs.sparkSession, index, folder, length)
    spans = index.select("slot", "shard", "record", F.explode("spans").alias("s"))
    return spans.join(sums, ["shard", "record"]).select(
        "s.doc_id",
        "s.start",
        F.col("s.length").cast("long").alias("length"),
        "slot",
        "shard",
        "record",
        F.col("s.offset").cast("long").alias("offset"),
        "ids_crc32",
    )
