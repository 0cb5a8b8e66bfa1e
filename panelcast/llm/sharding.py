"""Contiguous shards of near equal size from global prefix sums.

Documents are put in order by id, in ranges; each range keeps its number. The
totals of the ranges, one row per partition, are summed up by a window over
that small table; running sums inside a range need no other range. Shard
numbers then follow from whole-number arithmetic on the prefix sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import whole_text
from panelcast.sources.spool import spool


def byte_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and ``first_byte``, its place among all bytes.

    The law is ``bytes``: in order of ids (nulls first, then by checksum) a
    document goes to the shard in which the middle of its bytes falls when all
    bytes are cut into ``shards`` equal parts; shards differ by one document's
    size at most. Equal texts form no unit here: a group of copies may hold a
    third of all bytes, more than a shard. ``slot`` counts from 0 inside each
    shard. A null text counts 1 byte, an empty table gives no rows, repeated
    rows get slots of their own, one document longer than a shard's share
    leaves shards empty.
    """
    text = whole_text()
    slim = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.rand(7).alias("tie"),
    )
    order = ["doc_id", "text_crc32", "size", "tie"]
    placed = spool(slim.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    totals = placed.groupBy("range").agg(F.sum("size").alias("sum"))
    starts = totals.select(
        "range",
        F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("start"),
        F.sum("sum").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = placed.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, "range")
    first = first.withColumn("first_byte", F.col("start") + F.col("inner"))
    cut = first.withColumn(
        "shard",
        F.expr(f"CAST((CAST(2 * first_byte + size AS DECIMAL(38,0)) * {int(shards)}) DIV (2 * total) AS INT)"),
    )
    cut = spool(cut.select("doc_id", "size", "text_crc32", "tie", "range", "shard", "first_byte"))
    # Slots: rank inside (range, shard) plus the documents of the shard in earlier ranges.
    parts = cut.groupBy("shard", "range").count()
    earlier = parts.select(
        "shard",
        "range",
        F.coalesce(
            F.sum("count").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("earlier"),
    )
    rank = F.row_number().over(Window.partitionBy("range", "shard").orderBy("first_byte")) - 1
    return (
        cut.withColumn("rank", rank)
        .join(earlier, ["range", "shard"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("earlier") + F.col("rank")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "first_byte",
        )
    )
