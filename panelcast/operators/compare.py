"""Differences between two frames, as a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def frame_diff(expected: DataFrame, actual: DataFrame, digits: int | None = None) -> DataFrame:
    """Rows that one frame has more often than the other: ``side, columns…, copies``.

    ``digits`` rounds floating-point columns first. Both frames are counted in
    one aggregation over their union, so a row that repeats very often is one
    group with partial counts; nothing is sorted and order does not matter.
    """
    if expected.dtypes != actual.dtypes:
        raise ValueError(f"column types differ: {expected.dtypes} and {actual.dtypes}")

    def prepared(df: DataFrame, weight: int) -> DataFrame:
        columns = [
            F.round(f.name, digits).alias(f.name)
            if digits is not None and isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
        return df.select(*columns, F.lit(weight).cast("bigint").alias("_weight"))

    both = prepared(expected, 1).unionByName(prepared(actual, -1))
    surplus = both.groupBy(*expected.columns).agg(F.sum("_weight").alias("_surplus")).filter("_surplus <> 0")
    side = F.when(F.col("_surplus") > 0, "expected").otherwise("actual").alias("side")
    return surplus.select(side, *expected.columns, F.abs("_surplus").alias("copies"))


def numbered(df: DataFrame, name: str = "row") -> DataFrame:
    """Add a gapless row number in the present order of the partitions.

    Only the row count of each partition reaches the driver. The frame is read
    twice, so it must come out in the same order both times.
    """
    marked = df.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33))
    sizes = sorted((r["_part"], r["count"]) for r in marked.groupBy("_part").count().collect())
    offsets, seen = [], 0
    for part, size in sizes:
        offsets.append((part, seen))
        seen += size
    base = df.sparkSession.createDataFrame(offsets, "_part bigint, _base bigint")
    position = F.col("_base") + F.col("_id").bitwiseAND((1 << 33) - 1)
    return marked.join(F.broadcast(base), "_part").select(position.alias(name), *df.columns)


def assert_frames_equal(
    expected: DataFrame, actual: DataFrame, digits: int | None = None, ignore_order: bool = True
) -> None:
    """Raise, showing up to ten differing rows, unless both frames hold the same rows."""
    if not ignore_order:
        expected, actual = numbered(expected), numbered(actual)
    difference = frame_diff(expected, actual, digits).limit(10).collect()
    if difference:
        raise AssertionError("frames differ:\n" + "\n".join(map(str, difference)))
