"""Run a numpy kernel over stacks of series of equal length."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_NUMBERS = 1 << 22  # numbers held at once; bounds the memory of a Python worker


def stacks(batch: pd.Series, least: int, width: int = 1) -> Iterator[tuple[list[int], np.ndarray]]:
    """(positions, matrix of series) for the arrays of ``batch`` with at least ``least`` values.

    ``width`` is the number of values that the kernel holds for each value of a series.
    """
    alike: dict[int, list[int]] = {}
    for i, y in enumerate(batch):
        if y is not None and len(y) >= least:
            alike.setdefault(len(y), []).append(i)
    for n, members in alike.items():
        at_once = max(1, BLOCK_NUMBERS // (n * width))
        for lo in range(0, len(members), at_once):
            some = members[lo : lo + at_once]
            yield some, np.array([batch.iloc[i] for i in some], dtype=float)


def stacked(ys: Column, least: int, kernel: Callable[[np.ndarray], np.ndarray], width: int = 1) -> Column:
    """Array column of ``kernel(matrix of series)``, a row per series; null where a series is too short."""

    @F.pandas_udf("array<double>")
    def run(batch: pd.Series) -> pd.Series:
        result = pd.Series([None] * len(batch), dtype=object)
        for members, y in stacks(batch, least, width):
            for i, row in zip(members, kernel(y)):
                result.iloc[i] = row
        return result

    return run(ys)


def stacked_named(ys: Column, least: int, kernel: Callable[[np.ndarray], tuple[np.ndarray, list[str]]], width: int = 1) -> Column:
    """Struct column ``values, name`` of a kernel that also names what it chose for each series."""

    @F.pandas_udf("struct<values: array<double>, name: string>")
    def run(batch: pd.Series) -> pd.DataFrame:
        rows: list[tuple] = [(None, None)] * len(batch)
        for members, y in stacks(batch, least, width):
            for i, *found in zip(members, *kernel(y)):
                rows[i] = tuple(found)
        return pd.DataFrame(rows, columns=["values", "name"])

    return run(ys)
