"""Vectorised word hashing over Arrow string columns.

A text is a run of UTF-8 bytes; words are cut at the six white-space bytes and
hashed by a polynomial over random 64-bit values of their bytes, taken from
prefix sums, so that no Python code runs per word. Long texts are worked off in
slices that end at white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20  # bytes of one text worked on at once
GROUP = 1 << 17  # bytes of several texts worked on at once; work arrays take up to a hundred times as much
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_rng = np.random.default_rng(20240229)
_BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), GROUP + 1)
        _powers = np.full(size, _BASE, dtype=np.uint64)
        _inverses = np.full(size, _BASE_INVERSE, dtype=np.uint64)
        _powers[0] = _inverses[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
        np.multiply.accumulate(_inverses, out=_inverses)
    return _powers, _inverses


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any span of ``data`` follows."""
    powers, _ = _grown(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers[: len(data)], out=sums[1:])
    return sums


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """Mixed 64-bit hashes of the byte spans [start, end) of ``data``."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    sums = prefix_sums(data) if sums is None else sums
    _, inverses = _grown(len(data) + 1)
    length = (end - start).astype(np.uint64)
    return mix64((sums[end] - sums[start]) * inverses[start] + length)


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (rows + 1) and bytes of a string column, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return starts, np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)


def slices(starts: np.ndarray, data: np.ndarray, limit: int = SLICE, group: int = GROUP) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row + 1, first byte, last byte + 1): whole texts, together up to ``group`` or one up to ``limit``, or a part of a longer one."""
    rows, row = len(starts) - 1, 0
    while row < rows:
        stop = int(np.searchsorted(starts, starts[row] + min(group, limit), side="right")) - 1
        if stop <= row and starts[row + 1] - starts[row] <= limit:
            stop = row + 1
        if stop > row:
            stop = min(stop, rows)
            yield row, stop, int(starts[row]), int(starts[stop])
            row = stop
            continue
        at, end = int(starts[row]), int(starts[row + 1])
        while at < end:
            cut = min(at + limit, end)
            while cut < end:  # on to the next white space, so that no word is cut
                gap = np.flatnonzero(IS_SPACE[data[cut : min(cut + 4096, end)]])
                if len(gap):
                    cut += int(gap[0])
                    break
                cut = min(cut + 4096, end)
            yield row, row + 1, at, cut
            at = cut
        row += 1


def word_spans(part: np.ndarray, text_starts: np.ndarray, apart: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``part``; words end with a byte that is ``apart`` or with the text."""
    inside = ~apart[part]
    edge = np.zeros(len(part) + 1, dtype=bool)
    edge[text_starts] = True
    edge[0] = edge[len(part)] = True
    before = np.empty(len(part), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(part), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of its lower-cased words in order) for every row."""
    starts, data = string_buffers(column)
    held: list[np.ndarray] = []
    for first, stop, low, high in slices(starts, data):
        part = LOWERED[data[low:high]]
        inner = starts[first:stop] - low if stop - first > 1 or low == starts[first] else np.zeros(1, dtype=np.int64)
        start, end = word_spans(part, inner)
        hashes = span_hashes(part, start, end)
        if stop - first > 1 or (low == starts[first] and high == starts[stop]):
            cuts = np.searchsorted(start, starts[first : stop + 1] - low)
            for i in range(stop - first):
                yield first + i, hashes[cuts[i] : cuts[i + 1]]
        else:
            held.append(hashes)
            if high == starts[stop]:
                yield first, np.concatenate(held)
                held = []


_TURNS = mix64(np.arange(1, 6, dtype=np.uint64)) | np.uint64(1)


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; a shorter text is one run, an empty one none."""
    if not len(words):
        return words
    if len(words) < width:
        whole = np.array([len(words)], dtype=np.uint64)
        for i in range(len(words)):
            whole = mix64(whole * _BASE + words[i : i + 1])
        return whole
    n = len(words) - width + 1
    total = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        total += words[i : i + n] * _TURNS[i % len(_TURNS)]
    return np.unique(mix64(total))
