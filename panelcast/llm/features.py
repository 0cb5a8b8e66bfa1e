"""N-gram indicators of whole texts as hashed feature numbers, without Python code per word.

Two families share the feature space: runs of four bytes, and runs of one to
three word shapes. A shape says of which kinds of characters a word is made
(runs of lower case, upper case, digits, other letters count once, other marks
once or many) and whether the word repeats the one before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from panelcast.llm.textkernels import mix64, slices, span_hashes, string_buffers, word_spans

BITS = 16
DIMS = 2 << BITS  # byte runs below 1 << BITS, shapes above

_KIND = np.arange(256, dtype=np.uint8)
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[128:] = 4


def byte_runs(part: np.ndarray) -> np.ndarray:
    """Feature of the four bytes from each position; the last three positions have none."""
    if len(part) < 4:
        return np.zeros(0, dtype=np.uint32)
    wide = part.astype(np.uint32)
    four = wide[:-3] | (wide[1:-2] << np.uint32(8)) | (wide[2:-1] << np.uint32(16)) | (wide[3:] << np.uint32(24))
    return (four * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def shape_runs(part: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of one to three shapes in a row and the byte where each begins."""
    start, end = word_spans(part, texts)
    if not len(start):
        return np.zeros(0, dtype=np.uint32), start
    kind = _KIND[part]
    turn = np.empty(len(part), dtype=bool)
    turn[0] = True
    np.not_equal(kind[1:], kind[:-1], out=turn[1:])
    turn[start] = True
    turn[end[end < len(part)]] = True
    at = np.flatnonzero(turn)
    length = np.diff(np.append(at, len(part)))
    runs = kind[at]
    runs[(length > 1) & (runs > 4) & (runs < 128)] += 128  # a mark many times over
    position = np.cumsum(turn) - 1
    last = np.where(end < len(part), position[np.minimum(end, len(part) - 1)], len(at))
    shape = span_hashes(runs, position[start], last)
    word = span_hashes(part, start, end)
    text = np.searchsorted(texts, start, side="right")
    follows = np.zeros(len(start), dtype=bool)
    follows[1:] = text[1:] == text[:-1]
    same = np.zeros(len(start), dtype=bool)
    same[1:] = follows[1:] & (word[1:] == word[:-1])
    shape = mix64(shape + same.astype(np.uint64))
    found, places = [shape], [start]
    two = follows[1:]
    pairs = mix64(shape[:-1] * np.uint64(3) + shape[1:])
    found.append(pairs[two])
    places.append(start[:-1][two])
    if len(start) > 2:
        three = follows[1:-1] & follows[2:]
        found.append(mix64(pairs[:-1] * np.uint64(5) + shape[2:])[three])
        places.append(start[:-2][three])
    features = (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.uint32) + np.uint32(1 << BITS)
    return features, np.concatenate(places)


def indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct features of every text in turn."""
    starts, data = string_buffers(column)
    seen = np.zeros(DIMS, dtype=bool)
    ready = 0
    for first, stop, low, high in slices(starts, data):
        part = data[low:high]
        texts = starts[first:stop] - low if stop - first > 1 or low == starts[first] else np.zeros(1, dtype=np.int64)
        runs = byte_runs(part)
        shapes, places = shape_runs(part, texts)
        order = np.argsort(places, kind="stable")
        shapes, places = shapes[order], places[order]
        edges = np.append(texts, len(part))
        cuts = np.searchsorted(places, edges)
        for i in range(stop - first):
            seen[runs[edges[i] : max(edges[i], edges[i + 1] - 3)]] = True
            seen[shapes[cuts[i] : cuts[i + 1]]] = True
            if high >= starts[first + i + 1]:
                found = np.flatnonzero(seen)
                yield found
                seen[found] = False
                ready += 1
    for _ in range(ready, len(column)):  # empty texts at the end
        yield np.zeros(0, dtype=np.int64)
