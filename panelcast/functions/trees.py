"""Regression trees on lagged values, one ensemble per series, for many series at once.

Boosting (Friedman 2001, with the second-order gains and penalties of Chen and
Guestrin 2016) and bagging (Breiman 2001) share one builder. Values are cut
into bins per series; a lag of a value has the bin of the value, so bins are
made once. Trees grow level by level: numpy counts the gradient and curvature
sums of all nodes of all series of a block in one histogram, so the
interpreter cost of a level is shared by tens of thousands of windows. Three
exact savings (all from XGBoost and LightGBM) keep the counting small: equal windows are
one weighted row, the commonest bin of a series is never counted but left over
from its node, and so is the heavier one of two children.

Random choices are hashes of (seed, the series' own values, tree, place). They
do not depend on which series share an Arrow batch, so a task that is run
again yields the same trees.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 18  # windows handled together, and sums by bin, lag and node; they bound the memory of a Python worker
BLOCK_CELLS = 1 << 21
PIECE = 1 << 14  # draws made together
IDLE_BINS = 512  # bins that the series of a block may lack of the next one's before that one begins a new block
TIE = 1e-9  # gains that differ by less than this share of a series' squared gradients are ties


@dataclass(frozen=True)
class TreeSettings:
    """How an ensemble is grown.

    Boosted trees each correct the sum of those before, shrunk by
    ``learning_rate``; bagged ones are averaged. ``penalty`` and ``l1`` shrink
    leaf values, ``gamma`` is the gain that a split must exceed and
    ``least_weight`` the rows (by weight) that each side must keep.
    ``row_share`` is the chance of a row to take part in a boosted tree;
    ``tree_features`` and ``node_features`` count the lags that a tree or a
    node may use, 0 for all. Ties go to the nearest lag, then the lowest cut.
    """

    lags: int = 7
    trees: int = 100
    max_depth: int = 6
    boosted: bool = True
    learning_rate: float = 0.3
    penalty: float = 1.0
    l1: float = 0.0
    gamma: float = 0.0
    least_weight: float = 1.0
    row_share: float = 1.0
    bootstrap: bool = False
    tree_features: int = 0
    node_features: int = 0
    max_bin: int = 64
    seed: int = 7

    def __post_init__(self) -> None:
        for name, low in (("lags", 1), ("trees", 1), ("max_depth", 1), ("max_bin", 2)):
            if not isinstance(getattr(self, name), int) or getattr(self, name) < low:
                raise ValueError(f"{name} must be a whole number from {low} on, got {getattr(self, name)!r}")
        if self.max_depth > 16 or self.max_bin > 32767:
            raise ValueError("trees are at most 16 levels deep and have at most 32767 bins")
        for name in ("penalty", "l1", "gamma", "least_weight"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be below 0")
        if not 0 < self.row_share <= 1 or self.learning_rate <= 0:
            raise ValueError("the share of rows must lie in (0, 1], the learning rate above 0")


# -------------------------------------------------------------------- random draws


def _mixed(*parts: np.ndarray | int) -> np.ndarray:
    """Uniform 64-bit numbers from whole numbers that broadcast together."""
    x = np.uint64(0x2545F4914F6CDD1D)
    for part in parts:
        x = _mixed_on(x, part)
    return x


def _mixed_on(x: np.ndarray, part: np.ndarray | int) -> np.ndarray:
    """The numbers of ``_mixed`` for one more part."""
    with np.errstate(over="ignore"):
        x = x ^ np.asarray(part).astype(np.uint64, copy=False)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        return x


def _chosen(count: int, features: int, *key: np.ndarray | int) -> np.ndarray:
    """``count`` of ``features`` for each key, as a boolean matrix."""
    draws = _mixed(*(np.asarray(k)[..., None] for k in key), np.arange(features))
    return draws.argsort(axis=-1).argsort(axis=-1) < count


# --------------------------------------------------------------------------- bins


def binned(y: np.ndarray, max_bin: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each value, and the cuts: a value belongs to the bins up to ``b`` if it is at most ``cuts[b]``.

    Equal values share a bin; more than ``max_bin`` distinct values are put
    together by their quantiles. Cuts lie half-way between neighbours.
    """
    distinct, place, counts = np.unique(y, return_inverse=True, return_counts=True)
    code = np.arange(len(distinct))
    if len(distinct) > max_bin:
        code = (np.cumsum(counts) - counts) * max_bin // len(y)
        code = np.unique(code, return_inverse=True)[1]
    first = np.flatnonzero(np.diff(code, prepend=-1))
    cuts = (distinct[first[1:] - 1] + distinct[first[1:]]) / 2
    return code[place], cuts


def _alike(codes: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal columns of ``codes``: the place of the first one of each kind, and the kind of every column."""
    label, kinds = codes[0], bins
    for row in codes[1:]:
        if kinds > (1 << 62) // bins:
            label = np.unique(label, return_inverse=True)[1]
            kinds = len(label)
        label, kinds = label * bins + row, kinds * bins
    _, first, kind = np.unique(label, return_index=True, return_inverse=True)
    return first, kind


@dataclass
class Block:
    """Windows of several series. Windows of a series with the same bins are one row, as no tree can part them.

    ``cell`` lists bin and lag of the rows' values outside the commonest bin of
    the series; the sums of that bin are what the others leave of a node's.
    Rows with as many cells as one another lie side by side, and so do their
    first cells, their second ones and so on.
    """

    target: np.ndarray  # of each window
    series: np.ndarray  # of each window, its series and its row
    window_row: np.ndarray
    starts: np.ndarray  # first window of each series
    sizes: np.ndarray
    key: np.ndarray  # a checksum of each series
    cuts: np.ndarray  # (series, bins - 1), padded
    common: np.ndarray  # the commonest bin of each series
    row_series: np.ndarray
    codes: np.ndarray  # (lags, rows), the nearest lag first
    each: np.ndarray  # number of cells of each row
    cell: np.ndarray  # bin * lags + lag
    cell_key: np.ndarray  # place of (bin, lag, series)
    groups: list[tuple[int, int, np.ndarray]]  # first row, last row and cells (number, rows) of rows with some
    runs: np.ndarray  # first row of each run of rows of one series, and the series
    run_series: np.ndarray

    def per_series(self, x: np.ndarray) -> np.ndarray:
        """Sums of the rows of each series."""
        return np.bincount(self.run_series, np.add.reduceat(x, self.runs), len(self.key))


def block_of(ys: list[np.ndarray], settings: TreeSettings) -> Block:
    lags, made = settings.lags, [binned(y, settings.max_bin) for y in ys]
    sizes = np.array([len(y) - lags for y in ys])
    cuts = np.full((len(ys), max(1, *(len(c) for _, c in made))), np.inf)
    codes, window_row, rows = [], [], 0
    for s, (code, c) in enumerate(made):
        cuts[s, : len(c)] = c
        seen = np.array([code[lags - 1 - j : len(code) - 1 - j] for j in range(lags)])
        first, kind = _alike(seen, len(c) + 1)
        codes.append(seen[:, first])
        window_row.append(kind + rows)
        rows += len(first)
    row_series = np.repeat(np.arange(len(ys)), [c.shape[1] for c in codes])
    common = np.array([np.bincount(code).argmax() for code, _ in made])
    joined = np.concatenate(codes, axis=1, dtype=np.int16, casting="same_kind")
    counted = joined != common[row_series]
    each = counted.sum(axis=0)
    order = each.argsort(kind="stable")
    row_series, joined, counted, each = row_series[order], joined[:, order], counted[:, order], each[order]
    new_place = np.empty(rows, dtype=np.int64)
    new_place[order] = np.arange(rows)
    ends = np.searchsorted(each, np.arange(lags + 2))
    runs = np.flatnonzero(np.diff(row_series, prepend=-1))
    cells, keys, groups = [], [], []
    small = np.int16 if (cuts.shape[1] + 1) * lags < 1 << 15 else np.int32
    for number, lo, hi in zip(range(1, lags + 1), ends[1:].tolist(), ends[2:].tolist()):
        if lo < hi:
            lag = np.nonzero(counted[:, lo:hi].T)[1].reshape(hi - lo, number).T
            cell = joined[lag, np.arange(lo, hi)].astype(np.int64) * lags + lag
            keys.append((cell * len(ys) + row_series[lo:hi]).ravel())
            cells.append(cell.astype(small))
            groups.append((lo, hi, cells[-1]))
    return Block(
        target=np.concatenate([y[lags:] for y in ys]),
        series=np.repeat(np.arange(len(ys)), sizes),
        window_row=new_place[np.concatenate(window_row)],
        starts=np.cumsum(sizes) - sizes,
        sizes=sizes,
        key=np.array([zlib.crc32(np.ascontiguousarray(y).tobytes()) for y in ys]),
        cuts=cuts,
        common=common,
        row_series=row_series,
        codes=np.ascontiguousarray(joined),
        each=each,
        cell=np.concatenate([c.ravel() for c in cells]) if cells else np.zeros(0, dtype=small),
        cell_key=np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64),
        groups=groups,
        runs=runs,
        run_series=row_series[runs],
    )


# -------------------------------------------------------------------------- trees


@dataclass
class Trees:
    """One tree per series, nodes in heap order: ``feature`` is -1 in leaves."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return g if not l1 else np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


class Scratch:
    """Memory that the trees of a block use again from level to level."""

    def __init__(self) -> None:
        self.kept: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, dtype: type = float) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.kept or self.kept[name].size < size:
            self.kept[name] = np.empty(size, dtype)
        return self.kept[name][:size].reshape(shape)


def _add(key: np.ndarray, xs: tuple[np.ndarray, ...], totals: tuple[np.ndarray, ...], common: np.ndarray, shape: tuple[int, int, int]) -> list[np.ndarray]:
    """Sums of each of ``xs`` by (bin, lag, node); the commonest bin gets what the others leave of the node's total."""
    bins, lags, count = shape
    rest = np.arange(lags * count).reshape(lags, count) + common * (lags * count)
    found = []
    for x, total in zip(xs, totals):
        sums = np.bincount(key, x, bins * lags * count)
        sums[rest] = total - sums.reshape(shape).sum(axis=0)
        found.append(sums.reshape(shape))
    return found


def _running(sums: np.ndarray, out: np.ndarray) -> None:
    """Running sums over the bins of (bins, lags, nodes), without the last one."""
    if len(sums) > sums.shape[1] * sums.shape[2]:
        np.cumsum(sums[:-1], axis=0, out=out)
        return
    out[0] = sums[0]
    for b in range(1, len(sums) - 1):
        np.add(out[b - 1], sums[b], out=out[b])


def _root_left(block: Block, x: np.ndarray, total: np.ndarray, out: np.ndarray, scratch: Scratch) -> None:
    shape, weight, at = (block.cuts.shape[1] + 1, len(block.codes), len(block.key)), scratch("weights", len(block.cell)), 0
    for lo, hi, cell in block.groups:
        weight[at : at + cell.size].reshape(cell.shape)[:] = x[lo:hi]
        at += cell.size
    _running(_add(block.cell_key, (weight,), (total,), block.common, shape)[0], out)


def _child_left(block: Block, g: np.ndarray, h: np.ndarray, rows: np.ndarray, node: np.ndarray, common: np.ndarray, totals: np.ndarray, parents: np.ndarray, out: np.ndarray, penalty: float, scratch: Scratch) -> None:
    """Left sums of the lighter children, from their ``rows``, and behind them those of the others, which are the rest of the parents'."""
    count, (_, cuts, lags, _) = len(common), parents.shape
    ends, xs, at, parts = np.searchsorted(rows, [(lo, hi) for lo, hi, _ in block.groups]).tolist(), [x.take(rows) for x in (g, h)], 0, []
    size = sum(len(cell) * (hi - lo) for (lo, hi), (*_, cell) in zip(ends, block.groups))
    key, weights = scratch("key", size, dtype=np.int64), scratch("weights", 2, size)
    for (lo, hi), (first, _, cell) in zip(ends, block.groups):
        upto = at + len(cell) * (hi - lo)
        own = key[at:upto].reshape(len(cell), hi - lo)
        np.multiply(cell.take(rows[lo:hi] - first, axis=1), count, out=own, dtype=np.int64)
        own += node[lo:hi]
        for x, weight in zip(xs, weights):
            weight[at:upto].reshape(own.shape)[:] = x[lo:hi]
        at = upto
    for sums, left in zip(_add(key, tuple(weights), totals, common, (cuts + 1, lags, count)), out):
        _running(sums, left[..., :count])
    np.subtract(parents, out[..., :count], out=out[..., count:])
    if penalty:
        out[1, ..., :count] += penalty


def _gains(left: np.ndarray, totals: np.ndarray, s: TreeSettings, scratch: Scratch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What each cut gains from the sums (2, cuts, lags, nodes) on its left: (gain, both, least) for ``gain * both - least``.

    The last two belong to nodes. Weights are whole numbers, those on the left
    have the penalty added. Cuts that leave a side less than the least weight
    gain nothing.
    """
    left_g, a = left
    g, h = totals
    both = np.maximum(h + 2 * s.penalty, 1e-300)
    least = shrunk(g, s.l1) ** 2 / np.maximum(h + s.penalty, 1e-300) + s.gamma
    b = np.subtract(both, a, out=scratch("b", *a.shape))
    # A side without weight gains nothing by itself, as then the other one is the node.
    enough = np.minimum(a, b) > np.ceil(s.least_weight) - 0.5 + s.penalty if s.least_weight > 1 or s.l1 else None
    if s.l1:
        gain = shrunk(left_g, s.l1) ** 2 / np.maximum(a, 1e-9) + shrunk(g - left_g, s.l1) ** 2 / np.maximum(b, 1e-9)
        gain /= both
    else:
        # x * x / a + (g - x) * (g - x) / b, with a + b = both, as a distance from what no cut would give
        gain = np.multiply(a, -g / both, out=scratch("gain", *a.shape))
        gain += left_g
        gain *= gain
        b *= a
        np.maximum(b, 0.5, out=b)  # 1 is the least with weight on both sides
        gain /= b
        least -= g * g / both
    if enough is not None:
        gain *= enough
    return gain, both, least


def grow(block: Block, g: np.ndarray, h: np.ndarray, root_h: np.ndarray, tie: np.ndarray, tree: int, s: TreeSettings, scratch: Scratch) -> tuple[Trees, np.ndarray | None]:
    """A tree per series from the rows' gradients and weights, and the value of every row of boosted trees; ``root_h`` has the weights' first left sums.

    Rows without weight take no part in the fit but get a value. Of two
    children the lighter one's sums are counted and the other's are the rest.
    A row's node is a number: first come the nodes of the level, lighter
    children before the others, then the leaves above it.
    """
    n, lags, nodes, n_rows = len(block.key), s.lags, 2 ** (s.max_depth + 1) - 1, len(block.row_series)
    cuts = block.cuts.shape[1]
    out = Trees(np.full((n, nodes), -1, dtype=np.int16), np.zeros((n, nodes)), np.zeros((n, nodes)))
    owner, heap, ended = np.arange(n), np.zeros(n, dtype=np.int64), np.zeros(0)
    rows = np.arange(n_rows) if s.boosted else np.flatnonzero(h > 0)
    node, flat = block.row_series if s.boosted else block.row_series.take(rows), block.codes.ravel()
    totals = np.array([block.per_series(g), block.per_series(h)])
    left = scratch("left0", 2, cuts, lags, n)
    _root_left(block, g, totals[0], left[0], scratch)
    np.add(root_h, s.penalty, out=left[1])
    all_used = None if not s.tree_features else _chosen(s.tree_features, lags, s.seed, block.key, tree)
    for depth in range(s.max_depth + 1):
        count = len(owner)
        value = -shrunk(totals[0], s.l1) / np.maximum(totals[1] + s.penalty, 1e-300)
        out.value[owner, heap] = value
        if depth == s.max_depth:
            break
        gain, both, least = _gains(left, totals, s, scratch)
        tops, slack = gain.max(axis=0), tie[owner]
        tops *= both
        tops -= least
        if all_used is not None:
            tops[~all_used[owner].T] = -np.inf
        if s.node_features:
            tops[~_chosen(s.node_features, lags, s.seed, block.key[owner], tree, heap + 1).T] = -np.inf
        best, at = slack.copy(), np.full(count, -1, dtype=np.int64)
        for f, (top, enough) in enumerate(zip(tops, tops + slack)):
            better = top > best
            np.copyto(best, enough, where=better)
            np.copyto(at, f, where=better)
        which = np.flatnonzero(at >= 0)
        if not len(which):
            break
        k, who, where, f = len(which), owner[which], heap[which], at[which]
        # The lowest of the cuts that are as good as the best one.
        good = (tops[f, which] - slack[which] + least[which]) / both[which]
        cut = (gain.reshape(-1, lags * count).take(f * count + which, axis=1) >= good).argmax(axis=0)
        out.feature[who, where] = f
        out.cut[who, where] = block.cuts[who, cut]
        on_left = left[:, cut, f, which]
        on_left[1] = np.rint(on_left[1] - s.penalty)
        on_right = totals[:, which] - on_left
        light_right = on_right[1] < on_left[1]
        totals = np.concatenate([np.where(light_right, on_right, on_left), np.where(light_right, on_left, on_right)], axis=1)
        owner = np.concatenate([who, who])
        heap = np.concatenate([2 * where + 1 + light_right, 2 * where + 2 - light_right])
        if depth + 1 == s.max_depth and not s.boosted:
            continue
        # Where each node looks, and the node of the next level for each bin that it finds there.
        looks = np.zeros(count + len(ended), dtype=np.int64)
        looks[which] = f * n_rows
        follows = np.arange(k, k + len(looks))
        stays = np.flatnonzero(at < 0)
        follows[stays] = 2 * k + np.arange(len(stays))
        ended = np.concatenate([value[stays], ended])
        follows = np.repeat(follows[:, None], cuts + 1, axis=1)
        follows[which] = np.arange(k)[:, None] + k * ((np.arange(cuts + 1) > cut[:, None]) != light_right[:, None])
        place = looks.take(node, out=scratch("place", len(node), dtype=np.int64), mode="clip")
        place += rows
        code = flat.take(place, out=scratch("code", len(node), dtype=flat.dtype), mode="clip")
        np.multiply(node, cuts + 1, out=place)
        place += code
        node = follows.ravel().take(place, out=scratch("node", len(node), dtype=np.int64), mode="clip")
        if depth + 1 < s.max_depth:
            light = np.flatnonzero(node < k)
            parents = left if k == count else left.reshape(-1, count).take(which, axis=1, out=scratch("parents", left.size // count, k), mode="clip")
            left = scratch(f"left{1 - depth % 2}", 2, cuts, lags, 2 * k)
            _child_left(block, g, h, light if s.boosted else rows.take(light), node.take(light), block.common[who], totals[:, :k], parents.reshape(2, cuts, lags, k), left, s.penalty, scratch)
    return out, np.concatenate([value, ended]).take(node) if s.boosted else None


@dataclass
class Ensemble:
    """Trees of a block, stacked: arrays (trees, series, nodes), and the level that they start from."""

    base: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def predict(self, recent: np.ndarray) -> np.ndarray:
        """One value per series from its last values (series, lags), the nearest first."""
        trees, series, nodes = self.feature.shape
        at = np.arange(trees * series) * nodes
        first = at.copy()
        who = np.tile(np.arange(series), trees)
        feature, cut = self.feature.ravel(), self.cut.ravel()
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return self.base + self.value.ravel()[at].reshape(trees, series).sum(axis=0)
            right = recent[who, np.maximum(f, 0)] > cut[at]
            at = np.where(inner, first + 2 * (at - first) + 1 + right, at)


def fitted(block: Block, s: TreeSettings) -> Ensemble:
    n, windows, rows = len(block.key), len(block.target), len(block.row_series)
    base = np.bincount(block.series, block.target, n) / block.sizes
    centred = block.target - base[block.series]
    all_starts, all_sizes = np.repeat(block.starts, block.sizes), np.repeat(block.sizes.astype(float), block.sizes)
    place = (np.arange(windows) - all_starts).astype(np.uint64)
    h, sums = np.bincount(block.window_row, minlength=rows).astype(float), np.bincount(block.window_row, centred, rows)
    squares = np.add.reduceat(centred * centred, block.starts)
    guess, parts, scratch = np.zeros(rows), [], Scratch()
    root_h = np.empty((block.cuts.shape[1], s.lags, n))
    _root_left(block, h, block.per_series(h), root_h, scratch)
    for k in range(s.trees):
        if s.row_share < 1 if s.boosted else s.bootstrap:
            seeds, weight, picked = _mixed(s.seed, block.key, k), scratch("weight", windows), scratch("picked", windows, dtype=np.int64)
            for lo in range(0, windows, PIECE):
                some = slice(lo, lo + PIECE)
                draws = _mixed_on(seeds.take(block.series[some]), place[some])
                if s.boosted:
                    weight[some] = draws < np.uint64(int(s.row_share * (2**64 - 1)))
                else:
                    picked[some] = _picked(draws, all_sizes[some], all_starts[some])
            if not s.boosted:
                weight[:] = np.bincount(picked, minlength=windows)
            weighted = weight * centred
            h, sums = np.bincount(block.window_row, weight, rows), np.bincount(block.window_row, weighted, rows)
            squares = np.add.reduceat(weighted * weighted, block.starts)
            _root_left(block, h, block.per_series(h), root_h, scratch)
        gradient = guess * h - sums
        # Squared gradients of all windows: those of a row differ by their targets alone.
        tie = TIE * np.maximum(squares + block.per_series(guess * (gradient - sums)), 0.0)
        tree, values = grow(block, gradient, h, root_h, tie, k, s, scratch)
        if s.boosted:
            tree.value *= s.learning_rate
            values *= s.learning_rate
            guess += values
        else:
            tree.value /= s.trees
        parts.append(tree)
    return Ensemble(base, *(np.array([getattr(t, a) for t in parts]) for a in ("feature", "cut", "value")))


def _remainders(draws: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``draws % sizes`` as floats, exact for ``sizes`` (floats) up to 2^20; divisions of 64-bit numbers are far slower."""
    rest = (draws >> np.uint64(32)).view(np.int64).astype(float)
    low = (draws & np.uint64(0xFFFFFFFF)).view(np.int64).astype(float)
    whole = rest / sizes
    for last in (False, True):
        if last:  # at most 20 bits and 32 make a whole number that a float holds
            rest *= 4294967296.0
            rest += low
            np.divide(rest, sizes, out=whole)
        np.floor(whole, out=whole)
        whole *= sizes
        rest -= whole
    # A quotient next to a whole number may have been rounded to it.
    if rest.min() < 0:
        rest[rest < 0] += sizes[rest < 0]
    if (over := rest >= sizes).any():
        rest[over] -= sizes[over]
    return rest


def _picked(draws: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The window of its own series that each draw, a uniform number, picks."""
    picked = _remainders(draws, sizes) if sizes.max() <= 1 << 20 else draws % sizes.astype(np.uint64)
    picked += starts.astype(picked.dtype)
    return picked.astype(np.int64)


def forecast_block(ys: list[np.ndarray], steps: int, s: TreeSettings) -> np.ndarray:
    """Forecasts (series, steps): each step is predicted from the last values and then becomes one of them."""
    ensemble = fitted(block_of(ys, s), s)
    recent = np.array([y[: -s.lags - 1 : -1] for y in ys])
    ahead = np.empty((len(ys), steps))
    for t in range(steps):
        ahead[:, t] = ensemble.predict(recent)
        recent = np.column_stack([ahead[:, t], recent[:, :-1]])
    return ahead


def blocks(ys: list[np.ndarray], settings: TreeSettings) -> Iterator[list[int]]:
    """Places of series to grow together: of much the same number of bins, as sums are kept for the largest one."""
    bins = [len(binned(y, settings.max_bin)[1]) + 1 for y in ys]
    some, rows = [], 0
    for i in sorted(range(len(ys)), key=bins.__getitem__):
        cells = bins[i] * settings.lags * min(2 ** (settings.max_depth - 1), max(len(ys[j]) for j in (*some, i)))
        if some and (rows + len(ys[i]) > BLOCK_ROWS or (len(some) + 1) * cells > BLOCK_CELLS or len(some) * (bins[i] - bins[some[-1]]) > IDLE_BINS):
            yield some
            some, rows = [], 0
        some.append(i)
        rows += len(ys[i])
    if some:
        yield some


def lag_trees(ys: Column, steps: int, settings: TreeSettings) -> Column:
    """Forecast array of an ensemble per series; series without a single window get null."""

    @F.pandas_udf("array<double>")
    def fit_and_forecast(batch: pd.Series) -> pd.Series:
        result = pd.Series([None] * len(batch), dtype=object)
        usable = [i for i, y in enumerate(batch) if y is not None and len(y) > settings.lags]
        values = [np.asarray(batch.iloc[i], dtype=float) for i in usable]
        for some in blocks(values, settings):
            for j, row in zip(some, forecast_block([values[j] for j in some], steps, settings)):
                result.iloc[usable[j]] = row
        return result

    return fit_and_forecast(ys)


# ------------------------------------------------------------------------ settings

# Public names of settings and the fields above that they set.
BOOSTING_NAMES = {
    "lags": "lags", "n_estimators": "trees", "max_depth": "max_depth", "learning_rate": "learning_rate", "eta": "learning_rate",
    "gamma": "gamma", "min_split_loss": "gamma", "lambda": "penalty", "reg_lambda": "penalty", "alpha": "l1", "reg_alpha": "l1",
    "min_child_weight": "least_weight", "subsample": "row_share", "max_bin": "max_bin", "random_state": "seed", "seed": "seed",
}
FOREST_NAMES = {
    "lags": "lags", "n_estimators": "trees", "max_depth": "max_depth", "min_samples_leaf": "least_weight",
    "bootstrap": "bootstrap", "max_bin": "max_bin", "random_state": "seed",
}


def feature_count(share: float | int | str | None, lags: int) -> int:
    """A number of lags from a share, a count, ``sqrt`` or ``log2``; 0 means all."""
    if share is None or share == 1.0 and isinstance(share, float):
        return 0
    if share in ("sqrt", "log2"):
        return max(1, int(lags**0.5 if share == "sqrt" else np.log2(lags)))
    if isinstance(share, float) and 0 < share < 1:
        return max(1, int(share * lags))
    if isinstance(share, int) and 1 <= share <= lags:
        return share
    raise ValueError(f"features must be a share in (0, 1], a count up to {lags}, 'sqrt' or 'log2', got {share!r}")


def boosting_settings(params: dict) -> TreeSettings:
    params = dict(params)
    objective = params.pop("objective", "reg:squarederror")
    if objective != "reg:squarederror":
        raise ValueError(f"only squared error is supported, got {objective!r}")
    lags = params.get("lags", TreeSettings.lags)
    shares = {field: params.pop(name, None) for name, field in (("colsample_bytree", "tree_features"), ("colsample_bynode", "node_features"))}
    return _settings(params, BOOSTING_NAMES, {f: feature_count(v, lags) for f, v in shares.items()})


def forest_settings(params: dict) -> TreeSettings:
    params = dict(params)
    features = feature_count(params.pop("max_features", None), params.get("lags", TreeSettings.lags))
    return _settings(params, FOREST_NAMES, {"boosted": False, "bootstrap": True, "penalty": 0.0, "node_features": features})


def _settings(params: dict, names: dict[str, str], fixed: dict) -> TreeSettings:
    if unknown := sorted(set(params) - set(names)):
        raise ValueError(f"unknown settings: {unknown}")
    given: dict = {}
    for name, value in params.items():
        if names[name] in given:
            raise ValueError(f"{name} is given twice under two names")
        given[names[name]] = value
    return TreeSettings(**(fixed | given))
