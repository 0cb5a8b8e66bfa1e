"""Trees per series against a plain loop that splits one node at a time."""

import dataclasses
import zlib

import numpy as np
import pytest

from panelcast import make_model
from panelcast.functions import trees as T
from panelcast.functions.trees import BLOCK_ROWS, TreeSettings, binned, boosting_settings, feature_count, forecast_block, forest_settings


def loop_bins(y, most):
    """(bin of each value, cuts) one value at a time."""
    distinct = sorted(set(y))
    label, below = {}, 0
    for k, v in enumerate(distinct):
        label[v] = k if len(distinct) <= most else below * most // len(y)
        below += list(y).count(v)
    names = sorted(set(label.values()))
    cuts = [(max(v for v in distinct if label[v] == a) + min(v for v in distinct if label[v] == b)) / 2 for a, b in zip(names, names[1:])]
    return [names.index(label[v]) for v in y], cuts


def soft(g, l1):
    return (abs(g) - l1) * (1 if g > 0 else -1) if abs(g) > l1 else 0.0


def loop_tree(rows, g, h, cuts, s, key, tree):
    """Nested tuples (feature, bin, left, right) or a leaf value."""
    tie = T.TIE * sum(v * v for v in g)
    masks = T._chosen(s.tree_features, s.lags, s.seed, np.array([key]), tree)[0] if s.tree_features else np.ones(s.lags, bool)

    def score(a, b):
        return soft(a, s.l1) ** 2 / max(b + s.penalty, 1e-9)

    def node(own, depth, heap):
        total_g, total_h = sum(g[i] for i in own), sum(h[i] for i in own)
        value = -soft(total_g, s.l1) / max(total_h + s.penalty, 1e-300)
        if depth == s.max_depth:
            return value
        used = masks & (T._chosen(s.node_features, s.lags, s.seed, np.array([key]), tree, np.array([heap + 1]))[0] if s.node_features else True)
        best = None
        for f in range(s.lags):
            found = []
            for b in range(len(cuts)):
                left = [i for i in own if rows[i][f] <= b]
                gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                if hl >= max(s.least_weight, 1e-9) and total_h - hl >= max(s.least_weight, 1e-9):
                    found.append((score(gl, hl) + score(total_g - gl, total_h - hl) - score(total_g, total_h) - s.gamma, b))
            if found and used[f]:
                top = max(x for x, _ in found)
                if top > (tie if best is None else best[0] + tie):
                    best = (top, f, next(b for x, b in found if x >= top - tie))
        if best is None:
            return value
        _, f, b = best
        left, right = [i for i in own if rows[i][f] <= b], [i for i in own if rows[i][f] > b]
        return f, b, node(left, depth + 1, 2 * heap + 1), node(right, depth + 1, 2 * heap + 2)

    return node(list(range(len(rows))), 0, 0)


def loop_forecast(y, steps, s):
    code, cuts = loop_bins(y, s.max_bin)
    rows = [[code[t - 1 - f] for f in range(s.lags)] for t in range(s.lags, len(y))]
    target = [float(v) for v in y[s.lags :]]
    base, key = sum(target) / len(target), zlib.crc32(np.asarray(y, float).tobytes())
    guess, made = [0.0] * len(rows), []

    def at(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    inside = np.arange(len(rows))
    for k in range(s.trees):
        h = [1.0] * len(rows)
        if s.row_share < 1:
            h = [float(v < np.uint64(int(s.row_share * (2**64 - 1)))) for v in T._mixed(s.seed, key, k, inside)]
        if s.bootstrap:
            drawn = T._mixed(s.seed, key, k, inside) % np.uint64(len(rows))
            h = [float((drawn == i).sum()) for i in range(len(rows))]
        g = [(p - (v - base) if s.boosted else base - v) * w for p, v, w in zip(guess, target, h)]
        tree = loop_tree(rows, g, h, cuts, s, key, k)
        made.append(tree)
        guess = [p + s.learning_rate * at(tree, r) for p, r in zip(guess, rows)]
    recent, out = list(y[: -s.lags - 1 : -1]), []
    for _ in range(steps):
        row = [sum(v > c for c in cuts) for v in recent]
        total = sum(at(t, row) for t in made) * (s.learning_rate if s.boosted else 1 / s.trees)
        out.append(base + total)
        recent = [out[-1], *recent[:-1]]
    return out


def some_series():
    rng = np.random.default_rng(12)
    return [
        rng.normal(10, 3, 60),
        np.where(rng.random(90) < 0.4, rng.integers(1, 9, 90), 0).astype(float),
        np.tile([1.0, 5.0, 2.0, 8.0, 3.0, 9.0, 4.0], 6),
        np.full(30, 5.0),
        rng.normal(0, 1, 4),
        1e6 + rng.normal(0, 1, 50),
    ]


@pytest.mark.parametrize(
    "settings",
    [
        TreeSettings(lags=3, trees=6, max_depth=3),
        TreeSettings(lags=2, trees=4, max_depth=2, l1=1.5, gamma=0.7, least_weight=4),
        TreeSettings(lags=3, trees=3, max_depth=4, max_bin=5, penalty=0.0, learning_rate=1.0),
        TreeSettings(lags=3, trees=4, max_depth=3, row_share=0.6, tree_features=2, node_features=2),
        TreeSettings(lags=3, trees=1, max_depth=3, boosted=False, penalty=0.0),
        TreeSettings(lags=3, trees=5, max_depth=3, boosted=False, penalty=0.0, bootstrap=True, node_features=1),
    ],
)
def test_trees_equal_a_plain_loop(settings):
    ys = some_series()
    got = forecast_block(ys, 5, settings)
    for y, row in zip(ys, got):
        assert row == pytest.approx(loop_forecast(y, 5, settings), rel=1e-7, abs=1e-7)


def test_bins_keep_order_and_equal_values_together():
    rng = np.random.default_rng(1)
    for y in (rng.normal(size=500), rng.integers(0, 9, 500).astype(float), np.full(20, 3.0), np.array([2.0])):
        for most in (2, 7, 1000):
            code, cuts = binned(y, most)
            label, same = loop_bins(y, most)
            assert code.tolist() == label and cuts.tolist() == same
            assert len(cuts) < most and (np.searchsorted(cuts, y, side="left") == code).all()


def test_a_series_does_not_depend_on_its_neighbours():
    ys = some_series()
    settings = TreeSettings(lags=3, trees=5, max_depth=3, boosted=False, bootstrap=True, node_features=2)
    alone = [forecast_block([y], 4, settings)[0] for y in ys]
    assert np.allclose(forecast_block(ys, 4, settings), alone) and np.allclose(forecast_block(ys[::-1], 4, settings), alone[::-1])
    other = dataclasses.replace(settings, seed=8)
    assert not np.allclose(forecast_block(ys[:2], 4, other), alone[:2])
    assert BLOCK_ROWS > 10_000


def test_penalties_shrink_and_a_large_one_leaves_the_mean():
    y = np.random.default_rng(3).normal(5, 2, 80)
    mean = y[7:].mean()
    for settings in (boosting_settings({"lambda": 1e12}), boosting_settings({"alpha": 1e12}), boosting_settings({"gamma": 1e12, "lambda": 0})):
        assert forecast_block([y], 3, settings)[0] == pytest.approx([mean] * 3, abs=1e-6)
    free, held = (np.abs(forecast_block([y], 1, boosting_settings({"n_estimators": 1, "lambda": v}))[0] - mean) for v in (0, 30))
    assert held < free


def test_settings_are_read_and_checked():
    usual = {"objective": "reg:squarederror", "lags": 7, "max_depth": 6, "learning_rate": 0.3, "gamma": 0, "lambda": 1, "alpha": 0}
    assert boosting_settings(usual) == TreeSettings()
    assert forest_settings({"lags": 7, "n_estimators": 100, "max_depth": 6, "max_features": "sqrt"}) == TreeSettings(boosted=False, bootstrap=True, penalty=0.0, node_features=2)
    assert make_model("XGBModel", usual | {"nthread": 1}).min_length == 8
    assert [feature_count(v, 7) for v in (None, 1.0, 0.5, 3, "log2")] == [0, 0, 3, 3, 2]
    for bad in ({"lambda": 1, "reg_lambda": 2}, {"subsample": 0}, {"max_depth": 0}, {"max_depth": 40}, {"alpha": -1}, {"colsample_bytree": 2.0}, {"lags": 0}, {"surprise": 1}):
        with pytest.raises(ValueError):
            boosting_settings(bad)
    with pytest.raises(ValueError):
        forest_settings({"lambda": 1})


def counted_blocks(monkeypatch, ys, settings):
    """How many values the histograms of all trees have counted."""
    counted = []
    monkeypatch.setattr(T, "_add", lambda key, xs, *rest, add=T._add: (counted.append(len(key) * len(xs)), add(key, xs, *rest))[1])
    forecast_block(ys, 1, settings)
    return sum(counted)


@pytest.mark.parametrize("settings", [boosting_settings({"n_estimators": 4}), forest_settings({"n_estimators": 4})])
def test_idle_days_and_heavier_children_are_not_counted(monkeypatch, settings):
    rng = np.random.default_rng(5)
    ys = [np.where(rng.random(900) < 0.2, rng.integers(1, 40, 900), 0).astype(float) for _ in range(3)]
    # Every window, lag and level once for gradients and once for weights would be all.
    every = sum(len(y) - settings.lags for y in ys) * settings.lags * settings.max_depth * settings.trees * 2
    assert 0 < counted_blocks(monkeypatch, ys, settings) < every / 10


def test_equal_windows_are_one_row():
    y = np.tile([0.0, 0.0, 0.0, 0.0, 0.0, 6.0, 2.0], 40)
    for lags in (7, 40):  # more codes than a whole number of 64 bits holds
        block = T.block_of([y, y[3:]], TreeSettings(lags=lags))
        assert len(block.row_series) == 14 and block.each.sum() == len(block.cell)
        assert (np.bincount(block.window_row).sum(), len(block.window_row)) == (len(block.target), 2 * len(y) - 3 - 2 * lags)


def test_rows_left_out_of_a_boosted_tree_get_its_leaf():
    ys = some_series()
    settings = TreeSettings(lags=2, trees=8, max_depth=4, row_share=0.3, least_weight=2, l1=0.1)
    for y, row in zip(ys, forecast_block(ys, 3, settings)):
        assert row == pytest.approx(loop_forecast(y, 3, settings), rel=1e-7, abs=1e-7)


def test_blocks_hold_series_of_like_bins_and_bounded_sums():
    rng = np.random.default_rng(2)
    ys = [rng.integers(0, [3, 5000][i % 2], 3000).astype(float) for i in range(60)]
    made = list(T.blocks(ys, TreeSettings(max_bin=2000)))
    assert sorted(i for some in made for i in some) == list(range(60))
    assert sum(len({i % 2 for i in some}) > 1 for some in made) <= 1
    for some in made:
        assert sum(len(ys[i]) for i in some) <= BLOCK_ROWS
        assert len(some) == 1 or len(some) * 7 * 32 * max(len(np.unique(ys[i])) for i in some if i % 2 == 0 or len(some) > 1) <= 2 * T.BLOCK_CELLS


def test_a_few_series_of_many_bins_do_not_widen_the_others():
    rng = np.random.default_rng(4)
    idle = [np.where(rng.random(400) < 0.3, rng.random(400), 0.0) for _ in range(60)]
    busy = [np.arange(400.0) % 64 for _ in range(2)]
    ys, settings = busy + idle, TreeSettings()
    made = list(T.blocks(ys, settings))
    width = [T.block_of([ys[i] for i in some], settings).cuts.shape[1] for some in made]
    assert sorted(i for some in made for i in some) == list(range(62))
    assert sorted((len(some), bool(w > 40)) for some, w in zip(made, width)) == [(2, True), (60, False)]


@pytest.mark.parametrize("size", [1, 3, 2466, 99991, 1 << 20])
def test_draws_pick_by_the_remainder(size):
    step, few = np.uint64(size), np.arange(300, dtype=np.uint64)
    top = np.uint64(2**64 - 1) // step
    draws = np.concatenate([T._mixed(5, np.arange(5000)), few * step, few, (top - few) * step, (top - few) * step - np.uint64(1), few << np.uint64(32)])
    assert (T._remainders(draws, np.full(len(draws), float(size))) == draws % step).all()
    starts = np.arange(len(draws)) % 7
    assert (T._picked(draws, np.full(len(draws), float(size)), starts) == (draws % step).astype(np.int64) + starts).all()


def test_memory_of_a_block_is_used_again():
    rng = np.random.default_rng(6)
    ys = [np.where(rng.random(800) < 0.3, rng.integers(1, 60, 800), 0).astype(float) for _ in range(8)]
    settings = boosting_settings({"n_estimators": 4})
    block, scratch = T.block_of(ys, settings), T.Scratch()
    weights = np.bincount(block.window_row, minlength=len(block.row_series)).astype(float)
    root = np.empty((block.cuts.shape[1], settings.lags, len(ys)))
    T._root_left(block, weights, block.per_series(weights), root, scratch)

    def grown():
        tree, values = T.grow(block, weights * np.sin(np.arange(len(weights))), weights, root, np.zeros(len(ys)), 0, settings, scratch)
        return tree.value.tolist(), values.tolist(), {k: v.ctypes.data for k, v in scratch.kept.items()}

    first, again = grown(), grown()
    assert first == again
