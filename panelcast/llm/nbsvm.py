"""Linear models on n-gram indicators scaled by naive Bayes log-count ratios.

The fitting works on a bounded sample that the caller gathers; scoring is a sum
over a text's features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa


def log_count_ratios(rows: Sequence[np.ndarray], label: np.ndarray, dims: int, least_z: float = 0.0) -> np.ndarray:
    """log((p / |p|) / (q / |q|)) with p, q the smoothed counts of a feature in rows of label 1 and 0.

    A ratio less than ``least_z`` times its standard error is 0.
    """
    smooth = 0.5 if least_z else 1.0
    counts = np.full((2, dims), smooth)
    for row, y in zip(rows, label, strict=True):
        counts[int(y)][row] += 1
    total = np.array([np.sum(label == 0), np.sum(label == 1)]) + 2 * smooth if least_z else counts.sum(axis=1)
    ratio = np.log(counts[1] / total[1]) - np.log(counts[0] / total[0])
    if least_z:
        error = np.sqrt(1 / counts[0] + 1 / counts[1])
        ratio[np.abs(ratio) < least_z * error] = 0
    return ratio.astype(np.float32)


def dual_coordinate_descent(
    rows: Sequence[np.ndarray], values: Sequence[np.ndarray], sign: np.ndarray, bound: np.ndarray, dims: int, epochs: int, seed: int = 5
) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model; ``bound`` is each row's largest dual variable."""
    weight, bias = np.zeros(dims), 0.0
    dual = np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            row, value = rows[i], values[i]
            slope = sign[i] * (weight[row] @ value + bias) - 1.0
            new = min(max(dual[i] - slope / square[i], 0.0), bound[i])
            step = new - dual[i]
            if step:
                dual[i] = new
                weight[row] += step * sign[i] * value
                bias += step * sign[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weight, bias


def sigmoid_fit(decision: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve over decisions, with smoothed targets."""
    high, low = np.sum(label == 1), np.sum(label == 0)
    target = np.where(label == 1, (high + 1) / (high + 2), 1 / (low + 2))
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * decision + shift, -35, 35)))
        gap, spread = p - target, np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([gap @ decision + 1e-3 * (slope - 1), gap.sum()])
        cross = spread @ decision
        curve = np.array([[spread @ decision**2 + 1e-3, cross], [cross, spread.sum() + 1e-6]])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


@dataclass
class LinearModel:
    """``score`` of a text: sigmoid of slope * decision + shift."""

    weight: np.ndarray  # of a feature, its ratio included
    square: np.ndarray | None  # squared ratios; None where rows are not brought to length 1
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def decision(self, row: np.ndarray) -> float:
        total = float(self.weight[row].sum())
        if self.square is not None:
            size = float(self.square[row].sum())
            total = total / size**0.5 if size > 0 else 0.0
        return total + self.bias

    def score(self, row: np.ndarray) -> float:
        z = self.slope * self.decision(row) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))

    def scores(self, rows: Iterator[np.ndarray]) -> pa.Array:
        return pa.array([self.score(row) for row in rows], pa.float64())


def constant_model(share: float, dims: int) -> LinearModel:
    """The model where the sample shows one class or none: the smoothed share of label 1."""
    return LinearModel(np.zeros(dims, np.float32), None, float(np.log(share / (1 - share))))


def fit(
    rows: Sequence[np.ndarray],
    label: np.ndarray,
    dims: int,
    trust: np.ndarray | None = None,
    truth: np.ndarray | None = None,
    penalty: float = 1.0,
    unit: bool = True,
    least_z: float = 0.0,
    epochs: int = 20,
    unsure: np.ndarray | None = None,
) -> LinearModel:
    """The hinge model on four fifths of the rows, its sigmoid on the others.

    ``trust`` in 0..1 scales how far a row may pull; ``truth`` are the labels of
    the sigmoid where they differ from ``label``. Rarer labels weigh more, so
    that both classes weigh the same. ``unsure`` marks rows whose label nobody
    gave: they train the hinge model and are kept from the sigmoid.
    """
    truth = label if truth is None else truth
    ones = int(np.sum(label == 1))
    if ones < 3 or len(label) - ones < 3:
        return constant_model((int(np.sum(truth == 1)) + 1) / (len(truth) + 2), dims)
    order = np.random.default_rng(3).permutation(len(rows))
    later = np.zeros(len(rows), dtype=bool)
    for y in (0, 1):
        mine = order[(label[order] == y) & (True if unsure is None else ~unsure[order])]
        later[mine[::5]] = True
    fitted = np.flatnonzero(~later)
    ratio = log_count_ratios([rows[i] for i in fitted], label[fitted], dims, least_z)
    used, values = [], []
    for i in fitted:
        row = rows[i][ratio[rows[i]] != 0]
        value = ratio[row].astype(float)
        size = float(value @ value) ** 0.5
        used.append(row)
        values.append(value / size if unit and size else value)
    share = np.array([np.mean(label[fitted] == 0), np.mean(label[fitted] == 1)])
    bound = penalty * 0.5 / share[label[fitted].astype(int)]
    if trust is not None:
        bound = bound * trust[fitted]
    weight, bias = dual_coordinate_descent(used, values, np.where(label[fitted] == 1, 1.0, -1.0), bound, dims, epochs)
    model = LinearModel((weight * ratio).astype(np.float32), ratio**2 if unit else None, bias)
    tested = np.flatnonzero(later)
    decision = np.array([model.decision(rows[i]) for i in tested])
    model.slope, model.shift = sigmoid_fit(decision, truth[tested])
    return model
