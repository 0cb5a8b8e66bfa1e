"""Structural models by the Kalman filter for stacks of series, the noise found by expectation maximisation.

A level, with ``trend`` also its slope, follows a random walk and is seen with
noise. Steps without a value are passed over: the state is predicted and not
corrected. All series of a stack share the matrices of the model, not its noise.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DIFFUSE = 1e6  # variance of the first state, in units of the variance of the values


@dataclass(frozen=True)
class KalmanSettings:
    """``noise`` fixes the variances (of the values, level, slope) in units of the series' own variance; else ``rounds`` of estimation.

    With ``zeros_missing`` a 0 is a step without a value.
    """

    trend: bool = False
    rounds: int = 10
    noise: tuple[float, ...] | None = None
    zeros_missing: bool = False

    def __post_init__(self) -> None:
        if self.rounds < 1:
            raise ValueError("rounds must be 1 or more")
        if self.noise is not None and (len(self.noise) != self.size + 1 or min(self.noise) < 0 or self.noise[0] <= 0):
            raise ValueError(f"noise must be {self.size + 1} variances, the first above 0")

    @property
    def size(self) -> int:
        return 2 if self.trend else 1

    @property
    def move(self) -> np.ndarray:
        return np.array([[1.0, 1.0], [0.0, 1.0]]) if self.trend else np.array([[1.0]])


@dataclass
class Pass:
    """States and covariances per step: predicted, corrected, and whether a value was seen."""

    expected: np.ndarray  # (steps, series, size)
    expected_cov: np.ndarray  # (steps, series, size, size)
    state: np.ndarray
    cov: np.ndarray


def filtered(y: np.ndarray, seen: np.ndarray, start: np.ndarray, r: np.ndarray, q: np.ndarray, s: KalmanSettings) -> Pass:
    """One pass forward; ``r`` (series) and ``q`` (series, size) are the variances of the noise."""
    n, k, move = y.shape[1], s.size, s.move
    steps = np.eye(k) * q[:, None, :]
    x, cov = start, np.broadcast_to(np.eye(k) * DIFFUSE, (len(y), k, k))
    out = Pass(*(np.empty((n, len(y), *shape)) for shape in ((k,), (k, k), (k,), (k, k))))
    for t in range(n):
        if t:
            x, cov = x @ move.T, move @ cov @ move.T + steps
        out.expected[t], out.expected_cov[t] = x, cov
        gain = np.where(seen[:, t], 1.0, 0.0)[:, None] * cov[:, :, 0] / (cov[:, 0, 0] + r)[:, None]
        x = x + gain * (y[:, t] - x[:, 0])[:, None]
        cov = cov - gain[:, :, None] * cov[:, 0:1, :]
        out.state[t], out.cov[t] = x, cov
    return out


def smoothed(f: Pass, s: KalmanSettings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(states, covariances, covariances of each state with the one before) given all values (Rauch, Tung and Striebel)."""
    x, cov = f.state.copy(), f.cov.copy()
    cross = np.zeros_like(f.cov)
    for t in range(len(x) - 2, -1, -1):
        back = f.cov[t] @ s.move.T @ np.linalg.inv(f.expected_cov[t + 1])
        x[t] += np.einsum("sij,sj->si", back, x[t + 1] - f.expected[t + 1])
        cov[t] += back @ (cov[t + 1] - f.expected_cov[t + 1]) @ back.transpose(0, 2, 1)
        cross[t + 1] = cov[t + 1] @ back.transpose(0, 2, 1)
    return x, cov, cross


def estimated(y: np.ndarray, seen: np.ndarray, start: np.ndarray, s: KalmanSettings) -> tuple[np.ndarray, np.ndarray]:
    """Variances of the noise after ``rounds`` of expectation maximisation."""
    r = np.full(len(y), 0.5)
    q = np.full((len(y), s.size), 0.1)
    count = np.maximum(seen.sum(axis=1), 1)
    for _ in range(s.rounds):
        x, cov, cross = smoothed(filtered(y, seen, start, r, q, s), s)
        rest = (y.T - x[:, :, 0]) ** 2 + cov[:, :, 0, 0]
        r = np.maximum((rest * seen.T).sum(axis=0) / count, 1e-9)
        jump = x[1:] - x[:-1] @ s.move.T
        turned = cross[1:] @ s.move.T
        spread = cov[1:] - turned - turned.transpose(0, 1, 3, 2) + s.move @ cov[:-1] @ s.move.T
        q = np.maximum((jump**2 + np.einsum("tsii->tsi", spread)).mean(axis=0), 1e-9)
    return r, q


def forecast_block(y: np.ndarray, steps: int, s: KalmanSettings) -> np.ndarray:
    """Forecasts (series, steps): the last state moved on."""
    seen = np.isfinite(y) & ~((y == 0) & s.zeros_missing)
    count = seen.sum(axis=1)
    mean = np.where(seen, y, 0.0).sum(axis=1) / np.maximum(count, 1)
    z = np.where(seen, y - mean[:, None], 0.0)
    size = np.sqrt((z * z).sum(axis=1) / np.maximum(count, 1))
    size[size == 0] = 1.0
    z /= size[:, None]
    start = np.zeros((len(y), s.size))
    if s.noise is None:
        r, q = estimated(z, seen, start, s)
    else:
        r, q = np.full(len(y), s.noise[0]), np.tile(np.array(s.noise[1:], dtype=float), (len(y), 1))
    x = filtered(z, seen, start, r, q, s).state[-1]
    ahead = np.empty((len(y), steps))
    for t in range(steps):
        x = x @ s.move.T
        ahead[:, t] = x[:, 0]
    return ahead * size[:, None] + mean[:, None]
