"""Forecasts from the strongest frequencies, and complex exponential smoothing, for stacks of series."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np


@dataclass(frozen=True)
class WaveSettings:
    """``keep`` frequencies around a polynomial trend of ``degree``, which is taken out first; a degree of -1 means none."""

    keep: int = 10
    degree: int = 1

    def __post_init__(self) -> None:
        if self.keep < 1 or not -1 <= self.degree <= 5:
            raise ValueError("keep one frequency at least; the degree of the trend lies between -1 and 5")

    @property
    def least_length(self) -> int:
        return max(4, 2 * (self.degree + 1))


def trend_of(y: np.ndarray, degree: int, steps: int) -> np.ndarray:
    """Least-squares polynomial of each row over its own steps and ``steps`` more."""
    n = y.shape[1]
    if degree < 0:
        return np.zeros((len(y), n + steps))
    u = (np.arange(n + steps) - (n - 1) / 2) / max(n - 1, 1)
    x = np.vander(u, degree + 1)
    return (x @ np.linalg.lstsq(x[:n], y.T, rcond=None)[0]).T


def strongest_waves(y: np.ndarray, steps: int, s: WaveSettings) -> np.ndarray:
    """Forecasts (series, steps): the trend and the ``keep`` largest waves of the periodogram, carried on."""
    n = y.shape[1]
    trend = trend_of(y, s.degree, steps)
    waves = np.fft.rfft(y - trend[:, :n], axis=1)
    weight = np.abs(waves)
    if n % 2 == 0:
        weight[:, -1] /= 2  # the fastest wave has no mirror image
    weight[:, 0] = np.where(s.degree < 0, np.inf, 0.0)  # the mean belongs to the trend
    keep = s.keep + (s.degree < 0)
    order = np.argsort(-weight, axis=1, kind="stable")
    held = np.zeros(waves.shape, dtype=bool)
    np.put_along_axis(held, order[:, :keep], True, axis=1)
    again = np.fft.irfft(np.where(held, waves, 0.0), n, axis=1)
    return trend[:, n:] + again[:, np.arange(steps) % n]


# ------------------------------------------------------- complex smoothing


@dataclass(frozen=True)
class ComplexSettings:
    """Weight ``a0 + i a1`` of Svetunkov, Kourentzes and Ord (2022); ``weights`` fixes it, else the grid is searched."""

    weights: tuple[float, float] | None = None
    real: tuple[float, ...] = tuple(round(0.9 + 0.1 * k, 1) for k in range(11))
    imaginary: tuple[float, ...] = (0.7, 0.85, 0.95, 0.98, 1.0, 1.02, 1.05, 1.15, 1.3)

    def __post_init__(self) -> None:
        if self.weights is not None and len(self.weights) != 2:
            raise ValueError("weights must be two numbers")
        if self.weights is None and not any(stable(*w) for w in product(self.real, self.imaginary)):
            raise ValueError("no weight of the grid lets old errors die away")


def stable(a0: float, a1: float) -> bool:
    """Whether old errors die away: the discounting matrix has its roots inside the unit circle."""
    discount = np.array([[1 - a0 + a1, -(1 - a1)], [1 - a0 - a1, 1 - a0]])
    return bool(np.abs(np.linalg.eigvals(discount)).max() < 1)


def complex_smoothing(y: np.ndarray, steps: int, s: ComplexSettings) -> np.ndarray:
    """Forecasts (series, steps).

    A complex state, the level and an unseen potential, is drawn towards the
    complex number of value and error by a complex weight; the weight with the
    least squared one-step error is taken.
    """
    tried = [s.weights] if s.weights is not None else [w for w in product(s.real, s.imaginary) if stable(*w)]
    a = np.array([complex(*w) for w in tried])
    keep = (1 + 1j) - a
    state = np.repeat((y[:, :1] * (1 + 0j)), len(a), axis=1)
    state += 1j * y[:, :1] / 2
    sse = np.zeros(state.shape)
    for t in range(y.shape[1]):
        error = y[:, t, None] - state.real
        sse += error * error
        state = a * (y[:, t, None] + 1j * error) + keep * state
    rows, best = np.arange(len(y)), sse.argmin(axis=1)
    state, a, keep = state[rows, best], a[best], keep[best]
    ahead = np.empty((len(y), steps))
    for t in range(steps):
        ahead[:, t] = state.real
        state = a * state.real + keep * state
    return ahead
