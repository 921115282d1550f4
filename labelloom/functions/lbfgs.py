"""L-BFGS with a strong Wolfe line search, step by step as in Breeze, which Spark ML uses, so that both take the same points.

A minimizer is a generator: it yields the point at which it wants the objective and is sent (value, gradient), so that several of them can share
a pass over the data. Its memory of past steps lies in an unnamed file, as it is ten times two vectors of the model's size.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Generator

import numpy as np

Minimizer = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]

MEMORY = 10  # steps
SEARCHES = 10  # of a line search, and of its zoom


class _Failed(Exception):
    """The search found no step, or the memory is of no use."""


class _History:
    """The last ``MEMORY`` steps and differences of gradients, newest first."""

    def __init__(self, size: int):
        self.file = tempfile.TemporaryFile()
        self.size, self.added, self.rho = size, 0, []

    def _vector(self, place: int, mode: str = "r") -> np.memmap:
        return np.memmap(self.file, np.float64, mode, offset=8 * self.size * place, shape=(self.size,))

    def add(self, step: np.ndarray, change: np.ndarray) -> None:
        at = self.added % MEMORY
        self.file.truncate(max(16 * self.size * min(MEMORY, self.added + 1), 16 * self.size * (at + 1)))
        for place, vector in ((2 * at, step), (2 * at + 1, change)):
            self._vector(place, "r+")[:] = vector
        self.rho = [(at, float(step @ change), float(change @ change)), *self.rho][:MEMORY]
        self.added += 1

    def clear(self) -> None:
        self.rho = []

    def descent(self, grad: np.ndarray) -> np.ndarray:
        out, parts = grad.copy(), []
        scale = 1.0
        if self.rho:
            _, sy, yy = self.rho[0]
            if sy < 0 or math.isnan(sy) or yy == 0:
                raise _Failed
            scale = sy / yy
        for at, rho, _ in self.rho:
            a = float(self._vector(2 * at) @ out) / rho if rho else math.nan
            if math.isnan(a):
                raise _Failed
            out -= a * self._vector(2 * at + 1)
            parts.append(a)
        out *= scale
        for (at, rho, _), a in zip(reversed(self.rho), reversed(parts), strict=True):
            beta = float(self._vector(2 * at + 1) @ out) / rho
            out += (a - beta) * self._vector(2 * at)
        out *= -1.0
        return out


def _between(low: tuple, high: tuple) -> float:
    """Minimum of the cubic through two points (t, value, slope), not too close to either."""
    (lt, lv, ld), (rt, rv, rd) = (low, high) if low[0] <= high[0] else (high, low)
    d1 = ld + rd - 3 * (lv - rv) / (lt - rt)
    under = d1 * d1 - ld * rd
    d2 = math.sqrt(under) if under >= 0 else math.nan
    below = rd - ld + 2 * d2
    t = rt - (rt - lt) * (rd + d2 - d1) / below if below else math.nan
    least, most = lt + 0.1 * (rt - lt), lt + 0.9 * (rt - lt)
    return least if t < least else most if t > most else t


def _line_search(x: np.ndarray, way: np.ndarray, value: float, slope: float, first: float):
    """The step, and the value and gradient there. Points are (t, value, slope)."""
    if slope > 0:
        raise _Failed
    seen = None

    def at(t: float):
        nonlocal seen
        got = yield x + t * way
        seen = got
        return t, got[0], float(got[1] @ way)

    def zoom(low: tuple, high: tuple):
        for _ in range(SEARCHES):
            c = yield from at(_between(low, high))
            if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
                high = c
                continue
            if abs(c[2]) <= 0.9 * abs(slope):
                return c[0]
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise _Failed

    low, t, step = (0.0, value, slope), first, None
    for i in range(SEARCHES):
        c = yield from at(t)
        if not math.isfinite(c[1]):
            t /= 2.0
            continue
        if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            step = yield from zoom(low, c)
        elif abs(c[2]) <= 0.9 * abs(slope):
            step = t
        elif c[2] >= 0:
            step = yield from zoom(c, low)
        if step is not None:
            return step, *seen
        low, t = c, 1.5 * t
    raise _Failed


def minimize(x: np.ndarray, max_iter: int, tol: float = 1e-6) -> Minimizer:
    """Yields points, returns the last one after ``max_iter`` steps, or where value or gradient change by less than ``tol``."""
    value, grad = yield x
    start, past, steps, failed, history = value, [math.inf], 0, False, _History(len(x))
    while steps < max_iter and np.linalg.norm(grad) > max(tol * value, 1e-8):
        if len(past) > 1 and abs(value - max(past)) <= tol * start:
            break
        try:
            way = history.descent(grad)
            first = 1.0 / float(np.linalg.norm(way)) if steps == 0 else 1.0
            step, new_value, new_grad = yield from _line_search(x, way, value, float(grad @ way), first)
            if step * np.linalg.norm(grad) < 1e-10:
                raise _Failed
        except _Failed:
            if failed:
                break
            failed = True
            history.clear()
            continue
        way *= step
        x = x + way
        if steps + 1 < max_iter:
            history.add(way, new_grad - grad)
        value, grad, steps, failed = new_value, new_grad, steps + 1, False
        past = [*past, value][-20:]
    return x
