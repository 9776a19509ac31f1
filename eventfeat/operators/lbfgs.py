"""L-BFGS as Spark ML runs it (Breeze's: ten corrections, strong Wolfe line search with
cubic steps, the same limits and ends), for objectives that are summed up outside the JVM.
Vectors are the size of the model; rows are the objective's matter."""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np

# --- fixed values of the library
CORRECTIONS, WINDOW, ZOOMS, STEPS = 10, 20, 10, 10
DECREASE, CURVATURE = 1e-4, 0.9


class _Failed(Exception):
    """No usable step; tried again once without the corrections."""


class _Point(NamedTuple):
    t: float
    value: float
    slope: float
    x: np.ndarray
    gradient: np.ndarray


def minimize(objective: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, max_iter: int,
             tol: float) -> tuple[np.ndarray, list[float]]:
    """The last point and the value of each iteration.  Ends after ``max_iter`` iterations,
    when the value fell by at most ``tol`` times the first value in 20 iterations, when the
    gradient's norm is at most ``tol`` times the value, or when no step can be found."""
    value, gradient = objective(x)
    first, window, history, pairs, done, failed = value, [math.inf], [value], [], 0, False
    while not (done >= max_iter or len(window) >= 2 and abs(value - max(window)) <= tol * abs(first)
               or np.linalg.norm(gradient) <= max(tol * abs(value), 1e-8)):
        try:
            direction = _direction(gradient, pairs)
            p = _search(objective, _Point(0.0, value, float(gradient @ direction), x, gradient), direction,
                        1.0 if done else 1.0 / np.linalg.norm(direction))
            if p.t * np.linalg.norm(gradient) < 1e-10:
                raise _Failed("step too small")
        except _Failed:
            history.append(value)
            if failed:
                break
            failed, pairs = True, []
            continue
        pairs = [(p.x - x, p.gradient - gradient), *pairs][:CORRECTIONS]
        x, value, gradient, done, failed = p.x, p.value, p.gradient, done + 1, False
        window = [*window, value][-WINDOW:]
        history.append(value)
    return x, history


def _direction(gradient: np.ndarray, pairs: list) -> np.ndarray:
    """Two-loop recursion; ``pairs`` has the newest step and change of the gradient first."""
    d, kept = gradient.copy(), []
    for s, y in pairs:
        rho = float(s @ y)
        a = float(s @ d) / rho if rho else math.nan
        if math.isnan(a):
            raise _Failed("corrections are not numbers")
        d -= a * y
        kept.append((s, y, rho, a))
    if pairs:
        s, y = pairs[0]
        if not s @ y >= 0:
            raise _Failed("curvature is negative")
        d *= float(s @ y) / float(y @ y)
    for s, y, rho, a in reversed(kept):
        d += (a - float(y @ d) / rho) * s
    return -d


def _search(objective, start: _Point, direction: np.ndarray, t: float) -> _Point:
    """A point of sufficient decrease whose slope is flat enough."""
    if start.slope > 0:
        raise _Failed("not a descent")

    def at(t: float) -> _Point:
        x = start.x + t * direction
        value, gradient = objective(x)
        return _Point(t, value, float(gradient @ direction), x, gradient)

    def too_high(c: _Point) -> bool:
        return c.value > start.value + DECREASE * c.t * start.slope

    def flat(c: _Point) -> bool:
        return abs(c.slope) <= CURVATURE * abs(start.slope)

    def zoom(low: _Point, high: _Point) -> _Point:
        for _ in range(ZOOMS):
            t = _cubic(high, low) if low.t > high.t else _cubic(low, high)
            if math.isnan(t):
                break
            c = at(t)
            if too_high(c) or c.value >= low.value:
                high = c
                continue
            if flat(c):
                return c
            if c.slope * (high.t - low.t) >= 0:
                high = low
            low = c
        raise _Failed("zoom failed")

    low = start
    for i in range(STEPS):
        c = at(t)
        if not math.isfinite(c.value):
            t /= 2
            continue
        if too_high(c) or i > 0 and c.value >= low.value:
            return zoom(low, c)
        if flat(c):
            return c
        if c.slope >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise _Failed("line search failed")


def _cubic(left: _Point, right: _Point) -> float:
    """Minimum of the cubic through two points, at least a tenth of the way off either."""
    width = right.t - left.t
    d1 = left.slope + right.slope + 3 * (left.value - right.value) / width if width else math.nan
    root = d1 * d1 - left.slope * right.slope
    d2 = math.sqrt(root) if root >= 0 else math.nan
    below = right.slope - left.slope + 2 * d2
    t = right.t - width * (right.slope + d2 - d1) / below if below else math.nan
    return t if math.isnan(t) else min(max(t, left.t + 0.1 * width), left.t + 0.9 * width)
