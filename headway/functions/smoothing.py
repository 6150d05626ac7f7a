"""Additive Holt-Winters smoothing with a weekly season, for one series at a time.

For given weights every one-step error is linear in the nine starting states (level, trend and the
season's seven values), so the best start is a least-squares solution and only the three weights
need a search: a coarse grid, then a bounded descent from its best points. The season's values are
only defined up to a constant that the level takes up; the solution of least norm settles that.
"""

from __future__ import annotations

import numpy as np

SEASON = 7
STATES = SEASON + 2
#: Weights stay inside these, so that the errors of any start fade.
LOWEST, HIGHEST = 1e-4, 1 - 1e-4
#: Points of the first grid along each weight; grid points that a descent begins at.
GRID = (0.05, 0.2, 0.4, 0.6, 0.8, 0.95)
STARTS = 3
#: A descent begins with steps of this length and ends when they are shorter than the last.
FIRST_STEP, TOLERANCE = 0.08, 1e-3


def _design(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Errors of a start of zeros, and how each starting state changes them, per weight triple.

    The zero start and each state at one are smoothed together, in the error-correction form: with
    the error e the level moves by alpha e, the trend by alpha beta e, the season by gamma e.
    Returns arrays of errors (weights, days) and of changes (weights, days, states).
    """
    alpha, beta, gamma = (w[:, None] for w in weights.T)
    drift = alpha * beta
    level = np.zeros((len(weights), STATES + 1))
    trend = np.zeros_like(level)
    season = np.zeros((SEASON, *level.shape))
    level[:, 1], trend[:, 2] = 1.0, 1.0
    for i in range(SEASON):
        season[i, :, 3 + i] = 1.0
    errors = np.empty((len(values), *level.shape))
    for i, value in enumerate(values):
        slot = season[i % SEASON]
        level += trend
        error = np.add(level, slot, out=errors[i])
        np.negative(error, out=error)
        error[:, 0] += value  # only the zero start sees the values, the others show what states add
        level += alpha * error
        trend += drift * error
        slot += gamma * error
    errors = np.ascontiguousarray(errors.swapaxes(0, 1))
    return errors[:, :, 0], errors[:, :, 1:]


def least_errors(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Squared error of the best start for each weight triple, all by their normal equations."""
    errors, changes = _design(values, weights)
    across = np.swapaxes(changes, 1, 2)
    starts = -np.linalg.pinv(across @ changes, rcond=1e-10, hermitian=True) @ (across @ errors[:, :, None])
    left = errors + (changes @ starts)[:, :, 0]
    return (left**2).sum(axis=1)


def best_start(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The starting states of least squared error for one weight triple, of least norm."""
    errors, changes = _design(values, weights[None])
    return np.linalg.lstsq(changes[0], -errors[0], rcond=1e-10)[0]


def run(values: np.ndarray, weights: np.ndarray, start: np.ndarray) -> tuple[float, float, float, np.ndarray]:
    """Smooth once: squared error and the final level, trend and season."""
    alpha, beta, gamma = weights
    level, trend, season = start[0], start[1], start[2:].copy()
    error = 0.0
    for i, value in enumerate(values):
        base = level + trend
        gap = value - base - season[i % SEASON]
        error += gap**2
        level = base + alpha * gap
        trend += alpha * beta * gap
        season[i % SEASON] += gamma * gap
    return error, level, trend, season


def _descend(values: np.ndarray, weights: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pattern search from several triples at once: each tries a step up and down along its weights
    and takes the best, or shortens its steps when none helps."""
    weights, errors = weights.copy(), errors.copy()
    steps = np.full(len(weights), FIRST_STEP)
    axes = np.vstack([np.eye(3), -np.eye(3)])
    while (steps > TOLERANCE).any():
        live = np.flatnonzero(steps > TOLERANCE)
        around = weights[live, None] + steps[live, None, None] * axes
        around = np.clip(around, LOWEST, HIGHEST)
        found = least_errors(values, around.reshape(-1, 3)).reshape(len(live), -1)
        best = found.argmin(axis=1)
        for n, (i, k) in enumerate(zip(live, best)):
            if found[n, k] < errors[i] * (1 - 1e-12):
                weights[i], errors[i] = around[n, k], found[n, k]
            else:
                steps[i] /= 3
    return weights, errors


def simple_start(values: np.ndarray) -> np.ndarray:
    """The usual start: the first week's mean, the daily change to the second, and the rest."""
    first, second = values[:SEASON], values[SEASON : 2 * SEASON]
    return np.concatenate([[first.mean(), (second.mean() - first.mean()) / SEASON], first - first.mean()])


def _ahead(values: np.ndarray, weights: np.ndarray, start: np.ndarray, horizon: int) -> tuple[float, list[float]]:
    sse, level, trend, season = run(values, weights, start)
    steps = [level + (h + 1) * trend + season[(len(values) + h) % SEASON] for h in range(horizon)]
    return float(sse), [float(x) for x in steps]


def _repeated_week(values: np.ndarray, horizon: int) -> list[float]:
    last = values[-SEASON:]
    return [float(last[h % len(last)]) for h in range(horizon)]


def smoothed(values, weights, horizon: int) -> dict:
    """Smoothing with given weights from the usual start; short series repeat their last week."""
    values = np.asarray(values, dtype=float)
    if len(values) < 2 * SEASON:
        return {"days": len(values), "sse": None, "steps": _repeated_week(values, horizon)}
    sse, steps = _ahead(values, np.asarray(weights), simple_start(values), horizon)
    return {"days": len(values), "sse": sse, "steps": steps}


def best_fit(values, horizon: int) -> dict:
    """Weights and starting states of least squared one-step error, and the next `horizon` values.

    A series shorter than two weeks repeats its last week instead.
    """
    values = np.asarray(values, dtype=float)
    names = ("alpha", "beta", "gamma")
    if len(values) < 2 * SEASON:
        none = dict.fromkeys((*names, "sse", "start"))
        return {"days": len(values), **none, "steps": _repeated_week(values, horizon)}
    grid = np.array([(a, b, g) for a in GRID for b in GRID for g in GRID])
    errors = least_errors(values, grid)
    order = np.argsort(errors, kind="stable")[:STARTS]
    found, errors = _descend(values, grid[order], errors[order])
    weights = found[errors.argmin()]
    start = best_start(values, weights)
    sse, steps = _ahead(values, weights, start, horizon)
    named = {name: float(w) for name, w in zip(names, weights)}
    return {"days": len(values), **named, "sse": sse, "start": start.tolist(), "steps": steps}
