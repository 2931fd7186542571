"""The four-parameter Hill curve and its least-squares fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

PARAMETERS = ("min_duration", "max_duration", "Hill_exponent", "EC50")


def hill(x: Column, base: Column, top: Column, exponent: Column, ec50: Column) -> Column:
    """base + (top - base) x^e / (x^e + ec50^e)."""
    xe = F.pow(x, exponent)
    return base + (top - base) * xe / (xe + F.pow(ec50, exponent))


def curve(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        xe = np.power(x, p[2])
        return p[0] + (p[1] - p[0]) * xe / (xe + np.power(p[3], p[2]))


def _jacobian(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    base, top, e, k = p
    with np.errstate(all="ignore"):
        xe, ke = np.power(x, e), np.power(k, e)
        s = xe / (xe + ke)
        slope = (top - base) * s * (1 - s)
        log_ratio = np.where(x > 0, np.log(np.where(x > 0, x, 1.0)) - np.log(k), 0.0)
        return np.stack([1 - s, s, slope * log_ratio, -slope * e / k], axis=1)


def fit(x: np.ndarray, y: np.ndarray, start: np.ndarray, max_evaluations: int = 10_000) -> tuple[np.ndarray, str]:
    """(parameters, status): unweighted Levenberg-Marquardt. Too few points, or a start where the curve is undefined,
    give NaN and the reason instead of an error."""
    p = np.asarray(start, float)
    if len(x) < len(p):
        return np.full(4, np.nan), f"{len(x)} points for 4 parameters"
    residual = y - curve(x, p)
    cost = float(residual @ residual)
    if not np.isfinite(cost):
        return np.full(4, np.nan), "curve undefined at the start"
    damping = 1e-3
    for _ in range(max_evaluations):
        j = _jacobian(x, p)
        a, g = j.T @ j, j.T @ residual
        try:
            step = np.linalg.solve(a + damping * np.diag(np.maximum(np.diag(a), 1e-12)), g)
        except np.linalg.LinAlgError:
            damping *= 10
            if damping > 1e12:
                break
            continue
        new = p + step
        r = y - curve(x, new)
        c = float(r @ r)
        if np.isfinite(c) and c < cost:
            small = cost - c <= 1e-14 * cost and np.all(np.abs(step) <= 1e-10 * (np.abs(p) + 1e-10))
            p, residual, cost, damping = new, r, c, max(damping / 10, 1e-12)
            if small:
                return p, "converged"
        else:
            damping *= 10
            if damping > 1e12:
                return p, "converged"
    return p, "stopped at the evaluation limit"
