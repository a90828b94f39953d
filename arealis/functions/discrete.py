"""Exact keyed draws from discrete distributions, for many rows at once inside tasks.

The numbers are those of ``rng.uniform`` at the same seed and keys.  Loops run over trials or steps, never over rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from arealis.functions.digest import uniforms

TRIALS = 8  # trials hashed together; a row pays for at most so many beyond its own


def binomial(keys: pa.Array, n: np.ndarray, p: np.ndarray, seed: str, trials_up_to: int) -> np.ndarray:
    """Sums of ``n`` keyed Bernoulli trials, or one draw by inversion beyond ``trials_up_to`` trials.

    Keys bring the separator before them.
    """
    p = np.where(np.isnan(p), 1.0, p)  # Spark orders NaN above every number
    out = np.where(p >= 1, np.maximum(n, 0), 0)
    open_ = (n >= 1) & (p > 0) & (p < 1)
    rows = np.flatnonzero(open_ & (n <= trials_up_to))
    trial_keys = pc.if_else(pc.equal(keys, ""), "|", keys)
    for lo in range(0, int(n[rows].max(initial=0)), TRIALS):
        rows = rows[n[rows] > lo]
        trials = np.arange(lo + 1, min(lo + TRIALS, int(n[rows].max())) + 1)
        u = uniforms(trial_keys.take(pa.array(rows)), [seed] * len(trials), [f"|{t}" for t in trials])
        out[rows] += ((u < p[rows, None]) & (trials <= n[rows, None])).sum(axis=1)
    rows = np.flatnonzero(open_ & (n > trials_up_to))
    if len(rows):
        size, chance = n[rows].astype(float), p[rows]
        odds = np.maximum(chance / np.maximum(1 - chance, 1e-300), 1e-300)
        u = uniforms(keys.take(pa.array(rows)), [seed], [""])[:, 0]
        mode = np.minimum(size, np.floor((size + 1) * chance))
        out[rows] = by_ratio(
            u, mode, np.zeros(len(rows)), size, np.sqrt(size * chance * (1 - chance)), lambda k, r: (size[r] - k + 1) / k * odds[r], lambda k, r: (k + 1) / ((size[r] - k) * odds[r])
        )
    return out


def poisson(keys: pa.Array, rate: np.ndarray, none: np.ndarray, seed: str, from_zero_up_to: float) -> np.ndarray:
    """Inversion at a keyed uniform, from zero upwards, where ``none`` is the probability, or from the mode beyond ``from_zero_up_to``."""
    u = uniforms(keys, [seed], [""])[:, 0]
    root = np.sqrt(np.maximum(rate, 0.0))
    out = np.zeros(len(rate), np.int64)
    rows = np.flatnonzero(rate <= from_zero_up_to)
    top = np.ceil(rate + 12 * root + 20)
    p, c = none.copy(), np.zeros(len(rate))
    i = 0
    while len(rows):
        c[rows] += p[rows]
        p[rows] = p[rows] * rate[rows] / (i + 1)
        rows = rows[c[rows] < u[rows]]
        out[rows] += 1
        i += 1
        rows = rows[top[rows] >= i]
    rows = np.flatnonzero(rate > from_zero_up_to)
    if len(rows):
        r, sd = rate[rows], root[rows]
        mode = np.floor(r)
        out[rows] = by_ratio(u[rows], mode, np.zeros(len(rows)), mode + 12 * sd + 40, sd, lambda k, at: r[at] / k, lambda k, at: (k + 1) / r[at])
    return out


def by_ratio(u: np.ndarray, mode: np.ndarray, low: np.ndarray, high: np.ndarray, sd: np.ndarray, up: Callable, down: Callable) -> np.ndarray:
    """Invert discrete distributions at ``u`` from the ratios of neighbouring probabilities.

    ``up(k, rows)`` is p(k) / p(k - 1) and ``down(k, rows)`` is p(k) / p(k + 1).  Weights start from 1 at ``mode`` and are summed as
    far as 12 times ``sd`` and 40 steps within ``low`` and ``high``; beyond that they vanish in double precision.
    """
    n = len(u)

    def steps(length: np.ndarray) -> np.ndarray:
        return np.minimum(length, sd * 12 + 40).astype(np.int64)

    def total(count: np.ndarray, sign: int, ratio: Callable) -> np.ndarray:
        w, s, rows, i = np.ones(n), np.zeros(n), np.arange(n), 1
        while len(rows := rows[(count[rows] >= i) & (w[rows] > 0)]):
            w[rows] *= ratio(mode[rows] + sign * i, rows)
            s[rows] += w[rows]
            i += 1
        return s

    def walk(rows: np.ndarray, count: np.ndarray, sign: int, ratio: Callable, left: np.ndarray) -> None:
        w, i = np.ones(n), 1
        while len(rows := rows[(count[rows] >= i) & (left[rows] > 0)]):
            k = mode[rows] + sign * i
            w[rows] *= ratio(k, rows)
            left[rows] -= w[rows]
            out[rows] = k
            i += 1

    above, below = steps(high - mode), steps(mode - low)
    over, under = total(above, 1, up), total(below, -1, down)
    goal = u * (1 + over + under)
    out = mode.copy()
    upward = (goal > 1) & (goal <= 1 + over)
    walk(np.flatnonzero(upward), above, 1, up, goal - 1)
    walk(np.flatnonzero((goal > 1) & ~upward), below, -1, down, goal - 1 - over)
    return out.astype(np.int64)
