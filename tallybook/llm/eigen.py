"""Leading eigenpairs of a symmetric matrix of embedding dimensions, on the driver.

The matrix is as large as the embedding is wide, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
_TINY = np.finfo(float).tiny
#: Eigenvalues closer than this share of the matrix norm count as one cluster.
CLUSTER = 1e-3
_STEPS = 6


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder reduction: diagonal, off-diagonal, and the unit reflectors in order."""
    a, reflectors = np.array(matrix, float), []
    n = len(a)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        scale = np.abs(v).max()
        if np.abs(v[1:]).max() <= _TINY:
            reflectors.append(np.zeros(n - k - 1))
            continue
        v /= scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        reflectors.append(v)
        # the reflection from both sides is a change of rank two in what is left
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        column = a[k + 1 :, k]
        column -= 2 * (v @ column) * v
        a[k, k + 1 :] = column
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_count(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are less than each of ``x``."""
    x = np.asarray(x, float)
    least = max(_TINY, _EPS * np.abs(off).max(initial=0) ** 2)
    q = diagonal[0] - x
    count = (q < 0).astype(int)
    for d, e in zip(diagonal[1:], off):
        q = np.where(np.abs(q) < least, -least, q)
        q = d - x - e * e / q
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until no double lies between."""
    n = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    bound = max(np.abs(diagonal + reach).max(), np.abs(diagonal - reach).max()) * (1 + 4 * _EPS)
    low, high = np.full(k, -bound - _TINY), np.full(k, bound + _TINY)
    wanted = n - np.arange(k)
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high) | (high - low <= _EPS * bound * 1e-2)).all():
            break
        below = sturm_count(diagonal, off, middle) >= wanted
        high, low = np.where(below, middle, high), np.where(below, low, middle)
    return low + (high - low) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, floor: float):
    """A function that solves (T - shift) y = b, eliminated once with row exchanges."""
    n = len(diagonal)
    main, upper, second = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    factor, swapped = np.zeros(n), np.zeros(n, bool)
    for i in range(n - 1):
        below = off[i]
        if abs(below) > abs(main[i]):
            swapped[i] = True
            f = main[i] / below
            main[i], upper[i], second[i], main[i + 1], upper[i + 1] = (
                below,
                main[i + 1],
                upper[i + 1],
                upper[i] - f * main[i + 1],
                -f * upper[i + 1],
            )
        else:
            main[i] = main[i] if abs(main[i]) > floor else floor
            f = below / main[i]
            main[i + 1] -= f * upper[i]
        factor[i] = f
    if abs(main[-1]) <= floor:
        main[-1] = floor

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.copy()
        for i in range(n - 1):
            if swapped[i]:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= factor[i] * y[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                y[i] -= upper[i] * y[i + 1]
            if i + 2 < n:
                y[i] -= second[i] * y[i + 2]
            y[i] /= main[i]
        return y

    return solve


def vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix for falling ``values``.

    Inverse iteration; within a cluster every step is made orthogonal to the vectors
    that the cluster has already.
    """
    n, random = len(diagonal), np.random.default_rng(7)
    norm = np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0)
    found: list[np.ndarray] = []
    cluster, shift = 0, np.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * norm:
            cluster = i
        # equal shifts would give the same vector again and again
        shift = min(value, shift - 4 * _EPS * norm) if i > cluster else value
        solve, y = _solver(diagonal, off, shift, _EPS * norm or 1.0), random.standard_normal(n)
        for _ in range(_STEPS):
            y = solve(y / np.abs(y).max())
            y /= np.abs(y).max()
            for other in found[cluster:] * 2:
                y -= (other @ y) * other
        found.append(y / np.linalg.norm(y))
    return np.array(found).reshape(-1, n).T


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Only values above the matrix's rounding error are given: its rank may be below ``k``.
    """
    n = len(matrix)
    # scaled to one, so that squares of its entries neither overflow nor vanish
    scale = np.abs(matrix).max(initial=0)
    if not n or not scale > 0:
        return np.zeros(0), np.zeros((n, 0))
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, min(k, n))
    values = values[values > n * _EPS * np.abs(diagonal).max() * 8]
    basis = vectors(diagonal, off, values)
    for i in range(len(reflectors) - 1, -1, -1):
        v = reflectors[i]
        basis[i + 1 :] -= 2 * np.outer(v, v @ basis[i + 1 :])
    return values * scale, basis
