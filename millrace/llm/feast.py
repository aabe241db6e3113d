"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST), counted by inertia.

The matrix is a covariance: its order is the number of dimensions of the data, never the number of rows.
"""

from __future__ import annotations

import numpy as np

POINTS = 16  # of the quadrature on the upper half circle
ROUNDS = 40
WIDER = 5  # further attempts, each with a wider interval
SPARE = 8  # eigenvalues an interval may hold beyond those wanted
_ALPHA = (1 + 17**0.5) / 8


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """Numbers of negative, zero and positive eigenvalues: signs of the pivots of a symmetric factorisation."""
    a = np.array(matrix, float)
    negative = zero = positive = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        rest = np.abs(a - np.diag(np.diag(a)))
        r, s = divmod(int(rest.argmax()), len(a))
        if diagonal[p] == 0 and rest[r, s] == 0:
            zero += len(a)
            break
        if diagonal[p] >= _ALPHA * rest[r, s]:
            positive, negative = positive + bool(a[p, p] > 0), negative + bool(a[p, p] < 0)
            keep = np.delete(np.arange(len(a)), p)
            column = a[keep, p]
            a = a[np.ix_(keep, keep)] - np.outer(column, column) / a[p, p]
        else:  # a block of two whose determinant is negative: one eigenvalue of each sign
            positive, negative = positive + 1, negative + 1
            keep = np.delete(np.arange(len(a)), [r, s])
            columns = a[np.ix_(keep, [r, s])]
            block = a[np.ix_([r, s], [r, s])]
            a = a[np.ix_(keep, keep)] - columns @ np.linalg.solve(block, columns.T)
            a = (a + a.T) / 2
    return negative, zero, positive


def count_above(matrix: np.ndarray, shift: float) -> int:
    return inertia(matrix - shift * np.eye(len(matrix)))[2]


def top_interval(matrix: np.ndarray, k: int) -> tuple[float, float, int]:
    """An interval that holds the ``k`` largest eigenvalues, and how many it holds by inertia.

    Bisection ends when at most ``SPARE`` others are inside, or when the others cannot be told apart
    (equal eigenvalues). ``matrix`` is positive semidefinite up to rounding.
    """
    size = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is larger
    low, high = -0.01 * size, 1.01 * size
    held = len(matrix)
    above = high  # fewer than k eigenvalues lie above
    while held > k + SPARE and above - low > 1e-6 * size:
        middle = (low + above) / 2
        n = count_above(matrix, middle)
        if n >= k:
            low, held = middle, n
        else:
            above = middle
    return low, high, held


def _projected(matrix: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """``block`` times the spectral projector of the interval: quadrature of shifted solves on a circle."""
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    out = np.zeros_like(block)
    for x, w in zip(nodes, weights, strict=True):
        turn = np.exp(-0.5j * np.pi * (x - 1))
        shifted = (centre + radius * turn) * np.eye(len(matrix)) - matrix
        out += 0.5 * w * (radius * turn * np.linalg.solve(shifted, block.astype(complex))).real
    return out


def feast(matrix: np.ndarray, low: float, high: float, held: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``held`` eigenpairs of the interval, eigenvalues falling. Raises if some are missed."""
    d = len(matrix)
    norm = float(np.linalg.norm(matrix))
    block = np.random.default_rng(11).standard_normal((d, min(d, held + max(SPARE, held // 2))))
    found, error = 0, np.inf
    for _ in range(ROUNDS):
        base, strength, _ = np.linalg.svd(_projected(matrix, low, high, block), full_matrices=False)
        base = base[:, strength > 1e-13 * strength[0]]
        base, _ = np.linalg.qr(base)
        values, turn = np.linalg.eigh(base.T @ matrix @ base)  # Rayleigh-Ritz
        block = base @ turn
        inside = (values > low) & (values <= high)
        e, v = values[inside][::-1], block[:, inside][:, ::-1]
        found = int(inside.sum())
        error = float(np.linalg.norm(matrix @ v - v * e, axis=0).max(initial=0.0)) if found else np.inf
        if found == held and error <= 1e-14 * d**0.5 * norm:
            return e, v
    if found != held or error > 1e-11 * norm:
        raise ArithmeticError(f"{found} of {held} eigenvalues found, residual {error}")
    return e, v


def largest_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors as columns (all, if there are fewer)."""
    k = min(k, len(matrix))
    if not k or not np.any(matrix):
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    low, high, held = top_interval(matrix, k)
    for _ in range(WIDER):
        try:
            e, v = feast(matrix, low, high, held)
            return e[:k], v[:, :k]
        except ArithmeticError:  # an eigenvalue at the very edge: take the next ones in
            low -= 0.02 * (high - low)
            held = count_above(matrix, low)
    e, v = feast(matrix, low, high, held)
    return e[:k], v[:, :k]
