"""Eigenvectors of a symmetric matrix by contour integration (FEAST), largest eigenvalues first.

The matrix is small (its side is the dimension of the vectors), so this runs on the driver. Inertia counts, from the signs of
an LDL' factorisation, cut the spectrum into intervals and say how many eigenvalues each holds. For an interval, a
quadrature along a circle through its ends of complex shifted solves projects random vectors onto its eigenvectors; Rayleigh-Ritz
takes them from there. An interval is done when it yields as many as the inertia says.
"""

from __future__ import annotations

import numpy as np

NODES = 8
GROUP = 8
STEP = 1e-3
ROUNDS = 60
SEED = 5


def positives(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are above 0: Sylvester's law over pivots of size one and two."""
    a, found = np.array(matrix, dtype=np.float64), 0
    bound = (1 + np.sqrt(17)) / 8
    while len(a):
        size = np.abs(a)
        p, q = np.unravel_index(np.argmax(size), a.shape)
        if size[p, q] == 0:
            break
        r = int(np.argmax(np.diagonal(size)))
        if size[r, r] >= bound * size[p, q]:
            found += bool(a[r, r] > 0)
            rest = np.delete(np.arange(len(a)), r)
            column = a[rest, r]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / a[r, r])
        else:  # a pivot of two has one eigenvalue of each sign
            found += 1
            rest = np.delete(np.arange(len(a)), [p, q])
            columns = a[np.ix_(rest, [p, q])]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(a[np.ix_([p, q], [p, q])], columns.T)
        a = (a + a.T) / 2
    return found


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """``low, high, eigenvalues`` of intervals from the top down that together hold ``wanted`` or all positive ones.

    An interval spans a factor of 1,000 at most and holds ``GROUP`` eigenvalues at most, unless they are so close that no
    shift tells them apart. Values under rounding of the largest count as 0.
    """
    high = float(np.abs(matrix).sum(axis=1).max(initial=0.0)) * 1.001
    floor = high * len(matrix) * 4e-16
    eye = np.eye(len(matrix))

    def above(shift: float) -> int:
        return positives(matrix - shift * eye)

    made, found = [], 0
    wanted = min(wanted, above(floor)) if high > 0 else 0
    while found < wanted:
        low = max(floor, high * STEP)
        count = above(low)
        if count == found:
            high = low
            continue
        top = high
        while count - found > GROUP and top - low > 1e-10 * top:
            middle = (low + top) / 2
            here = above(middle)
            if here == found:
                top = middle
            else:
                low, count = middle, here
        made.append((low, top, count - found))
        found, high = count, low
    return made


def within(matrix: np.ndarray, low: float, high: float, count: int, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs in an interval, by falling eigenvalue. ``matrix`` may be of extended precision."""
    plain, d = matrix.astype(np.float64), len(matrix)
    t, w = np.polynomial.legendre.leggauss(NODES)
    radius, centre = (high - low) / 2, (high + low) / 2
    turn = np.exp(0.5j * np.pi * (1 - t))
    size = min(d - before.shape[1], count + count // 2 + 8)
    basis = np.random.default_rng(SEED).standard_normal((d, size))
    least = None
    for _ in range(ROUNDS):
        moved = np.zeros_like(basis)
        for z, weight in zip(turn, w, strict=True):
            solved = np.linalg.solve((centre + radius * z) * np.eye(d) - plain, basis.astype(complex))
            moved += 0.5 * weight * np.real(radius * z * solved)
        for _ in range(2):
            moved -= before @ (before.T @ moved)
            moved, _ = np.linalg.qr(moved)
        image = matrix @ moved  # in the precision of the matrix
        values, turned = np.linalg.eigh(np.asarray(moved.T @ image, dtype=np.float64))
        basis = moved @ turned
        inside = np.flatnonzero((values > low) & (values <= high))[::-1]
        residual = np.linalg.norm(np.asarray(image @ turned[:, inside] - basis[:, inside] * values[inside], dtype=float))
        if len(inside) == count:
            if residual <= 1e-14 * high or (least is not None and residual > least / 2):
                return _ritz(matrix, basis[:, inside])
            least = residual
    raise ArithmeticError(f"found {len(inside)} of {count} eigenvalues between {low} and {high}")


def _ritz(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz among the found vectors alone, so that larger eigenvalues elsewhere cost no digits."""
    basis, _ = np.linalg.qr(basis)
    values, turned = np.linalg.eigh(np.asarray(basis.T @ (matrix @ basis), dtype=np.float64))
    order = np.argsort(-values, kind="stable")
    return values[order], basis @ turned[:, order]


def largest(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` positive eigenvalues (or all), falling, and their unit vectors as columns.

    The sign of a vector makes its largest entry positive.
    """
    d = len(matrix)
    values, vectors = np.zeros(0), np.zeros((d, 0))
    for low, high, count in intervals(matrix.astype(np.float64), wanted):
        found, columns = within(matrix, low, high, count, vectors)
        values, vectors = np.append(values, found), np.hstack([vectors, columns])
    values, vectors = values[:wanted], vectors[:, :wanted]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])]) if len(values) else 1.0
    return values, vectors * signs
