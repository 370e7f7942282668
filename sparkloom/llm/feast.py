"""Largest eigenpairs of a symmetric matrix by contour integration (FEAST), checked by inertia.

An interval of the spectrum is enclosed by a circle in the complex plane. The integral of the resolvent
along it is the projector onto the eigenvectors inside; Gauss-Legendre nodes turn it into a few solves with
the matrix shifted by complex numbers. Rayleigh-Ritz on the projected subspace gives the eigenpairs. How many
there have to be is known beforehand: by Sylvester's law the negative pivots of ``A - shift I = L D L'``
count the eigenvalues below the shift.

The matrix is dimensions x dimensions, whatever the number of rows behind it.
"""

from __future__ import annotations

import numpy as np

NODES = 8              # quadrature nodes on the upper half of a circle
MOST_IN_INTERVAL = 10  # eigenvalues that an interval should hold at most
ROUNDS = 40            # projections of one subspace before its interval is cut elsewhere
_PIVOT = (1 + 17 ** 0.5) / 8    # growth bound of complete diagonal pivoting


def inertia_below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are below ``shift``: negative pivots of a block LDL' factorisation."""
    a = matrix - shift * np.eye(len(matrix))
    below = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        r = int(diagonal.argmax())
        i, j = np.unravel_index(np.abs(a).argmax(), a.shape)
        if abs(a[i, j]) == 0:
            break                                    # what is left is exactly zero: not below
        if diagonal[r] >= _PIVOT * abs(a[i, j]):
            chosen = [r]
            below += bool(a[r, r] < 0)
        else:
            chosen = [int(i), int(j)]                # such a block has one eigenvalue of each sign
            below += 1
        rest = np.delete(np.arange(len(a)), chosen)
        block, edge = a[np.ix_(chosen, chosen)], a[np.ix_(rest, chosen)]
        a = a[np.ix_(rest, rest)] - edge @ np.linalg.solve(block, edge.T)
        a = (a + a.T) / 2
    return below


def _project(matrix: np.ndarray, low: float, high: float, y: np.ndarray) -> np.ndarray:
    """The part of ``y`` in the eigenvectors of the interval, by quadrature of the resolvent."""
    centre, radius = (low + high) / 2, (high - low) / 2
    x, weights = np.polynomial.legendre.leggauss(NODES)
    out = np.zeros_like(y)
    for node, weight in zip(x, weights):
        turn = np.exp(-0.5j * np.pi * (node - 1))
        shifted = (centre + radius * turn) * np.eye(len(matrix)) - matrix
        out += 0.5 * weight * (radius * turn * np.linalg.solve(shifted, y.astype(complex))).real
    return out


def _ritz(matrix: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    q, _ = np.linalg.qr(y)
    values, inner = np.linalg.eigh(q.T @ matrix @ q)
    return values, q @ inner


def _interval(matrix: np.ndarray, low: float, high: float, count: int, scale: float,
              rng: np.random.Generator) -> np.ndarray | None:
    """The ``count`` eigenvectors with eigenvalues between the bounds, or None if they don't settle."""
    size = min(len(matrix), 2 * count + 6)
    y = rng.standard_normal((len(matrix), size))
    exact, best = 8 * np.finfo(float).eps * scale * len(matrix) ** 0.5, np.inf
    for _ in range(ROUNDS):
        values, vectors = _ritz(matrix, _project(matrix, low, high, y))
        errors = np.abs(matrix @ vectors - vectors * values).max(axis=0)
        inside = np.flatnonzero((values >= low) & (values < high))
        inside = inside[np.argsort(errors[inside], kind="stable")]     # Ritz values of noise come last
        if len(inside) >= count:
            worst = errors[inside[count - 1]]
            apart = len(inside) == count or errors[inside[count]] > 1e3 * worst
            if worst <= exact or apart and worst <= 1e-13 * scale and worst >= best / 2:
                return vectors[:, inside[:count]]
            best = worst
        y = vectors
    return None


def largest_eigenpairs(matrix: np.ndarray, most: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues that are above rounding, falling, and their unit vectors as columns.

    A matrix of a lower rank has fewer. None is missed: every interval has as many as its inertia says,
    otherwise it is cut at another place.
    """
    size, rng = len(matrix), np.random.default_rng(seed)
    scale = float(np.abs(matrix).sum(axis=1).max()) if size else 0.0     # no eigenvalue is above
    if scale == 0:
        return np.empty(0), np.empty((size, 0))
    top, floor = scale * (1 + 1e-9), size * np.finfo(float).eps * scale
    above = lambda bound: size - inertia_below(matrix, bound)
    wanted = min(most, above(floor))
    low, high = floor, top
    while wanted and above(low) > wanted + MOST_IN_INTERVAL // 2 and high - low > 1e-9 * scale:
        middle = (low + high) / 2
        if above(middle) >= wanted:
            low = middle
        else:
            high = middle
    found, todo = [], [(low, top, above(low) if wanted else 0, 0, 0)]
    while todo:
        low, high, above_low, above_high, tries = todo.pop()
        count = above_low - above_high
        if not count:
            continue
        narrow = high - low <= 1e-10 * scale
        if count <= MOST_IN_INTERVAL or narrow or 2 * count + 6 >= size:
            x = _interval(matrix, low, high, count, scale, rng)
            if x is not None:
                found.append(x)
                continue
        if tries > 60:
            raise ArithmeticError(f"no {count} eigenvectors between {low} and {high}")
        cut = low + (high - low) * (0.5 + 0.17 * (rng.random() - 0.5))
        above_cut = above(cut)
        todo += [(low, cut, above_low, above_cut, tries + 1), (cut, high, above_cut, above_high, tries + 1)]
    if not found:
        return np.empty(0), np.empty((size, 0))
    values, vectors = _ritz(matrix, np.hstack(found))
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]
