"""Leading eigenpairs of a symmetric matrix by contour integration (FEAST).

The spectrum above a bound is cut into intervals with a few eigenvalues each. How many lie in an interval is known
beforehand from inertia: a matrix has as many eigenvalues above s as its LDL' factorisation shifted by s has positive
pivots. Within an interval, quadrature over a circle of complex shifted solves projects a block of vectors onto the wanted
eigenspace, Rayleigh-Ritz extracts the pairs, and the round is repeated until their residuals stop falling. An interval
whose pairs are fewer than its inertia count is tried again with a larger block; none is ever missed silently.
"""

from __future__ import annotations

import math

import numpy as np

#: Points of the Gauss-Legendre rule on the upper half of the circle; the lower half is their mirror image.
QUADRATURE_POINTS = 8
#: Eigenvalues that an interval should hold at most.
MOST_IN_INTERVAL = 8
ROUNDS = 24
ATTEMPTS = 4
#: Of the norm: what is narrower is not cut further, what is smaller counts as zero (times the dimensions).
NARROWEST = 1e-8
ROUNDING = float(np.finfo(np.float64).eps)
#: Of the norm: residual of a pair that counts as found.
RESIDUAL = 1e-11
#: Where an interval is cut, in the order in which the places are tried.
CUTS = (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7)
#: A 1 x 1 pivot is taken where it is at least so large beside the largest entry off the diagonal.
PIVOT_SHARE = (1 + math.sqrt(17)) / 8


def positive_pivots(matrix: np.ndarray) -> int:
    """Positive eigenvalues of a symmetric matrix: the positive pivots of LDL' with complete 1 x 1 and 2 x 2 pivoting."""
    a = np.array(matrix, dtype=np.float64)
    found = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        r = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0)
        p, q = divmod(int(off.argmax()), len(a))
        if diagonal[r] == 0 and off[p, q] == 0:
            return found  # nothing but zeros is left
        if diagonal[r] >= PIVOT_SHARE * off[p, q]:
            gone = [r]
            found += int(a[r, r] > 0)
        else:
            gone = [p, q]  # its determinant is negative: one eigenvalue of either sign
            found += 1
        rest = np.setdiff1d(np.arange(len(a)), gone)
        side = a[np.ix_(rest, gone)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(gone, gone)], side.T)
    return found


def eigenvalues_above(matrix: np.ndarray, bound: float) -> int:
    return positive_pivots(matrix - bound * np.eye(len(matrix)))


def intervals(matrix: np.ndarray, low: float, high: float, wanted: int, narrowest: float) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) of disjoint intervals that hold the ``wanted`` largest eigenvalues above ``low``.

    No cut is made where an eigenvalue lies within a hair's breadth of it.
    """
    found: list[tuple[float, float, int]] = []
    todo = [(low, high, eigenvalues_above(matrix, low), eigenvalues_above(matrix, high))]
    while todo:
        low, high, from_low, from_high = todo.pop()
        if from_low == from_high or from_high >= wanted:
            continue
        cut = None
        if high - low > narrowest and (from_low - from_high > MOST_IN_INTERVAL or from_low > wanted):
            hair = (high - low) * 1e-4
            for share in CUTS:
                middle = low + share * (high - low)
                above = eigenvalues_above(matrix, middle + hair)
                if above == eigenvalues_above(matrix, middle - hair):
                    cut = middle, above
                    break
        if cut is None:
            found.append((low, high, from_low - from_high))
        else:
            todo += [(low, cut[0], from_low, cut[1]), (cut[0], high, cut[1], from_high)]
    return found


def projected(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block filtered by the contour integral of the resolvent: what belongs to eigenvalues in (low, high) remains."""
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(QUADRATURE_POINTS)
    out = np.zeros_like(block)
    for point, weight in zip(points, weights, strict=True):
        turn = np.exp(0.5j * np.pi * (1 - point))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(matrix)) - matrix, block.astype(np.complex128))
        out += weight / 2 * (radius * turn * solved).real
    return out


def rayleigh_ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values and vectors of the space that the block spans, the largest first."""
    basis, _ = np.linalg.qr(block)
    values, small = np.linalg.eigh(basis.T @ matrix @ basis)
    return values[::-1], (basis @ small)[:, ::-1]


def pairs_within(matrix: np.ndarray, low: float, high: float, count: int, norm: float) -> np.ndarray:
    """The eigenvectors, as columns, of the ``count`` eigenvalues in (low, high)."""
    rng = np.random.default_rng(5)
    for attempt in range(ATTEMPTS):
        width = min(len(matrix), (2 * count + 6) << attempt)
        block, last = rng.standard_normal((len(matrix), width)), math.inf
        for _ in range(ROUNDS):
            values, block = rayleigh_ritz(matrix, projected(matrix, block, low, high))
            residuals = np.linalg.norm(matrix @ block - block * values, axis=0)
            inside = (values > low) & (values <= high)
            good = inside & (residuals <= RESIDUAL * norm)
            worst = float(residuals[inside].max(initial=0.0))
            if good.sum() == count and (worst >= last / 2 or worst <= 4 * ROUNDING * norm):
                return block[:, good]
            last = worst
        if good.sum() == count:
            return block[:, good]
    raise RuntimeError(f"{count} eigenvalues lie between {low} and {high}, but {int(good.sum())} were found")


def leading_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, ``wanted`` at most, and their unit eigenvectors as columns.

    Eigenvalues that rounding cannot tell from zero are left out, so fewer may come back. The sign of an eigenvector is
    such that its entry with the largest magnitude is positive.
    """
    dims = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    least = norm * ROUNDING * max(dims, 1)
    wanted = min(wanted, eigenvalues_above(matrix, least)) if norm > 0 else 0
    if wanted == 0:
        return np.empty(0), np.empty((dims, 0))
    parts = intervals(matrix, least, norm * (1 + 1e-9), wanted, norm * NARROWEST)
    blocks = [pairs_within(matrix, low, high, count, norm) for low, high, count in parts]
    # vectors of neighbouring intervals are orthogonal only up to rounding: one more extraction over all of them
    values, vectors = rayleigh_ritz(matrix, np.concatenate(blocks, axis=1))
    values, vectors = values[:wanted], vectors[:, :wanted]
    if eigenvalues_above(matrix, float(values[-1]) - RESIDUAL * norm) < wanted:
        raise RuntimeError("the smallest component found is larger than inertia allows")
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])
    return values, vectors * np.where(signs == 0, 1.0, signs)
