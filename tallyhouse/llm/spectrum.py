"""Leading eigenpairs of a symmetric matrix by slicing its spectrum.

The number of eigenvalues above a shift is the number of positive pivots of the LDLᵀ factorisation of the shifted matrix
(Sylvester's law of inertia). Bisection by such counts puts each wanted eigenvalue in an interval of its own; Rayleigh quotient
iteration then converges to it cubically, kept inside the interval; two counts beside the result certify which number it has.
Eigenvalues that rounding cannot tell apart share an interval, and get an orthonormal basis of their common space.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np

_ALPHA = (1 + math.sqrt(17)) / 8  # bounds the growth of the entries under Bunch-Kaufman pivoting
EPS = float(np.finfo(np.float64).eps)


class Factor(NamedTuple):
    """P A Pᵀ = L D Lᵀ with L unit lower triangular and D of blocks of one or two rows."""

    order: np.ndarray
    lower: np.ndarray
    blocks: list[tuple[int, np.ndarray]]  # first row, the block

    @property
    def positive(self) -> int:
        """Positive eigenvalues of the matrix; a block of two rows has one of each sign."""
        return sum(1 if len(d) == 2 else int(d[0, 0] > 0) for _, d in self.blocks)

    def solve(self, b: np.ndarray, floor: float) -> np.ndarray:
        """x with A x = b; pivots smaller than `floor` count as it, so that a singular matrix gives a long x."""
        x = b[self.order].astype(np.float64)
        for k in range(len(x)):
            x[k + 1 :] -= np.multiply.outer(self.lower[k + 1 :, k], x[k])
        for k, d in self.blocks:
            if len(d) == 2:
                x[k : k + 2] = np.linalg.solve(d, x[k : k + 2])
            else:
                x[k] /= d[0, 0] if abs(d[0, 0]) > floor else math.copysign(floor, d[0, 0])
        for k in range(len(x) - 1, -1, -1):
            x[k] -= self.lower[k + 1 :, k] @ x[k + 1 :]
        out = np.empty_like(x)
        out[self.order] = x
        return out


def factorise(matrix: np.ndarray) -> Factor:
    """LDLᵀ with the pivoting of Bunch and Kaufman."""
    a, n, k = matrix.astype(np.float64), len(matrix), 0
    order, lower, blocks = np.arange(n), np.eye(n), []
    while k < n:
        rest = np.abs(a[k + 1 :, k])
        most, size, swap = (float(rest.max()) if len(rest) else 0.0), 1, k
        if abs(a[k, k]) < _ALPHA * most:
            r = k + 1 + int(rest.argmax())
            column = np.abs(a[k:, r])
            column[r - k] = 0
            other = float(column.max())
            if abs(a[k, k]) * other < _ALPHA * most * most:
                size, swap = (1, r) if abs(a[r, r]) >= _ALPHA * other else (2, r)
        to = k + size - 1
        if swap != to:
            a[[to, swap]] = a[[swap, to]]
            a[:, [to, swap]] = a[:, [swap, to]]
            lower[[to, swap], :k] = lower[[swap, to], :k]
            order[[to, swap]] = order[[swap, to]]
        d, below = a[k : k + size, k : k + size].copy(), a[k + size :, k : k + size]
        if d.any():
            factor = below / d[0, 0] if size == 1 else np.linalg.solve(d, below.T).T
            lower[k + size :, k : k + size] = factor
            a[k + size :, k + size :] -= factor @ below.T
        blocks.append((k, d))
        k += size
    return Factor(order, lower, blocks)


def above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above the shift."""
    return factorise(matrix - shift * np.eye(len(matrix))).positive


class _Slice(NamedTuple):
    low: float
    high: float
    first: int  # number, from 1, of the largest eigenvalue within
    last: int


def slices(matrix: np.ndarray, wanted: int, width: float) -> list[_Slice]:
    """Intervals of the first `wanted` eigenvalues in falling order: one each, or several within `width` of each other."""
    radius = np.abs(matrix).sum(1) - np.abs(np.diag(matrix))
    low, high = float((np.diag(matrix) - radius).min()), float((np.diag(matrix) + radius).max())
    room = max(width, (high - low) * 0.01)
    stack, out = [_Slice(low - room, high + room, 1, len(matrix))], []
    while stack:
        at = stack.pop()
        if at.first > min(wanted, at.last):
            continue
        if at.first == at.last or at.high - at.low <= width:
            out.append(at)
            continue
        middle = (at.low + at.high) / 2
        more = above(matrix, middle)
        stack += [_Slice(at.low, middle, more + 1, at.last), _Slice(middle, at.high, at.first, more)]
    return out


def _orthogonal(v: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The unit vector along v without what the known columns span; removed twice, against rounding."""
    for _ in range(2):
        v = v - known @ (known.T @ v)
    return v / np.linalg.norm(v)


def _start(n: int, k: int) -> np.ndarray:
    """A fixed vector without a pattern, so that reruns give the same signs."""
    return np.random.default_rng(k).standard_normal(n)


def _iterate(matrix: np.ndarray, at: _Slice, known: np.ndarray, width: float) -> tuple[float, np.ndarray]:
    """The eigenpair of a slice with one eigenvalue, by Rayleigh quotient iteration with counts where it leaves the slice."""
    n, floor = len(matrix), EPS * width
    identity, v = np.eye(n), _orthogonal(_start(n, at.first), known)
    shift = (at.low + at.high) / 2
    best = (math.inf, shift, v)
    for _ in range(200):
        v = factorise(matrix - shift * identity).solve(v, floor)
        v = _orthogonal(v / np.linalg.norm(v), known)
        value = float(v @ matrix @ v)
        residual = float(np.linalg.norm(matrix @ v - value * v))
        if not at.low <= value <= at.high:  # the neighbour's vector: halve the slice and start from its middle
            middle = (at.low + at.high) / 2
            at = at._replace(low=middle) if above(matrix, middle) >= at.first else at._replace(high=middle)
            shift, v = (at.low + at.high) / 2, _orthogonal(_start(n, at.first), known)
            continue
        if residual < best[0]:
            best, shift = (residual, value, v), value
        elif best[0] <= width:
            break  # as good as rounding allows
        else:
            shift = value
        if residual == 0:
            break
    return best[1], best[2]


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues in falling order and their unit eigenvectors as columns, `wanted` of them or all there are.

    The sign of a vector is such that its largest entry is positive. Raises an ArithmeticError where the counts beside an
    eigenvalue contradict its number.
    """
    n = len(matrix)
    wanted, scale = min(wanted, n), float(np.abs(matrix).sum(1).max()) if n else 0.0
    if not wanted or not scale:
        return np.zeros(wanted), np.eye(n)[:, :wanted]
    width = 8 * n * EPS * scale  # what rounding may move an eigenvalue by
    values, vectors = np.zeros(n), np.zeros((n, 0))
    for at in slices(matrix, wanted, width):
        for number in range(at.first, at.last + 1):
            if at.first == at.last:
                value, v = _iterate(matrix, at, vectors, width)
            else:  # a cluster: inverse iteration on what the space of the others leaves
                v, factor = _orthogonal(_start(n, number), vectors), factorise(matrix - (at.low + at.high) / 2 * np.eye(n))
                for _ in range(4):
                    v = factor.solve(v, EPS * width)
                    v = _orthogonal(v / np.linalg.norm(v), vectors)
                value = float(v @ matrix @ v)
            values[number - 1] = value
            vectors = np.column_stack((vectors, v))
        low, high = values[at.last - 1] - 2 * width, values[at.first - 1] + 2 * width
        if above(matrix, low) < at.last or above(matrix, high) >= at.first:
            raise ArithmeticError(f"eigenvalue {at.first} is not where the counts say")
    vectors = vectors[:, :wanted]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(wanted)])
    return values[:wanted], vectors * signs
