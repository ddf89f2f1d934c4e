"""Eigenvalues and eigenvectors of a symmetric positive semidefinite matrix of whole numbers, by exact arithmetic.

The characteristic polynomial is computed modulo many primes (Hessenberg form, then a recurrence) and put together by Chinese
remaindering; the bound on its coefficients says how many primes are needed. All of its roots are real, so the sign changes of
its coefficients after a shift by a are exactly the number of roots above a (Descartes): bisection with that count isolates the largest
roots, multiple ones too, and the sign of the polynomial alone refines a single one. Eigenvectors come from inverse iteration
on the null space of matrix minus root, in fixed-point numbers of several hundred bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, isqrt

import numpy as np

#: Roots are whole multiples of 2 ** -FRACTION; vectors are solved with POINT bits after the point.
FRACTION, POINT = 96, 320


def primes_below(top: int = 1 << 31) -> Iterator[int]:
    """Primes downwards from ``top`` (at most 2 ** 32), by strong tests to bases that are proof in that range."""
    for n in range(top - 1 - top % 2, 2, -2):
        odd, twos = n - 1, 0
        while not odd & 1:
            odd, twos = odd >> 1, twos + 1
        for base in (2, 7, 61):
            x = pow(base, odd, n)
            if x in (1, n - 1):
                continue
            for _ in range(twos - 1):
                x = x * x % n
                if x == n - 1:
                    break
            else:
                break
        else:
            yield n


def enough_primes(matrix: list[list[int]]) -> list[int]:
    """Primes whose product exceeds twice any coefficient: of roots of a given sum, equal ones give the largest products."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    most = max((comb(d, k) * -(-(trace**k) // d**k) for k in range(d + 1)), default=1)
    found, product = [], 1
    for p in primes_below():
        found.append(p)
        product *= p
        if product > 2 * most + 1:
            return found
    raise ValueError("matrix too large")


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, lowest first, of det(xI - matrix) modulo a prime below 2 ** 31; ``matrix`` holds its residues as int64."""
    h, d = matrix.copy(), len(matrix)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        at = k + 1 + below[0]
        if at != k + 1:
            h[[k + 1, at]] = h[[at, k + 1]]
            h[:, [k + 1, at]] = h[:, [at, k + 1]]
        u = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * u % p).sum(1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    path = np.zeros(0, np.int64)  # products of subdiagonal entries from each row down to the current one
    for k in range(d):
        if k:
            path = np.append(path, 1) * h[k, k - 1] % p
        step = (h[:k, k] * path % p)[:, None] * polys[:k] % p
        shifted = np.append(0, polys[k, :-1])
        polys[k + 1] = (shifted - h[k, k] * polys[k] % p - step.sum(0)) % p
    return polys[d]


def combined(residues: dict[int, list[int]]) -> list[int]:
    """The whole numbers of least absolute value with the given residues by prime."""
    product = 1
    for p in residues:
        product *= p
    out = None
    for p, values in residues.items():
        rest = product // p
        lift = rest * pow(rest, -1, p)
        terms = [v * lift for v in values]
        out = terms if out is None else [a + b for a, b in zip(out, terms, strict=True)]
    reduced = [v % product for v in out]
    return [v - product if 2 * v > product else v for v in reduced]


class Roots:
    """Roots of a monic polynomial that has only real roots, none negative, as multiples of 2 ** -FRACTION."""

    def __init__(self, coefficients: list[int]):
        d = len(coefficients) - 1
        self.scaled = [c << (FRACTION * (d - k)) for k, c in enumerate(coefficients)]
        # the sum of the roots is an upper bound
        self.top = (-coefficients[d - 1] << FRACTION) + 1 if d else 0

    def above(self, a: int) -> int:
        """Number of roots above ``a``, by multiplicity."""
        shifted = self.scaled[::-1]
        for end in range(len(shifted), 1, -1):
            for i in range(1, end):
                shifted[i] += a * shifted[i - 1]
        signs = [c > 0 for c in shifted if c]
        return sum(x != y for x, y in zip(signs, signs[1:], strict=False))

    def value(self, a: int) -> int:
        out = 0
        for c in reversed(self.scaled):
            out = out * a + c
        return out

    def largest(self, count: int) -> list[tuple[int, int]]:
        """(root, multiplicity) downwards, until ``count`` positive roots are covered."""
        found, todo = [], [(0, self.top, self.above(0), 0)]
        while todo and sum(m for _, m in found) < count:
            low, high, n_low, n_high = todo.pop()  # n_low roots above low, n_high above high
            if n_low == n_high:
                continue
            if n_low - n_high == 1:
                found.append((self._refined(low, high, n_high), 1))
            elif high - low == 1:
                found.append((high, n_low - n_high))
            else:
                middle = (low + high) // 2
                n = self.above(middle)
                todo += [(low, middle, n_low, n), (middle, high, n, n_high)]
        return found

    def _refined(self, low: int, high: int, n_high: int) -> int:
        """The only root in (low, high], to one unit: right of a point the sign tells the parity of the roots above it."""
        while high - low > 1:
            middle = (low + high) // 2
            at = self.value(middle)
            if not at:
                return middle
            low, high = (low, middle) if (at > 0) == (n_high % 2 == 0) else (middle, high)
        return high


def null_space(matrix: list[list[int]], root: int, count: int) -> np.ndarray:
    """``count`` orthonormal eigenvectors for a root (in units of 2 ** -FRACTION) of that multiplicity, rounded to doubles."""
    d = len(matrix)
    a = np.array(matrix, dtype=object).reshape(d, d) << POINT
    for i in range(d):
        a[i, i] -= root << (POINT - FRACTION)
    order, factors = [], []
    for k in range(d):
        at = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        order.append(at)
        if at != k:
            a[[k, at]] = a[[at, k]]
        if not a[k, k]:
            a[k, k] = 1
        f = (a[k + 1 :, k] << POINT) // a[k, k]
        factors.append(f)
        if k + 1 < d:
            a[k + 1 :, k + 1 :] -= (f[:, None] * a[k, k + 1 :][None, :]) >> POINT
    out: list[np.ndarray] = []
    for nth in range(count):
        x = np.array([(1 << POINT) + ((((i + 1) * (2 * nth + 7919)) % 1009) << (POINT - 10)) for i in range(d)], dtype=object)
        for _ in range(3):
            for k in range(d):
                if order[k] != k:
                    x[[k, order[k]]] = x[[order[k], k]]
                x[k + 1 :] -= (factors[k] * x[k]) >> POINT
            for k in range(d - 1, -1, -1):
                x[k] = ((x[k] - ((a[k, k + 1 :] * x[k + 1 :]).sum() >> POINT if k + 1 < d else 0)) << POINT) // a[k, k]
            for other in out + out:
                x = x - ((((x * other).sum() >> POINT) * other) >> POINT)
            x = (x << POINT) // isqrt((x * x).sum())
        out.append(x)
    vectors = np.array([[v / (1 << POINT) for v in x] for x in out])
    for v in vectors:  # of either sign, the one whose largest entry is positive
        if v[np.argmax(np.abs(v))] < 0:
            v *= -1
    return vectors
