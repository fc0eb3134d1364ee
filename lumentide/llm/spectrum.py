"""Largest eigenvalues and eigenvectors of an exact integer matrix by its polynomial.

For symmetric positive semidefinite integer matrices. The characteristic polynomial is
computed modulo primes, each by reduction to Hessenberg form, and put together by Chinese
remainders. Since all its roots are real, Descartes' rule of signs counts the roots beyond
any number exactly, with multiplicity, which isolates the largest ones with certainty. Null
vectors follow by inverse iteration with integers scaled to a few hundred bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import accumulate
from math import comb, isqrt, prod

import numpy as np

#: Bits below the trace to which roots are refined; roots closer than that count as equal.
ROOT_BITS = 192
#: Bits of the scaled integers of the inverse iteration.
WORK_BITS = 2 * ROOT_BITS


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide for all numbers below 3 * 10 ** 9."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def coefficient_bound(a: Sequence[Sequence[int]]) -> int:
    """No coefficient of the polynomial is larger in magnitude (Maclaurin's inequality)."""
    d = len(a)
    mean = -(-sum(a[i][i] for i in range(d)) // d)
    return max(comb(d, k) * mean ** k for k in range(d + 1))


def enough_primes(bound: int) -> list[int]:
    """Primes below 2 ** 31 whose product exceeds twice the bound, and one more as a check."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= 2 * bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    while not _is_prime(n):
        n -= 2
    return [*found, n]


def polynomial_modulo(a: Sequence[Sequence[int]], primes: Sequence[int]) -> np.ndarray:
    """Characteristic polynomials modulo each prime, lowest coefficient first.

    All primes at once: the arrays have the prime as first axis. Products of residues stay
    below 2 ** 62.
    """
    d, big = len(a), np.array(a, object)
    p = np.array(primes, np.int64)
    h = np.stack([(big % q).astype(np.int64) for q in primes])
    p2, p3, every = p[:, None], p[:, None, None], np.arange(len(p))
    for m in range(1, d - 1):
        at = m + np.argmax(h[:, m:, m - 1] != 0, axis=1)
        rows = h[every, at].copy()
        h[every, at], h[:, m] = h[:, m].copy(), rows
        columns = h[every, :, at].copy()
        h[every, :, at], h[:, :, m] = h[:, :, m].copy(), columns
        # Without an entry other than zero there is nothing to eliminate: factors are zero.
        inverse = np.array([pow(int(x), -1, int(q)) if x else 0
                            for x, q in zip(h[:, m, m - 1], p)], np.int64)
        factor = h[:, m + 1:, m - 1] * inverse[:, None] % p2
        h[:, m + 1:] = (h[:, m + 1:] - factor[:, :, None] * h[:, None, m] % p3) % p3
        h[:, :, m] = (h[:, :, m] + (h[:, :, m + 1:] * factor[:, None] % p3).sum(axis=2)) % p2
    chain = np.zeros((len(p), d + 1, d + 1), np.int64)
    chain[:, 0, 0] = 1
    for k in range(1, d + 1):
        before = chain[:, k - 1]
        now = (np.pad(before, ((0, 0), (1, 0)))[:, :-1] - h[:, k - 1, k - 1, None] * before % p2)
        weight = np.ones(len(p), np.int64)
        weights = np.zeros((len(p), k - 1), np.int64)
        for i in range(k - 2, -1, -1):
            weight = weight * h[:, i + 1, i] % p
            weights[:, i] = weight * h[:, i, k - 1] % p
        chain[:, k] = (now - (weights[:, :, None] * chain[:, :k - 1] % p3).sum(axis=1)) % p2
    return chain[:, d]


def from_residues(primes: Sequence[int], residues: Sequence[Sequence[int]]) -> list[int]:
    """The polynomial with these residues and the smallest coefficients in magnitude.

    The last prime is not used but checks the result.
    """
    *used, check = primes
    product = prod(used)
    parts = [product // q * pow(product // q, -1, q) for q in used]
    found = []
    for column, expected in zip(zip(*residues[:-1]), residues[-1]):
        x = sum(int(r) * part for r, part in zip(column, parts)) % product
        found.append(x - product if 2 * x > product else x)
        if found[-1] % check != int(expected):
            raise ArithmeticError("residues of the polynomial don't fit together")
    return found


def _shifted(poly: Sequence[int], at: int, bits: int) -> list[int]:
    """Coefficients of the polynomial, with a positive factor, at `(y + at) / 2 ** bits`."""
    d = len(poly) - 1
    scaled = [c << (bits * (d - i)) for i, c in enumerate(poly)]
    if not at:
        return scaled
    # In units of `at` the shift is one; Horner's scheme is then a row of running sums.
    row, power = [], 1
    for c in scaled:
        row.append(c * power)
        power *= at
    row.reverse()
    out = []
    for n in range(d + 1, 0, -1):
        row = list(accumulate(row[:n]))
        out.append(row[-1])
    return out  # still in units of `at`, a positive number: signs are the same


def roots_above(poly: Sequence[int], at: int, bits: int) -> int:
    """How many roots, with multiplicity, are greater than `at / 2 ** bits`, for `at` >= 0."""
    signs = [c > 0 for c in _shifted(poly, at, bits) if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: Sequence[int], at: int, bits: int) -> int:
    value = 0
    for i, c in enumerate(reversed(poly)):
        value = value * at + (c << (bits * i))
    return (value > 0) - (value < 0)


def largest_roots(poly: Sequence[int], count: int) -> list[tuple[Fraction, int]]:
    """The `count` largest positive roots with multiplicity, as (root, multiplicity), falling.

    The polynomial has real roots only, none negative. Bisection by exact counts isolates a
    root, then exact signs refine it to ROOT_BITS below a bound of the roots.
    """
    zeros = next(i for i, c in enumerate(poly) if c)
    poly = poly[zeros:]
    total = len(poly) - 1
    count = min(count, total)
    if not count:
        return []
    top = (-poly[-2]).bit_length()  # the sum of all roots is below 2 ** top
    found: list[tuple[Fraction, int]] = []

    def bisect(low: int, bits: int, above_low: int, above_high: int) -> None:
        """Roots in (low, low + 1] / 2 ** bits; `above` count those beyond either end."""
        while above_high < min(above_low, count):
            if above_low - above_high == 1 or top + bits >= ROOT_BITS:
                break
            low, bits = 2 * low, bits + 1
            if bits > 0:
                middle = roots_above(poly, low + 1, bits)
            else:
                middle = roots_above(poly, (low + 1) << -bits, 0)
            if middle > above_high:
                bisect(low + 1, bits, middle, above_high)
                above_high = middle
        if above_high >= min(above_low, count):
            return
        if above_low - above_high == 1:
            side = (-1) ** above_high  # the sign right of the root
            while top + bits < ROOT_BITS:
                low, bits = 2 * low, bits + 1
                sign = (_sign(poly, low + 1, bits) if bits > 0
                        else _sign(poly, (low + 1) << -bits, 0))
                if sign == 0:
                    found.append((Fraction(low + 1) / Fraction(2) ** bits, 1))
                    return
                if sign != side:
                    low += 1
        found.append((Fraction(2 * low + 1, 2) / Fraction(2) ** bits, above_low - above_high))

    bisect(0, -top, total, 0)
    return found


def _eliminated(m: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """LU with row exchanges, in place, of scaled integers."""
    d, order = len(m), []
    for k in range(d):
        at = k + int(np.argmax([abs(x) for x in m[k:, k]]))
        order.append(at)
        m[[k, at]] = m[[at, k]]
        pivot = m[k, k] = m[k, k] or 1
        factor = np.array([(int(x) << WORK_BITS) // pivot for x in m[k + 1:, k]], object)
        if k + 1 < d:
            m[k + 1:, k + 1:] -= np.multiply.outer(factor, m[k, k + 1:]) >> WORK_BITS
            m[k + 1:, k] = factor
    return m, order


def _solved(m: np.ndarray, order: list[int], v: np.ndarray) -> np.ndarray:
    d, v = len(m), v.copy()
    for k, at in enumerate(order):
        v[[k, at]] = v[[at, k]]
    for k in range(d - 1):
        v[k + 1:] -= (m[k + 1:, k] * v[k]) >> WORK_BITS
    for k in range(d - 1, -1, -1):
        v[k] = (int(v[k]) << WORK_BITS) // m[k, k]
        v[:k] -= (m[:k, k] * v[k]) >> WORK_BITS
    return v


def _unit(v: np.ndarray, others: Sequence[np.ndarray]) -> np.ndarray:
    """Orthogonal to the others and of length one, in scaled integers."""
    excess = max(max(abs(int(x)).bit_length() for x in v) - WORK_BITS, 0)
    v = v >> excess
    for _ in range(2):
        for o in others:
            v = v - ((o * (int((v * o).sum()) >> WORK_BITS)) >> WORK_BITS)
    length = isqrt(int((v * v).sum())) or 1
    return np.array([(int(x) << WORK_BITS) // length for x in v], object)


def eigenvectors(a: Sequence[Sequence[int]], root: Fraction, multiplicity: int) -> Iterator[np.ndarray]:
    """Unit vectors spanning the null space of `a - root`, in double precision.

    The greatest component in magnitude, the first of them, is positive. Of a multiple root
    it is one orthonormal basis, always the same.
    """
    d = len(a)
    top = max(sum(a[i][i] for i in range(d)).bit_length(), 1)
    unit = WORK_BITS - top
    scaled = np.array([[x << unit if unit >= 0 else x >> -unit for x in row] for row in a], object)
    shift = root * Fraction(2) ** unit
    for i in range(d):
        scaled[i, i] -= shift.numerator // shift.denominator
    factors, order = _eliminated(scaled)
    basis: list[np.ndarray] = []
    for i in range(multiplicity):
        # Any start with a share of the null space will do; these are linearly independent.
        v = np.array([((j * j + 3) * (i + 7) ** 3 % 1009 + 1) << (WORK_BITS - 10)
                      for j in range(d)], object)
        for _ in range(3):
            v = _unit(_solved(factors, order, v), basis)
        basis.append(v)
        out = np.array([int(x) / (1 << WORK_BITS) for x in v])
        yield out if out[np.argmax(np.abs(out))] > 0 else -out
