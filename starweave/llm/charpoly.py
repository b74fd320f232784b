"""Characteristic polynomials of integer matrices, their largest roots and eigenvectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import comb, isqrt

import numpy as np

#: Primes below this: a product of two residues fits a signed 64-bit number.
PRIME_LIMIT = 1 << 31
#: Roots closer than this share of the trace count as one root of several vectors.
CLUSTER_BITS = 160
#: Bits to which a root is refined, as a share of the trace, and bits of fixed-point numbers.
ROOT_BITS = 256
FIXED_BITS = 384
#: Inverse iteration shifts a root by this share of the trace, so that no pivot vanishes.
SHIFT_BITS = 200


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that are exact below 3.2e9."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        if all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes() -> Iterator[int]:
    """Primes below ``PRIME_LIMIT``, falling."""
    return (n for n in range(PRIME_LIMIT - 1, 1, -2) if is_prime(n))


def coefficient_bits(matrix: Sequence[Sequence[int]]) -> int:
    """Bits that hold every coefficient, for a matrix without negative eigenvalues.

    The k-th symmetric function of d such numbers is at most comb(d, k) (trace / d)^k.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    return max((comb(d, k) * trace**k // d**k + 1).bit_length() for k in range(d + 1)) + 2


def _inverse(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """a^(p - 2), element by element: the inverses modulo primes."""
    out, power, base = np.ones_like(a), p - 2, a % p
    while power.any():
        out = np.where(power & 1, out * base % p, out)
        base, power = base * base % p, power >> 1
    return out


def polynomials(matrix: Sequence[Sequence[int]], moduli: Sequence[int]) -> np.ndarray:
    """Characteristic polynomial modulo each prime, coefficients from the constant up.

    The matrix is brought to Hessenberg form by similarity (rows are cleared below the
    subdiagonal, columns changed to match), for all primes at once; the polynomial then
    follows from those of the leading blocks.
    """
    d, m = len(matrix), len(moduli)
    p = np.array(moduli, np.int64)
    p1, p2 = p[:, None], p[:, None, None]
    a = np.array([[[x % q for x in row] for row in matrix] for q in moduli], np.int64).reshape(m, d, d)
    every = np.arange(m)
    for k in range(d - 2):
        # A pivot below the diagonal; primes for which there is none need no step.
        row = k + 1 + np.argmax(a[:, k + 1 :, k] != 0, axis=1)
        if (row != k + 1).any():
            a[every, k + 1], a[every, row] = a[every, row].copy(), a[every, k + 1].copy()
            a[every, :, k + 1], a[every, :, row] = a[every, :, row].copy(), a[every, :, k + 1].copy()
        factor = a[:, k + 2 :, k] * _inverse(a[:, k + 1, k], p)[:, None] % p1
        a[:, k + 2 :] = (a[:, k + 2 :] - factor[:, :, None] * a[:, None, k + 1]) % p2
        gained = (a[:, :, k + 2 :] * factor[:, None, :] % p2).sum(axis=2)
        a[:, :, k + 1] = (a[:, :, k + 1] + gained) % p1
    leading = [np.zeros((m, d + 1), np.int64)]
    leading[0][:, 0] = 1
    for k in range(d):
        poly = np.zeros_like(leading[0])
        poly[:, 1:] = leading[k][:, :-1]
        chain = np.ones(m, np.int64)
        for i in range(k, -1, -1):
            poly = (poly - (a[:, i, k] * chain % p)[:, None] * leading[i]) % p1
            if i:
                chain = chain * a[:, i, i - 1] % p
        leading.append(poly)
    return leading[d]


def combine(residues: Sequence[Sequence[int]], moduli: Sequence[int]) -> list[int]:
    """Integers of either sign from their residues, by the Chinese remainder theorem."""
    whole = 1
    for q in moduli:
        whole *= q
    parts = [(whole // q, pow(whole // q, -1, q)) for q in moduli]
    out = []
    for at in range(len(residues[0])):
        value = sum(r[at] * inverse % q * rest for r, q, (rest, inverse) in zip(residues, moduli, parts))
        value %= whole
        out.append(value - whole if 2 * value > whole else value)
    return out


class Roots:
    """The largest roots of an integer polynomial whose roots are all real and not negative.

    Places are dyadic numbers A / 2^s, held as pairs (A, s).
    """

    def __init__(self, coefficients: Sequence[int]):
        zeros = next(i for i, c in enumerate(coefficients) if c)
        self.c = list(coefficients[zeros:])
        #: Roots that are not zero, with their multiplicity.
        self.rank = len(self.c) - 1
        self.top = max(1, -self.c[-2]) if self.rank else 0  # their sum
        self.known: dict[tuple[int, int], int] = {}

    def above(self, a: int, s: int) -> int:
        """How many roots exceed a / 2^s: the sign changes of the shifted polynomial, which
        Descartes' rule makes exact where all roots are real."""
        if (a, s) not in self.known:
            c = [x << (s * (self.rank - i)) for i, x in enumerate(self.c)]
            for i in range(self.rank):
                for j in range(self.rank - 1, i - 1, -1):
                    c[j] += a * c[j + 1]
            signs = [x > 0 for x in c if x]
            self.known[a, s] = sum(x != y for x, y in zip(signs, signs[1:]))
        return self.known[a, s]

    def sign(self, a: int, s: int) -> int:
        value = 0
        for i, x in enumerate(reversed(self.c)):
            value = value * a + (x << (s * i))
        return (value > 0) - (value < 0)

    def isolated(self, count: int) -> list[tuple[int, int, int, int]]:
        """Intervals (a, b, s, n): n roots lie in (a / 2^s, b / 2^s], from the largest on,
        until they hold ``count`` roots. Only roots within a cluster share one."""
        least = self.top.bit_length() - CLUSTER_BITS  # log2 of a cluster's width
        found: list[tuple[int, int, int, int]] = []
        todo = [(0, 1 << self.top.bit_length(), 0)] if self.rank else []
        while todo and sum(f[3] for f in found) < count:
            a, b, s = todo.pop()
            n = self.above(a, s) - self.above(b, s)
            if n == 0:
                continue
            # A root alone must not be at an end of its interval, where signs vanish.
            if n == 1 and self.sign(b, s) or (b - a).bit_length() - 1 - s <= least:
                found.append((a, b, s, n))
                continue
            if (b - a) % 2:
                a, b, s = 2 * a, 2 * b, s + 1
            todo += [(a, (a + b) // 2, s), ((a + b) // 2, b, s)]
        return found

    def refined(self, a: int, b: int, s: int, n: int) -> tuple[int, int]:
        """A place within ``ROOT_BITS`` of the root of an interval, by bisection."""
        last = ROOT_BITS - self.top.bit_length()
        side = self.sign(b, s)
        while n == 1 and (b - a).bit_length() - 1 - s > -last:
            if (b - a) % 2:
                a, b, s = 2 * a, 2 * b, s + 1
            middle = (a + b) // 2
            here = self.sign(middle, s)
            if here == 0:
                return middle, s
            a, b = (a, middle) if here == side else (middle, b)
        return a + b, s + 1

    def largest(self, count: int) -> list[tuple[int, int, int]]:
        """(a, s, n): places and multiplicities of at least ``count`` roots, if there are so many."""
        return [(*self.refined(*interval), interval[3]) for interval in self.isolated(count)]


def null_vectors(matrix: Sequence[Sequence[int]], a: int, s: int, n: int) -> list[list[int]]:
    """``n`` orthogonal vectors of length 2^FIXED_BITS that the matrix less a / 2^s (nearly)
    maps to zero: inverse iteration in fixed-point numbers."""
    d, f = len(matrix), FIXED_BITS
    trace = sum(matrix[i][i] for i in range(d))
    unit = trace.bit_length()  # entries become shares of about the trace
    near = (a << (f - unit)) >> s if f >= unit else a >> (s + unit - f)
    near += 1 << (f - (SHIFT_BITS if n == 1 else CLUSTER_BITS - 10))
    lower: list[tuple[int, list[int]]] = []
    rows = [[(x << f) >> unit for x in row] for row in matrix]
    for i in range(d):
        rows[i][i] -= near
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(rows[i][k]))
        rows[k], rows[best] = rows[best], rows[k]
        head = rows[k]
        head[k] = head[k] or 1
        factors = []
        for i in range(k + 1, d):
            row = rows[i]
            q = (row[k] << f) // head[k]
            factors.append(q)
            if q:
                row[k + 1 :] = [x - (q * y >> f) for x, y in zip(row[k + 1 :], head[k + 1 :])]
        lower.append((best, factors))

    def solve(v: list[int]) -> list[int]:
        v = v.copy()
        for k, (best, factors) in enumerate(lower):
            v[k], v[best] = v[best], v[k]
            for i, q in enumerate(factors, k + 1):
                v[i] -= q * v[k] >> f
        for k in range(d - 1, -1, -1):
            rest = sum(x * y for x, y in zip(rows[k][k + 1 :], v[k + 1 :])) >> f
            v[k] = ((v[k] - rest) << f) // rows[k][k]
        return v

    out: list[list[int]] = []
    start = np.random.default_rng(d)
    for _ in range(n):
        v = [int(x) << (f - 60) for x in start.integers(-(1 << 60), 1 << 60, d)]
        for _ in range(3):
            v = _unit(solve(v), f)
            for other in out:
                along = sum(x * y for x, y in zip(v, other)) >> f
                v = [x - (along * y >> f) for x, y in zip(v, other)]
            v = _unit(v, f)
        out.append(v)
    return out


def _unit(v: list[int], f: int) -> list[int]:
    length = isqrt(sum(x * x for x in v)) or 1
    return [(x << f) // length for x in v]
