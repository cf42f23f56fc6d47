"""Exact integer inner products from float32 matrix products, by residue numbers.

Components are reduced to symmetric residues modulo several small primes. A
float32 product of two residue matrices is exact as long as the columns times
the square of the largest residue stay below 2**24; wider matrices are multiplied
in column blocks. The residues of the product are put together by Chinese
remaindering, in mixed radix with symmetric digits, which gives the signed score.
"""

from __future__ import annotations

from functools import lru_cache
from math import isqrt

import numpy as np

#: float32 holds every integer up to this one.
EXACT = 1 << 24
#: Columns multiplied at once at most; fewer columns allow larger primes and so fewer products.
COLUMNS = 1024
#: Largest residue: a residue times a weight below twice its size is exact too.
MOST = 2047


@lru_cache(maxsize=64)
def primes_below(limit: int) -> tuple[int, ...]:
    """Odd primes below ``limit``, largest first."""
    sieve = np.ones(limit, bool)
    sieve[:2] = False
    for n in range(2, isqrt(limit) + 1):
        if sieve[n]:
            sieve[n * n :: n] = False
    return tuple(int(p) for p in np.flatnonzero(sieve)[::-1] if p > 2)


def choose_primes(columns: int, bound: int) -> list[int]:
    """Primes whose residues multiply exactly and whose product tells all scores from -bound to bound apart."""
    half = min(MOST, isqrt((EXACT - 1) // max(1, min(columns, COLUMNS))))
    chosen, product = [], 1
    for prime in primes_below(2 * half + 2):
        if chosen and product > 2 * bound:
            break
        chosen.append(prime)
        product *= prime
    if product <= 2 * bound:
        raise ValueError("components too large for residue numbers")
    return chosen


def score_bound(left: np.ndarray, right: np.ndarray) -> int:
    """No inner product of a row of ``left`` and one of ``right`` is larger in size."""
    if not left.size or not right.size:
        return 0
    most = left.shape[1] * int(np.abs(left).max()) * int(np.abs(right).max())
    with np.errstate(over="ignore"):
        lengths = [float(np.einsum("ij,ij->i", m, m).max()) for m in (left, right)]
        norm = lengths[0] * lengths[1]
    return min(most, int(norm**0.5 * 1.001) + 1) if np.isfinite(norm) else most


def _centre(values: np.ndarray, prime: int) -> np.ndarray:
    """Symmetric residues, in place; twice, as the first quotient may be off by one."""
    for _ in range(2):
        values -= np.rint(values * values.dtype.type(1 / prime)) * values.dtype.type(prime)
    return values


def residues(matrix: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """float32 symmetric residues of a float64 matrix of integers of any size."""
    return [_centre(np.fmod(matrix, p), p).astype(np.float32) for p in primes]


def _product(left: np.ndarray, right: np.ndarray, prime: int) -> np.ndarray:
    total = None
    for at in range(0, left.shape[1], COLUMNS):
        part = _centre(left[:, at : at + COLUMNS] @ right[:, at : at + COLUMNS].T, prime)
        total = part if total is None else _centre(total + part, prime)
    return np.zeros((len(left), len(right)), np.float32) if total is None else total


def scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """All inner products: float64 while their integers are exact in it, then int64, then Python integers."""
    digits: list[np.ndarray] = []
    for k, prime in enumerate(primes):
        digit, weight = _product(left[k], right[k], prime), 1
        # Take the value of the earlier digits away and divide by their weight, modulo this prime.
        for earlier, before in zip(digits, primes):
            digit = _centre(digit - _centre(earlier * np.float32(weight), prime), prime)
            weight = weight * before % prime
        inverse = pow(weight, -1, prime)
        inverse -= prime if 2 * inverse > prime else 0
        digits.append(_centre(digit * np.float32(inverse), prime))
    size = 1
    for prime in primes:
        size *= prime
    kind = np.float64 if size < 1 << 53 else np.int64 if size < 1 << 62 else object
    out, weight = 0, 1
    for digit, prime in zip(digits, primes):
        whole = digit.astype(np.float64 if kind is np.float64 else np.int64).astype(kind)
        out, weight = out + whole * weight, weight * prime
    return out
