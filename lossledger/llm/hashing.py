"""Vectorised 64-bit hashes of byte and word spans.

A span's hash is a polynomial over its values modulo 2**64, taken from one running sum, so the hash of any window costs
the same whatever its length. Lanes differ in base and value table; two lanes make a 128-bit key.
"""

from __future__ import annotations

import numpy as np

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1
_TABLES = tuple(np.random.default_rng(2024 + lane).integers(0, 2**64, 256, dtype=np.uint64) for lane in (0, 1))
_powers: dict[tuple[int, bool], np.ndarray] = {}
#: Powers for so many values are kept for the next span sequence; a worker holds four such arrays as long as it lives.
_KEPT = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all others (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(lane: int, inverse: bool, n: int) -> np.ndarray:
    have = _powers.get((lane, inverse))
    if have is None or len(have) < n:
        base = pow(_BASES[lane], -1, 1 << 64) if inverse else _BASES[lane]
        steps = np.full(max(n, 1 << 16), base & _MASK, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= _KEPT:
            _powers[lane, inverse] = have
    return have[:n]


class Spans:
    """Hashes of spans of a value sequence: bytes, or the hashes of words."""

    def __init__(self, values: np.ndarray, lane: int = 0):
        values = _TABLES[lane][values] if values.dtype == np.uint8 else mix(values + np.uint64(_BASES[lane] >> 1)) if lane else values
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _power(lane, False, len(values)), out=self._sums[1:])
        self._back = _power(lane, True, len(values) + 1)

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._back[starts] + (ends - starts).astype(np.uint64))
