"""Rolling hashes over numpy arrays, in arithmetic modulo 2**64.

With prefix sums P[i] = sum of x[j] * B**-j for j < i, the hash of x[i:i+n] is
(P[i+n] - P[i]) * B**(i+n-1): one pass serves windows of every length.
"""

from __future__ import annotations

import numpy as np

# Odd multipliers of the rolling hashes, and the finaliser constants of SplitMix64.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xD1342543DE82EF95, 0xA0761D6478BD642F)
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX_1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**0..B**(n-1) and the same powers of its inverse; kept and grown per base."""
    held = _POWERS.get(base)
    if held is None or len(held[0]) < n:
        size = max(n, 1 << 16)
        up, down = (np.full(size, b, np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        up[0] = down[0] = 1
        held = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if size <= 1 << 22:  # tables for one very long text are not kept
            _POWERS[base] = held
    return held


def prefix_sums(x: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * powers(base, len(x))[1][: len(x)], dtype=np.uint64, out=out[1:])
    return out


def spans_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of x[s:e] for each pair of non-empty spans, the same wherever its values stand."""
    up = powers(base, len(sums))[0]
    return (sums[ends] - sums[starts]) * up[ends - 1]


def words(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts laid end to end.

    Returns starts, ends, and for each text the number of its first word (one more entry
    closes the last text). ``limits`` are the texts' byte limits.
    """
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[limits] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[limits] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, limits)


def word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit value per word."""
    hashed = spans_hash(prefix_sums(data.astype(np.uint64) + np.uint64(1), BYTE_BASE), starts, ends, BYTE_BASE)
    return mix(hashed ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def windows_hash(values: np.ndarray, starts: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hash of values[s:s+n] for each start."""
    return spans_hash(prefix_sums(values, base), starts, starts + n, base)
