"""Vectorised 64-bit hashes of substrings, from prefix sums modulo 2**64.

A byte at position i adds (random number of the byte) * M**i; a substring's sum is the difference
of two prefix sums, moved to position 0 by the inverse power, and mixed with its length."""

from __future__ import annotations

import numpy as np

_MULTIPLIER = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept, and made anew when a longer run is asked for."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * powers(len(raw), _MULTIPLIER), dtype=np.uint64, out=out[1:])
    return out


def substring_hashes(prefix: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
    """Hashes of [start, end), given as index arrays or as slices of equal length."""
    total = prefix[end] - prefix[start]
    down = powers(len(prefix), pow(_MULTIPLIER, -1, 1 << 64))[start]
    length = np.uint64(end.start - start.start) if isinstance(start, slice) else (end - start).astype(np.uint64)
    return mixed(total * down + length)


__all__ = ["mixed", "powers", "prefix_hashes", "substring_hashes"]
