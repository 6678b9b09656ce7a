"""Prefix polynomial hashes modulo 2**64, vectorized over byte arrays."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Powers that a worker keeps between its work; longer arrays go with `forget`.
KEPT = 1 << 18
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the word."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


#: A fixed random word per byte value.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n + n // 4, KEPT), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps, out=steps)
    return have[:n]


def forget() -> None:
    for base, have in list(_powers.items()):
        if len(have) > KEPT:
            del _powers[base]


def prefixes(raw: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] the hash of raw[i:j] times BASE**i."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE[raw] * _power(_BASE, len(raw)), out=out[1:])
    return out


def spans(s: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of raw[lo:hi] for each pair, the same wherever the bytes stand."""
    return (s[hi] - s[lo]) * _power(_INVERSE, len(s))[lo]


def grams(s: np.ndarray, k: int) -> np.ndarray:
    """Mixed hash of every k bytes in a row."""
    n = max(0, len(s) - k)
    return mix((s[k : k + n] - s[:n]) * _power(_INVERSE, len(s))[:n])


def sliding(a: np.ndarray, w: int, f) -> np.ndarray:
    """f (minimum or maximum) of every w values in a row, in log2(w) passes."""
    if len(a) < w:
        return a[:0]
    have = 1
    while have < w:
        step = min(have, w - have)
        a = f(a[:-step], a[step:])
        have += step
    return a


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each run, end to end."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)
