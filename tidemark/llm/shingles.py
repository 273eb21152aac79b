"""Word shingles of texts as 64-bit hashes, and their MinHash signatures; vectorised over bytes.

Words are maximal runs without ASCII white space, A-Z lower-cased. A shingle is
five consecutive words; a text of one to four words is one shingle, a text
without words has none.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, n.bit_length())
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _R, _U), np.full(size, _R_INVERSE, _U)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def words(text: bytes) -> np.ndarray:
    """A hash of each word, in order."""
    if not text:
        return np.zeros(0, _U)
    b = _LOWER[np.frombuffer(text, np.uint8)]
    inside = np.empty(len(b) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[b], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, _U)
    up, down = _power(len(b))
    total = np.zeros(len(b) + 1, _U)
    np.cumsum((b.astype(_U) + _U(1)) * up[: len(b)], out=total[1:])
    return mix((total[stop] - total[start]) * down[start] + (stop - start).astype(_U))


def shingles(text: bytes, size: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles."""
    w = words(text)
    if not len(w):
        return w
    n = max(len(w) - size + 1, 1)
    out = np.zeros(n, _U)
    for i in range(min(size, len(w))):
        out = mix(out + w[i : i + n] * _U(2 * i + 1))
    return np.unique(out)


class MinHash:
    """`count` minima of seeded multiply-shift hashes, 32 bits each."""

    def __init__(self, count: int, seed: int):
        r = np.random.default_rng(seed)
        self.a = r.integers(1, 1 << 63, count, dtype=_U) * _U(2) + _U(1)
        self.b = r.integers(0, 1 << 63, count, dtype=_U)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(values), 4096):
            part = values[at : at + 4096, None]
            out = np.minimum(out, ((part * self.a + self.b) >> _U(32)).min(0).astype(np.uint32))
        return out
