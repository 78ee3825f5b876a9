"""64-bit hashes of a text's words in arrays, without a loop over words."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, _kept: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """The first n powers of the base and of its inverse (modulo 2 ** 64)."""
    if len(_kept.get("p", ())) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        for name, base in (("p", _BASE), ("q", _INVERSE)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _kept[name] = np.multiply.accumulate(x)
    return _kept["p"][:n], _kept["q"][:n]


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words (runs of anything but ASCII white space, A-Z lower-cased) in order, from running
    sums of byte values times powers of a base; none for null."""
    if not text:
        return np.zeros(0, np.uint64)
    raw = _LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    word = ~_WHITE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, np.uint64)
    p, q = powers(len(raw) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * p[:len(raw)], dtype=np.uint64)])
    return mix((sums[end] - sums[begin]) * q[begin] + (end - begin).astype(np.uint64))
