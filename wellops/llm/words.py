"""Words of many texts at once as 64-bit hashes, by array operations over their bytes."""

from __future__ import annotations

import numpy as np

_PRIME = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_PRIME, -1, 2**64)
_STEP = 1 << 12


def _separators(*ranges: tuple[int, int]) -> np.ndarray:
    flags = np.zeros(256, bool)
    for first, last in ranges:
        flags[first:last + 1] = True
    return flags


#: Bytes between words: blanks only, or everything ASCII but digits and small letters (after lower-casing).
BLANKS = _separators((0x20, 0x20), (0x09, 0x0D))
NOT_ALPHANUMERIC = _separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_VALUE = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        low = np.full(_STEP, base, np.uint64)
        low[0] = 1
        low = np.multiply.accumulate(low)
        high = np.full(-(-count // _STEP) or 1, pow(base, _STEP, 2**64), np.uint64)
        high[0] = 1
        return (np.multiply.accumulate(high)[:, None] * low).ravel()[:count]


class Hasher:
    """Keeps the tables of powers between batches."""

    def __init__(self, separators: np.ndarray):
        self.separators = separators
        self.power = self.inverse = np.ones(1, np.uint64)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of all lower-cased ``texts`` in order, and the number of words of each text.

        Equal words have equal hashes in every batch; different words differ but for chance, 2**-64 a pair.
        """
        raw = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)  # bytes.lower() changes A-Z alone
        if len(self.power) < len(raw) + 1:
            self.power, self.inverse = _powers(_PRIME, len(raw) + 1), _powers(_INVERSE, len(raw) + 1)
        gap = self.separators[raw]
        edge = np.flatnonzero(np.diff(gap, prepend=True))
        first, last = edge[0::2], edge[1::2]
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_VALUE[raw] * self.power[:len(raw)], out=sums[1:])
        hashes = mix((sums[last] - sums[first]) * self.inverse[first])
        ends = np.cumsum([len(t) + 1 for t in texts])
        return hashes, np.diff(np.searchsorted(first, ends), prepend=0)
