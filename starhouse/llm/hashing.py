"""64-bit hashes of words, many at once."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(90_210))
#: Odd factors that tell the places of a sequence apart.
FACTORS = _RANDOM.integers(1, 1 << 63, 16, dtype=np.uint64) | np.uint64(1)
_FIRST, _NEXT = (np.uint64(int(x) | 1) for x in _RANDOM.integers(1 << 60, 1 << 63, 2))
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
#: The first k bytes of eight, the lowest being the first.
_HEADS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers without visible order (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some bytes, cut at ASCII white space, and where they start.

    Words are read eight bytes at a time: most are done after one or two steps.
    """
    space = _SPACES[np.frombuffer(raw, dtype=np.uint8)]
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    eights = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=raw + bytes(8), strides=(1,))
    out = lengths.astype(np.uint64) * _FIRST
    rows, step = np.arange(len(starts)), 0
    while rows.size:
        left = lengths[rows] - step
        out[rows] = mixed(out[rows] * _NEXT + (eights[starts[rows] + step] & _HEADS[np.minimum(left, 8)]))
        rows, step = rows[left > 8], step + 8
    return out, starts
