"""Words of a text as 64-bit hashes, found on the bytes of the whole text at once."""

from __future__ import annotations

import numpy as np

_PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# letters and digits, and the bytes of characters beyond ASCII
IS_WORD = np.array([48 <= c <= 57 or 97 <= c <= 122 or c >= 128 for c in range(256)])
_WORD_BYTES = IS_WORD.tobytes()
_tables: list[np.ndarray] = []


def _power_tables(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, and the sums of the powers before each place."""
    if not _tables or len(_tables[0]) < size:
        powers = []
        for base in (_BASE, _INVERSE):
            table = np.full(max(size, 4096), np.uint64(base), dtype=np.uint64)
            table[0] = 1
            powers.append(np.cumprod(table))
        _tables[:] = [*powers, np.cumsum(powers[0]) - powers[0]]
    return _tables


def _hash_piece(b: bytes) -> np.ndarray:
    powers, inverses, power_sums = _power_tables(len(b) + 1)
    word = np.zeros(len(b) + 2, dtype=bool)
    word[1:-1] = np.frombuffer(b.translate(_WORD_BYTES), dtype=bool)
    edges = np.flatnonzero(word[1:] != word[:-1])  # a word begins and ends by turns
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.multiply(np.frombuffer(b, dtype=np.uint8), powers[:len(b)], out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    at = sums[edges] + power_sums[edges]  # every byte counts one more than its number
    h = (at[1::2] - at[::2]) * inverses[edges[::2]]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(text: str | None) -> np.ndarray:
    """One hash per word of the text in lower case. Long texts are hashed in pieces that end
    between words."""
    data = (text or "").lower().encode("utf-8", "surrogatepass")
    found, at = [], 0
    while at < len(data):
        to = min(len(data), at + _PIECE)
        while to < len(data) and IS_WORD[data[to - 1]] and IS_WORD[data[to]]:
            to += 1
        found.append(_hash_piece(data[at:to]))
        at = to
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
