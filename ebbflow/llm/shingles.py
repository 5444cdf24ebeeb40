"""Hashed word shingles of UTF-8 texts, by numpy over the bytes of many texts at once."""

from __future__ import annotations

import numpy as np

_rng = np.random.Generator(np.random.Philox(7))
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTE[_SPACE] = 0
#: For words without punctuation: ASCII other than letters and digits parts words too.
_LETTERLESS = _SPACE.copy()
_LETTERLESS[[b for b in range(128) if not chr(b).isalnum()]] = True
_R = np.uint64(0x5851F42D4C957F2D)
_R_INVERSE = np.uint64(pow(int(_R), -1, 1 << 64))
_PLACE = _rng.integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes hashed at once; a longer word makes its part longer.
PART = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finish."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(r: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, r)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = [_powers(_R, 1), _powers(_R_INVERSE, 1)]


def _word_hashes(data: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Of bytes that begin and end at word borders. A word's hash doesn't depend on its place."""
    if len(_POWERS[0]) < len(data):
        _POWERS[:] = _powers(_R, len(data)), _powers(_R_INVERSE, len(data))
    inside = np.concatenate(([False], ~gap[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _POWERS[0][: len(data)])))
    return mixed((sums[ends] - sums[starts]) * _POWERS[1][starts] if len(starts) else np.empty(0, np.uint64))


def word_hashes(text: bytes, plain: bool = False) -> np.ndarray:
    """A 64-bit hash of each word, in order; A-Z are lower-cased. plain: words are parted by ASCII punctuation too."""
    data, out, at = np.frombuffer(text, np.uint8), [], 0
    gap = _LETTERLESS if plain else _SPACE
    while at < len(data):
        end = min(at + PART, len(data))
        while end < len(data) and not gap[data[end]]:
            end += 1
        out.append(_word_hashes(data[at:end], gap))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingle_set(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; of fewer words, their whole sequence as one; none without words."""
    words = word_hashes(text or b"")
    if not len(words):
        return words
    k = min(n, len(words))
    out = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        out += words[i : i + len(out)] * _PLACE[i]
    return np.unique(mixed(out + np.uint64(k)))
