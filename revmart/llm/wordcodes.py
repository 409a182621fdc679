"""Words of many texts as arrays of 64-bit codes, by numpy.

A word is a run of anything but a space and the characters U+0009 to U+000D; white space is found in the UTF-8
bytes, where these never occur inside another character.  Codes of words and of word sequences are polynomials
modulo 2**64, taken from prefix sums and mixed; equal words have equal codes in every batch.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Odd multipliers; any others would do.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit codes (the published SplitMix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    size = 1 << max(16, n.bit_length())  # few different sizes
    return _powers(pow(base, -1, 1 << 64) if inverse else base, size)[:n]


def spans(data: np.ndarray, is_gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in UTF-8 bytes; ``is_gap`` tells for every byte whether it separates words."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~is_gap[data]
    change = np.diff(inside)
    return np.nonzero(change == 1)[0], np.nonzero(change == -1)[0]


def range_codes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Code of ``values[start:end]`` for every pair; equal ranges have equal codes wherever they stand."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, max(n, 1))[:n], out=total[1:])
    return mixed((total[ends] - total[starts]) * powers(base, n + 1, inverse=True)[starts])


def joined_bytes(texts: list[str], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes with a space after each, and where each begins; ``lower`` changes A to Z."""
    encoded = [t.encode().lower() if lower else t.encode() for t in texts]
    return np.frombuffer(b" ".join(encoded), np.uint8), np.cumsum([0, *[len(e) + 1 for e in encoded]])


def codes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code of every word of UTF-8 bytes."""
    return range_codes(data.astype(np.uint64) + np.uint64(1), starts, ends, BYTE_BASE)


def word_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of the texts one after another, and the place of each text's first word (and the end)."""
    data, begins = joined_bytes(texts)
    starts, ends = spans(data)
    return codes_of(data, starts, ends), np.searchsorted(starts, begins)


def gram_codes(codes: np.ndarray, length: int) -> np.ndarray:
    """Code of the ``length`` words from every place on (as many places as have so many words after them)."""
    places = np.arange(max(0, len(codes) - length + 1))
    return range_codes(codes, places, places + length, WORD_BASE)
