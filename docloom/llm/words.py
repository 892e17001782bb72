"""Words of whole texts inside tasks: bytes in, NumPy arrays out.

``bytes.split()`` cuts at exactly the six characters [\\x20\\x09-\\x0D], so a word is a run of
other bytes, whatever the language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
MAX_STORED = 400_000
ODD = np.uint64(0x9E3779B97F4A7C15)


class Stored(dict):
    """word -> value, computed on first sight; emptied when full, which costs time only."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, word):
        if len(self) >= MAX_STORED:
            self.clear()
        value = self[word] = self.function(word)
        return value


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow string column as bytes, one at a time; null is empty."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py() or b""


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words() -> Stored:
    return Stored(xxhash.xxh3_64_intdigest)


def shingles(words: list[bytes], n: int, hashes: dict[bytes, int]) -> np.ndarray:
    """64-bit hash of each n-word window, in order; with fewer words, of the whole sequence."""
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    count = len(words) - width + 1
    out = np.full(count, width, np.uint64)
    for k in range(width):
        out = mix(out * ODD + ids[k : k + count])
    return out
