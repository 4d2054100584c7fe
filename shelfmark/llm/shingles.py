"""Word shingles of a text as 64-bit numbers.

Words are maximal runs without ASCII white space, lower-cased for A-Z only. A shingle's number is
mixed from its words' xxhash64 values, so equal shingles have equal numbers everywhere; two
different ones share a number with odds of 2 to the -64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import xxhash

from . import memos

_CACHED = 1 << 17
_TOGETHER = 1 << 15  # words
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHash()
memos.keep("shingles", _hashes.clear)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _combined(values: np.ndarray, take: int) -> np.ndarray:
    out = np.full(len(values) - take + 1, take, np.uint64)
    for k in range(take):
        out = mixed((out + values[k:len(values) - take + 1 + k]) * _ODD)
    return out


def shingle_lists(texts: Iterable[str | None], width: int) -> Iterator[np.ndarray]:
    """Every text's shingle numbers in the order of the words, repeats included. Texts are worked on
    together up to ``_TOGETHER`` words, which spares short texts most of the cost of small arrays."""
    memos.claim("shingles")
    held, size = [], 0
    for text in texts:
        held.append((text or "").encode().lower().split())
        size += len(held[-1])
        if size >= _TOGETHER:
            yield from _shingled(held, size, width)
            held, size = [], 0
    yield from _shingled(held, size, width)


def _shingled(held: list[list[bytes]], size: int, width: int) -> Iterator[np.ndarray]:
    values = np.fromiter(map(_hashes.__getitem__, chain.from_iterable(held)), np.uint64, size)
    every = _combined(values, width) if size >= width else None
    start = 0
    for n in map(len, held):
        yield (every[start:start + n - width + 1] if n >= width else
               _combined(values[start:start + n], n) if n else values[:0])
        start += n


def shingle_sets(texts: Iterable[str | None], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle numbers of every text; with fewer words, the whole sequence as one
    shingle."""
    return map(np.unique, shingle_lists(texts, width))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    return next(shingle_sets([text], width))
