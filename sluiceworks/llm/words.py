r"""Words of UTF-8 texts as numpy arrays.

A word is a run of ``[^\x20\x09-\x0D]``; those separators are single bytes in UTF-8, so words are
found and hashed on the raw bytes, many documents at once. Two words are taken as equal if their
64-bit hashes are.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from sluiceworks.llm.common import buffers_of, fmix

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


# Everything in ASCII but letters and digits.
IS_BREAK = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


def _weights(lower: bool) -> np.ndarray:
    out = fmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return out[LOWER] if lower else out


_WEIGHTS = {low: _weights(low) for low in (False, True)}


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to size - 1."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        column = np.full(size, base, np.uint64)
        column[0] = 1
        out.append(np.cumprod(column, dtype=np.uint64))
    return out[0], out[1]


class Words:
    """Words of a string array: ``starts``, ``ends`` (byte positions), ``doc`` and ``first``.

    ``first[d] : first[d + 1]`` are the words of document ``d``. ``separators``: which bytes part words.
    """

    def __init__(self, texts: pa.Array, separators: np.ndarray = IS_SPACE):
        self.data, self.offsets = buffers_of(texts)
        space = self.space = separators[self.data]
        before = np.empty(len(space) + 1, bool)
        before[0] = True
        before[1:] = space
        inner = self.offsets[self.offsets < len(space)]
        start = ~space
        edge = before[:-1].copy()
        edge[inner] = True
        self.starts = np.flatnonzero(start & edge)
        after = np.empty(len(space) + 1, bool)
        after[:-1] = space
        after[-1] = True
        after[self.offsets] = True
        self.ends = np.flatnonzero(start & after[1:]) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of each word, with A-Z in lower case if asked for."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        size = 1 << max(12, int(len(self.data) - 1).bit_length())
        power, inverse = _powers(size)
        terms = _WEIGHTS[lower][self.data] * power[: len(self.data)]
        terms[self.space] = 0
        sums = np.add.reduceat(terms, self.starts)
        return fmix(sums * inverse[self.starts])


def windows(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words inside one document, and the place of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[width - 1 :])
    factors = fmix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.zeros(len(at), np.uint64)
    for k in range(width):
        out += hashes[at + k] * factors[k]
    return fmix(out), at
