"""Words of whole Arrow batches as numpy arrays, without a Python loop over texts.

The bytes of all texts of a batch lie in one buffer.  Word bounds come from a table of the
256 byte values, word hashes from differences of one running polynomial over the buffer.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


class Words(NamedTuple):
    doc: np.ndarray  # position in the batch of the text a word belongs to
    hash: np.ndarray  # 64-bit hash of the word's bytes
    first: np.ndarray  # for each text, the number of words before it; one more at the end


def byte_table(pattern_bytes: bytes) -> np.ndarray:
    """True for the byte values that belong to words."""
    table = np.zeros(256, bool)
    table[list(pattern_bytes)] = True
    return table


# Everything but blanks, tab to carriage return; the bytes of non-ASCII characters included.
NON_SPACE = byte_table(bytes(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D))
# Digits, small letters (capitals are lowered first) and the bytes of non-ASCII characters.
LETTERS = byte_table(bytes(b for b in range(256) if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the polynomial's base and of its inverse, for at least ``size`` bytes."""
    return _powers(1 << max(16, int(size).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offset of each text in them (one more at the end)."""
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def running_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial of the bytes; ``span_hash`` takes hashes of spans from it."""
    up, _ = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * up[: len(data)], out=total[1:])
    return total


def span_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes, equal for equal bytes wherever they stand."""
    _, down = powers(len(running))
    return mix((running[end] - running[start]) * down[start] + (end - start).astype(np.uint64))


def words_of(texts: pa.Array, table: np.ndarray) -> Words:
    """Words of a batch of texts with A-Z lowered; a missing text has none."""
    data, ends = text_buffer(texts)
    data = LOWER[data]
    inside = table[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[ends[:-1][ends[:-1] < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = ends[1:][ends[1:] > 0] - 1
    after[last] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, ends)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(doc, span_hash(running_hash(data), start, end), first)


def shingle_hashes(word: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; runs may cross texts."""
    n = max(0, len(word) - size + 1)
    total = np.zeros(n, np.uint64)
    factor = 1
    for k in range(size):
        factor = factor * 0xD1342543DE82EF95 % (1 << 64)
        total += word[k : k + n] * _U(factor)
    return mix(total)
