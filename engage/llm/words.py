"""Words of Arrow text columns as numpy arrays: bounds and 64-bit hashes, many texts at a time.

Texts are handled in chunks of bounded bytes and rows, so memory does not grow with the batch; one text longer than a
chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 4096
# An odd multiplier has an inverse modulo 2^64, so hashes of all words follow from one running sum.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int, cache: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    have = cache.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        have[0] = 1
        have = cache[base] = np.multiply.accumulate(have)
    return have[:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over each other (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(
    texts: pa.Array, most_bytes: int = CHUNK_BYTES, most_rows: int = CHUNK_ROWS
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, row after the last, bytes, bounds`` of consecutive runs of rows; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + n + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most_bytes, side="right")) - 1
        last = min(max(last, first + 1), first + most_rows, n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(
    data: np.ndarray, bounds: np.ndarray, separator: np.ndarray = _SEPARATOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each text (plus the total).

    ``separator`` tells for each byte value whether it parts words.
    """
    word = ~separator[data]
    before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of words; ``lower`` folds A-Z. Any spans of bytes will do, given as rows of starts and ends."""
    if lower:
        data = _LOWER[data]
    n = len(data)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=total[1:])
    return mix64((total[ends] - total[starts]) * _powers(_INVERSE, n + 1)[starts])


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words: entry i is the run from word i on."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(size, dtype=np.uint64)
    for k in range(n):
        h = h * np.uint64(_BASE) + words[k : k + size]
    return mix64(h)
