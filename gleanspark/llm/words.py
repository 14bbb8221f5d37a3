"""Words of whole texts as numpy arrays, hashed without a Python object per word.

All separators in use are ASCII, so words are cut and lower-cased on UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text looked at together; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20
#: Words hashed together, which bounds the temporary arrays for very long texts.
_BLOCK_WORDS = 1 << 17

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything in ASCII but digits and letters.
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
#: The same with capitals, for texts that were not lower-cased.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_PLACES = _RANDOM.integers(0, 2**63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RANDOM.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_TERMS[63]) | 5
_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole 64-bit word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def text_pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, text bounds)`` for runs of texts of about ``limit`` bytes; null is empty."""
    if not len(column):
        return
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = pc.fill_null(column, "")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def find_words(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, word bounds of the texts)``; no word reaches over two texts."""
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def _places(n: int) -> np.ndarray:
    global _PLACES
    if n > len(_PLACES):
        more = np.random.Generator(np.random.PCG64(7)).integers(0, 2**63, max(n, 2 * len(_PLACES)), dtype=np.uint64)
        more = more * np.uint64(2) + np.uint64(1)
        more[: 1 << 12] = _PLACES[: 1 << 12]
        _PLACES = more
    return _PLACES


#: Places from which the second hash of a word takes its numbers.
SECOND = 2048


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, skip: int = 0) -> np.ndarray:
    """A 64-bit hash per word: each byte times a random odd number of its place, summed and mixed.

    With another ``skip`` other numbers are taken, so that ``0`` and ``SECOND`` give 128 bits together.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    for low in range(0, len(starts), _BLOCK_WORDS):
        high = min(low + _BLOCK_WORDS, len(starts))
        begin = starts[low:high]
        sizes = ends[low:high] - begin
        heads = np.concatenate(([0], np.cumsum(sizes)))
        place = np.arange(heads[-1]) - np.repeat(heads[:-1], sizes)
        at = place + np.repeat(begin, sizes)
        values = (data[at].astype(np.uint64) + np.uint64(1)) * _places(int(sizes.max()) + skip)[place + skip]
        out[low:high] = np.add.reduceat(values, heads[:-1]) + sizes.astype(np.uint64)
    return mix(out)


def windows_short(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words that start at each place, for ``k`` up to 60; the last ``k - 1`` places are cut."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        total += hashes[i : i + n] * _TERMS[i]
    return mix(total)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if n > len(_powers[0]):
        size = max(n, 2 * len(_powers[0]))
        both = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers = (both[0], both[1])
    return _powers


def windows_long(hashes: np.ndarray, k: int) -> np.ndarray:
    """As :func:`windows_short` for any ``k``, by running sums of a polynomial modulo 2^64."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    powers, inverses = _power_tables(len(hashes))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(hashes * powers[: len(hashes)], dtype=np.uint64)))
    return mix((sums[k:] - sums[:-k]) * inverses[:n])


def as_long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
