"""Texts of an Arrow batch as numpy arrays: words, lines, and rolling hashes over them.

Everything works on the UTF-8 bytes of many documents at once. ``bounds`` holds the first byte
of each document and, at the end, the number of bytes; no word, line or window crosses it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_U = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# [^\x20\x09-\x0D]+ : anything but ASCII white space
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing: digits, letters, all that is not ASCII
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

NOT_CONTINUED = (np.arange(256) & 0xC0) != 0x80


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the bounds of its rows; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held, bounds


def row_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of at most ``limit`` bytes, one row at least: (first, end, data, bounds)."""
    data, bounds = text_bytes(column)
    first, rows = 0, len(column)
    while first < rows:
        end = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[bounds[first] : bounds[end]], bounds[first : end + 1] - bounds[first]
        first = end


def words(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and for each document the number of its first word."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    before, after = inside[:-2].copy(), inside[2:].copy()
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(inside[1:-1] & ~before)
    ends = np.flatnonzero(inside[1:-1] & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""First byte and end of each \n-split line (an empty document has one), first line of each document."""
    breaks = np.flatnonzero(data == 10)
    rows = np.searchsorted(bounds, breaks, "right") - 1
    count = np.bincount(rows, minlength=len(bounds) - 1) + 1
    first = np.concatenate([[0], np.cumsum(count)])
    starts, ends = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    at = np.arange(len(breaks)) + rows
    ends[at], starts[at + 1] = breaks, breaks + 1
    starts[first[:-1]], ends[first[1:] - 1] = bounds[:-1], bounds[1:]
    return starts, ends, first


def owners(first: np.ndarray) -> np.ndarray:
    """The document of each word, line or byte, from the first one of each document."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Total of the values of each document."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64 if values.dtype.kind in "biu" else float)])
    return total[first[1:]] - total[first[:-1]]


def mix(value: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    value = value ^ (value >> _U(30))
    value = value * _U(0xBF58476D1CE4E5B9)
    value ^= value >> _U(27)
    value *= _U(0x94D049BB133111EB)
    value ^= value >> _U(31)
    return value


_powers: dict[int, np.ndarray] = {}


def _power(base: int, count: int) -> np.ndarray:
    held = _powers.get(base)
    if held is None or len(held) < count:
        size = max(count, 1 << 21)
        held = np.full(size, base, np.uint64)
        held[0] = 1
        np.multiply.accumulate(held, out=held)
        if size <= 1 << 21:
            _powers[base] = held
    return held[:count]


def range_hash(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ranges [start, end) of uint64 symbols, equal for equal ranges."""
    total = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * _power(_MULTIPLIER, len(symbols)), out=total[1:])
    value = (total[ends] - total[starts]) * _power(_INVERSE, len(symbols) + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64))


def byte_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(_BYTE_VALUES[data], starts, ends)


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Where a window of ``size`` consecutive items fits into its document."""
    fits = np.maximum(np.diff(first) - size + 1, 0)
    at = np.concatenate([[0], np.cumsum(fits)])
    return np.arange(at[-1]) + np.repeat(first[:-1] - at[:-1], fits)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    found = np.zeros(len(keys), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def covered(starts: np.ndarray, ends: np.ndarray, count: int) -> np.ndarray:
    """Which of ``count`` items lie in one of the ranges [start, end)."""
    change = np.bincount(starts, minlength=count + 1) - np.bincount(ends, minlength=count + 1)
    return np.cumsum(change[:count]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First item and end of each maximal run of true flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def lists(values: pa.Array | np.ndarray, first: np.ndarray) -> pa.ListArray:
    """A list column: the values between each row's first one and the next row's."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))
