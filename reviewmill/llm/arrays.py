"""Flat numpy views of Arrow text columns, used inside Spark tasks.

Texts are taken as one byte buffer and offsets, in pieces of a bounded number of bytes (a longer text is a
piece of its own), so memory follows the piece and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once.
PIECE_BYTES = 2 << 20

#: Bytes hashed at once.
_STRETCH = 1 << 18
_FACTOR = 0xD6E8FEB86659FD93
_INVERSE = pow(_FACTOR, -1, 1 << 64)
#: ASCII space and the control characters tab to carriage return.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, np.ndarray] = {}


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        low, high = offsets[first], offsets[end]
        yield first, end, data[low:high], offsets[first : end + 1] - low
        first = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words of each text): the runs of bytes that aren't white space, cut at text borders."""
    n = len(data)
    inner = ~WHITE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inner
    here = np.zeros(n + 1, bool)
    here[:n] = inner
    starts = np.flatnonzero(here & (~before | cut))
    ends = np.flatnonzero(before & (~here | cut))
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, _STRETCH + 1)
        have = np.ones(size, np.uint64)
        done = 1
        while done < size:
            step = min(done, size - done)
            have[done : done + step] = have[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        if size <= 2 * _STRETCH:
            _powers[base] = have
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span; equal bytes have equal hashes wherever they stand.

    Spans come in order of both their starts and their ends.
    """
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):  # stretches of bounded length
        begin = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, begin + _STRETCH, "right")))
        part = data[begin : ends[high - 1]]
        total = np.zeros(len(part) + 1, np.uint64)
        np.multiply(part.astype(np.uint64) + np.uint64(1), _table(_FACTOR, len(part)), out=total[1:])
        np.cumsum(total, out=total)
        at = starts[low:high] - begin
        out[low:high] = (total[ends[low:high] - begin] - total[at]) * _table(_INVERSE, len(part) + 1)[at]
        low = high
    return mix(out)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each place on; equal bytes have equal hashes wherever they stand."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.multiply(data.astype(np.uint64) + np.uint64(1), _table(_FACTOR, len(data)), out=total[1:])
    np.cumsum(total, out=total)
    places = len(data) - size + 1
    return mix((total[size:] - total[:places]) * _table(_INVERSE, places))


def code_points(data: np.ndarray) -> np.ndarray:
    """Running count of code points: entry i is the number that begin before byte i."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def per_text(mask_or_counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of one entry per word for each text."""
    total = np.zeros(len(mask_or_counts) + 1, np.int64)
    np.cumsum(mask_or_counts, out=total[1:])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]
