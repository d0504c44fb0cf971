"""Words of whole Arrow columns as 64-bit hashes, by numpy, a slice of bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of ordered pairs of hashes."""
    return mix(a * np.uint64(0xC2B2AE3D27D4EB4F) + mix(b + np.uint64(0x165667B19E3779F9)))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    size = max(SLICE * 2, 1 << int(n).bit_length())
    if size not in _powers:
        one = np.ones(size, np.uint64)
        up, down = one * _BASE, one * _BASE_INVERSE
        up[0] = down[0] = 1
        _powers.clear()
        _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row starts and ends (one number more than rows). Null: empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> Iterator[tuple[int, int]]:
    """Slices of about SLICE bytes that end at a row's end or a space."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + SLICE, n)
        if end < n:
            row_end = int(offsets[np.searchsorted(offsets, end, "left")])
            stop = end
            while stop < row_end:
                near = space[data[stop:min(stop + 4096, row_end)]]
                if near.any():
                    stop += int(near.argmax())
                    break
                stop = min(stop + 4096, row_end)
            end = stop
        yield at, end
        at = end


def word_hashes(column: pa.Array, lower: bool = True, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of a column in order, and the number of words up to each row (from 0).

    Words are what the six ASCII spaces separate, or the bytes that ``between`` marks (256 flags, ASCII only);
    ``lower`` reads A-Z as a-z.
    """
    data, offsets = text_bytes(column)
    found, starts_at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in _cuts(data, offsets, between):
        raw = data[a:b]
        space = between[raw]
        new_row = np.zeros(len(raw), bool)
        inner = offsets[np.searchsorted(offsets, a):np.searchsorted(offsets, b)] - a
        new_row[inner] = True
        word = ~space
        start = word.copy()
        start[1:] &= space[:-1] | new_row[1:]
        starts = np.flatnonzero(start)
        if not len(starts):
            continue
        # a word ends before the next space, row or slice end: at the next boundary after its start
        stop = np.flatnonzero(space | new_row)
        k = np.searchsorted(stop, starts, "right")
        ends = np.where(k < len(stop), stop[np.minimum(k, len(stop) - 1)] if len(stop) else len(raw), len(raw))
        up, down = powers(len(raw))
        value = (_LOWER[raw] if lower else raw).astype(np.uint64)
        value += np.uint64(1)
        value *= up[:len(raw)]
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(value, out=total[1:])
        h = (total[ends] - total[starts]) * down[starts]
        found.append(mix(h ^ (ends - starts).astype(np.uint64)))
        starts_at.append(starts + a)
    words, at = np.concatenate(found), np.concatenate(starts_at)
    return words, np.searchsorted(at, offsets, "left")


def rows_of(counts_up_to: np.ndarray) -> np.ndarray:
    """Row number of each word."""
    return np.repeat(np.arange(len(counts_up_to) - 1), np.diff(counts_up_to))


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
