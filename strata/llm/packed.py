"""Number columns packed into one compressed binary value, for exchanges of very many short records."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard

BYTES = 16 << 20  # text bytes a task handles at once


def pack(**columns: np.ndarray) -> bytes:
    """Arrays by name. Bytes of equal weight lie together, which compresses sorted and small numbers well."""
    head, body = [], []
    for name, x in columns.items():
        x = np.ascontiguousarray(x)
        head.append((name, x.dtype.str, len(x)))
        body.append(x.view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes() if len(x) else b"")
    front = json.dumps(head).encode()
    return len(front).to_bytes(4, "little") + front + zstandard.ZstdCompressor(level=1).compress(b"".join(body))


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    n = int.from_bytes(blob[:4], "little")
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[4 + n:]) if len(blob) > 4 + n else b"", np.uint8)
    out, at = {}, 0
    for name, kind, size in json.loads(blob[4:4 + n]):
        kind = np.dtype(kind)
        end = at + size * kind.itemsize
        out[name] = np.ascontiguousarray(raw[at:end].reshape(kind.itemsize, size).T).reshape(-1).view(kind)
        at = end
    return out


def smallest(x: np.ndarray) -> np.ndarray:
    """The same whole numbers (not below 0) in the narrowest type."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def runs(sorted_keys: np.ndarray):
    """(key, start, end) of each run of equal keys, however many keys there could be."""
    keys, starts = np.unique(sorted_keys, return_index=True)
    ends = np.r_[starts[1:], len(sorted_keys)]
    yield from zip(keys.tolist(), starts.tolist(), ends.tolist())


def slices(batch: pa.RecordBatch, column: str, size: int = BYTES):
    """Runs of a batch's rows with about ``size`` bytes of text each, one row at least."""
    at = batch.schema.get_field_index(column)
    lengths = np.array([0 if n is None else n for n in pa.compute.binary_length(batch.column(at)).to_pylist()], np.int64)
    total, start = np.cumsum(lengths), 0
    while start < batch.num_rows:
        done = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, done + size, "right")))
        yield batch.slice(start, end - start)
        start = end
