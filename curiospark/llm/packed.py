"""Entries dealt to buckets as packed columns: a row of a shuffle holds one slice's entries of one bucket."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket by the high bits, which callers don't use otherwise."""
    return ((h >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def pack(h: np.ndarray, buckets: int, columns: Sequence[np.ndarray]) -> pa.RecordBatch:
    """bucket, c0, c1, ...: the bytes of each column's entries, apart by the bucket of h."""
    bucket = bucket_of(h, buckets)
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    bucket = bucket[order]
    cut = np.concatenate((np.flatnonzero(np.diff(bucket, prepend=-1)), [len(bucket)])) if len(bucket) else np.zeros(1, np.int64)
    arrays = [pa.array(bucket[cut[:-1]], pa.int32())]
    for c in columns:
        arrays.append(binary(c[order], cut))
    return pa.RecordBatch.from_arrays(arrays, ["bucket", *(f"c{k}" for k in range(len(columns)))])


def schema(columns: int) -> str:
    return "bucket int" + "".join(f", c{k} binary" for k in range(columns))


def unpack(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """All entries of a packed column."""
    parts = []
    for c in column.chunks:
        if c.null_count:
            c = c.drop_null()
        offsets = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1] if len(c) else np.zeros(1, np.int32)
        parts.append(np.frombuffer((c.buffers()[2] or b""), np.uint8)[offsets[0] : offsets[-1]])
    return np.concatenate(parts).view(kind) if parts else np.empty(0, kind)


def in_order(v: np.ndarray, most: int) -> np.ndarray:
    """A stable order of integers from 0 to ``most``, by 16 bits at a time."""
    order = np.argsort((v & 0xFFFF).astype(np.uint16), kind="stable")
    shift = 16
    while most >> shift:
        order = order[np.argsort(((v[order] >> shift) & 0xFFFF).astype(np.uint16), kind="stable")]
        shift += 16
    return order


def binary(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """The bytes of values[cut[k] : cut[k + 1]], for every k."""
    offsets = (np.asarray(cut) * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def repeated(v: np.ndarray) -> np.ndarray:
    """Of a sorted array, which entries have an equal neighbour."""
    same = v[1:] == v[:-1]
    return np.concatenate((same, [False]))[: len(v)] | np.concatenate(([False], same))[: len(v)]


def lengths(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """How many entries each packed row has."""
    return np.concatenate([np.diff(np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]) for c in column.chunks]) // size
