"""Compact exchange of hashed items: a few large binary rows per bucket instead of a row per item.

An item is a digest plus a place in a batch.  Digests are truncated to the width that keeps the
chance of any false match small at the measured number of items; the bucket a digest falls in
carries further bits of it.  Places ascend within a blob and are stored as gaps.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of text per bucket (2 to 3 million words), and bits left over a birthday match.
BUCKET_BYTES = 16 << 20
SPARE_BITS = 14


def bucket_count(spark: SparkSession, text_bytes: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), text_bytes // BUCKET_BYTES + 1)


def digest_width(items: int, buckets: int) -> int:
    """Bytes of a digest such that any two different items of all meet with chance 2**-SPARE_BITS."""
    bits = 2 * math.log2(max(2, items)) - 1 + SPARE_BITS - math.log2(buckets)
    return min(16, max(5, math.ceil(bits / 8)))


def bucket_of(digest: np.ndarray, buckets: int) -> np.ndarray:
    top = (digest >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    return top.astype(np.uint16 if buckets <= 1 << 16 else np.uint32)


def encode_gaps(place: np.ndarray) -> bytes:
    """Ascending places; a gap is as many bytes of 255 as it holds, then the rest."""
    gap = np.diff(place, prepend=0)
    room = gap // 255 + 1
    out = np.full(int(room.sum()), 255, np.uint8)
    out[np.cumsum(room) - 1] = gap % 255
    return out.tobytes()


def decode_gaps(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    return np.cumsum(raw, dtype=np.int64)[raw != 255]


def pack(arrays: list[np.ndarray | bytes]) -> bytes:
    """Arrays one after another; those given as bytes are stored as they are, others deflated."""
    parts = [a if isinstance(a, bytes) else zlib.compress(np.ascontiguousarray(a).tobytes(), 1) for a in arrays]
    return np.array([len(parts), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def unpack(blob: bytes) -> list[bytes]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    sizes = np.frombuffer(blob, np.int64, n, 8)
    ends = np.cumsum(sizes) + 8 * (n + 1)
    return [blob[e - s : e] for s, e in zip(sizes, ends)]


def inflate(part: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(part), kind)


def digest_planes(low: np.ndarray, high: np.ndarray, width: int) -> bytes:
    """The low bytes of ``low``, then of ``high``, as rows of ``width`` bytes."""
    both = np.empty((len(low), 16), np.uint8)
    both[:, :8] = low.astype("<u8").view(np.uint8).reshape(-1, 8)
    both[:, 8:] = high.astype("<u8").view(np.uint8).reshape(-1, 8)
    return both[:, :width].tobytes()


def read_digests(data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(data, np.uint8).reshape(-1, width)
    both = np.zeros((len(rows), 16), np.uint8)
    both[:, :width] = rows
    wide = both.view("<u8")
    return wide[:, 0].copy(), wide[:, 1].copy()


def by_bucket(bucket: np.ndarray):
    """(bucket, indices ascending) for each bucket that occurs."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    sorted_ = bucket[order]
    cuts = np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1
    for part in np.split(order, cuts):
        yield int(bucket[part[0]]), part


def binary_rows(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """One binary value per run of ``data``; ``cuts`` are the bounds of the runs."""
    offsets = (cuts * data.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())]).cast(pa.binary())
