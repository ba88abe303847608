"""A filter of fixed size over 64-bit hashes, built by tasks and joined on the driver: 4 MB at any input size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import U64, mix

BITS = 25


def _slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    m = mix(h)
    return (m >> U64(64 - BITS)).astype(np.int64), (m & U64((1 << BITS) - 1)).astype(np.int64)


def _set(bits: np.ndarray, h: np.ndarray) -> None:
    for s in _slots(h):
        np.bitwise_or.at(bits, s >> 3, (1 << (s & 7)).astype(np.uint8))


def might_hold(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """False only where the hash was not put in."""
    a, b = _slots(h)
    return ((bits[a >> 3] >> (a & 7)) & (bits[b >> 3] >> (b & 7)) & 1).astype(bool)


def build(df: DataFrame, column: str) -> bytes:
    """The filter of a column of longs. Correct at any number of values; it only lets more pass as they near 2**BITS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << (BITS - 3), np.uint8)
        for b in batches:
            _set(bits, b.column(0).to_numpy(zero_copy_only=False).view(U64))
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

    out = np.zeros(1 << (BITS - 3), np.uint8)
    for row in df.select(column).where(f"{column} IS NOT NULL").coalesce(4).mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(row.bits, np.uint8)
    return out.tobytes()
