"""Bloom filters of a fixed size over 64-bit hashes, made in tasks and put together on the driver."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITS = 1 << 26
PROBES = 3


def mixed(values: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of 64-bit values."""
    x = values.astype(np.int64).view(np.uint64).copy()
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x ^= x >> np.uint64(33)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def run_hashes(values: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of each run of ``size`` of the values, from each place on; none if there are fewer."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, seed + 1, dtype=np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + values[k : k + n]
    return mixed(total.view(np.int64))


class Bloom:
    """May take a hash for one that was added, never the reverse; its size doesn't depend on how many there are."""

    def __init__(self, packed: bytes | None = None):
        self.bits = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).copy() if packed else np.zeros(BITS // 8, dtype=np.uint8)

    @staticmethod
    def _places(hashes: np.ndarray):
        for k in range(PROBES):
            yield (hashes >> np.uint64(k * 19)) & np.uint64(BITS - 1)

    def add(self, hashes: np.ndarray) -> None:
        for at in self._places(hashes):
            np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may have been added."""
        found = np.ones(len(hashes), dtype=bool)
        for at in self._places(hashes):
            found &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return found

    def packed(self) -> bytes:
        return zlib.compress(self.bits.tobytes(), 1)


def bloom_of(df: DataFrame, column: str, hashes) -> bytes:
    """The packed filter over ``hashes(values)`` of every array of 64-bit values in a column; the driver takes one task's filter at a time."""

    def build(batches):
        made = Bloom()
        for batch in batches:
            lists = batch.column(column)
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for i in range(len(lists)):
                for own in hashes(mixed(values[ends[i] : ends[i + 1]])):
                    made.add(own)
        yield pa.RecordBatch.from_arrays([pa.array([made.packed()], pa.binary())], names=["bits"])

    total = Bloom()
    for row in df.select(column).mapInArrow(build, "bits binary").toLocalIterator():
        total.bits |= Bloom(bytes(row[0])).bits
    return total.packed()
