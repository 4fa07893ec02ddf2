"""A Bloom filter of bounded size, built in parallel by shards of its bits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx

MIN_BITS, MAX_BITS = 1 << 16, 1 << 29
SHARD = 1 << 16
BITS_PER_KEY = 24
PROBES = 3


def bits_for(n: int) -> int:
    """A power of two for ``n`` keys, at most ``MAX_BITS`` (64 MiB); a fuller filter only passes more."""
    bits = MIN_BITS
    while bits < min(n * BITS_PER_KEY, MAX_BITS):
        bits *= 2
    return bits


def positions(h: np.ndarray, bits: int) -> np.ndarray:
    base = ((h >> tx.U(48)) % tx.U(bits // SHARD)) * tx.U(SHARD)
    return np.stack([base + ((h >> tx.U(16 * j)) & tx.U(SHARD - 1)) for j in range(PROBES)])


def contains(packed: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    hit = np.ones(len(h), bool)
    for p in positions(h, bits):
        hit &= (packed[p >> tx.U(3)] >> (p & tx.U(7)).astype(np.uint8)) & 1 == 1
    return hit


def _emit(batches, bits: int):
    for batch in batches:
        p = np.unique(positions(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits))
        shards = np.unique(p // tx.U(SHARD))
        cuts = np.searchsorted(p, np.append(shards, shards[-1:] + tx.U(1)) * tx.U(SHARD))
        low = (p % tx.U(SHARD)).astype(np.uint16)
        yield pa.RecordBatch.from_arrays([pa.array(shards.astype(np.int32)), pa.array([low[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], names=["shard", "at"])


def _merge(batches):
    current, bit = None, None
    out = lambda: pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([np.packbits(bit, bitorder="little").tobytes()], pa.binary())], names=["shard", "bits"])
    for batch in batches:
        for shard, at in zip(*(c.to_pylist() for c in batch.columns)):
            if shard != current:
                if current is not None:
                    yield out()
                current, bit = shard, np.zeros(SHARD, bool)
            bit[np.frombuffer(at, np.uint16)] = True
    if current is not None:
        yield out()


def build(keys: DataFrame, bits: int) -> np.ndarray:
    """Packed filter of a one-column DataFrame of 64-bit hashes."""
    parts = keys.mapInArrow(lambda it: _emit(it, bits), "shard int, at binary")
    merged = parts.repartition("shard").sortWithinPartitions("shard").mapInArrow(_merge, "shard int, bits binary")
    packed = np.zeros(bits // 8, np.uint8)
    for r in merged.toLocalIterator():  # at most bits / SHARD rows of SHARD / 8 bytes
        packed[r.shard * SHARD // 8: (r.shard + 1) * SHARD // 8] = np.frombuffer(r.bits, np.uint8)
    return packed
