"""A count-min sketch over all rows, built from one sketch per chunk of text, merged by block of counters.

Counters saturate at two, so an estimate says "once at most" or "perhaps more often". Estimates are never too low: a
key that occurs twice is always said to be repeated. The width follows the number of keys up to `max_bits`, which
bounds what is broadcast to max_bits / 8 bytes. With more keys than that the sketch lets more keys pass, and the exact
pass behind it has more to do; no key is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import mixed, release

DEPTH = 2
BLOCK_BITS = 18
#: Counters of all rows together: 2^29 make 64 MB of flags.
MAX_BITS = 2**29
CELLS_PER_KEY = 4
#: Keys that a task holds before it sends their sketch on. Fewer would make the gaps between counters, and so what is
#: shuffled, larger.
HELD_KEYS = 2_000_000
#: Sketches of so many partitions are merged in one go; of more, first in groups of this size.
MERGED_AT_ONCE = 256


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The counter of each key in one row of the sketch."""
    return (mixed(keys, 101 + row) >> np.uint64(64 - bits)).astype(np.int64)


def key_column(column: str) -> Callable[[pa.RecordBatch], Iterator[np.ndarray]]:
    """Keys that are a column of whole numbers."""
    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield np.asarray(batch.column(column)).view(np.uint64)
    return keys


def packed(sorted_cells: np.ndarray) -> bytes:
    """Gaps between sorted numbers, a byte each; 255 adds to the next gap without ending it."""
    gaps = np.diff(sorted_cells, prepend=0)
    full, rest = gaps // 255, gaps % 255
    ends = np.cumsum(full + 1)
    out = np.full(int(ends[-1]), 255, np.uint8)
    out[ends - 1] = rest
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def partial(keys: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    """The sketch of some keys: (block of counters, packed counters it hits)."""
    for row in range(DEPTH):
        hit = cells(keys, row, bits)
        hit.sort()
        block = (hit >> BLOCK_BITS).astype(np.int32)
        cuts = np.flatnonzero(np.diff(block, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(hit)]):
            first = int(block[a])
            yield (row << (bits - BLOCK_BITS)) + first, packed(hit[a:b] - (first << BLOCK_BITS))


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order, in any number of parts; yields each block's flags (hit, hit twice). One block is held."""
    now, once, twice = None, None, None

    def result():
        return pa.RecordBatch.from_arrays([
            pa.array([now], pa.int32()), pa.array([np.packbits(once).tobytes()], pa.binary()),
            pa.array([np.packbits(twice).tobytes()], pa.binary())], names=["block", "once", "twice"])

    for batch in batches:
        for block, hits, first, second in zip(*(batch.column(c).to_pylist()
                                                for c in ("block", "hits", "once", "twice"))):
            if block != now:
                if now is not None:
                    yield result()
                now, once, twice = block, np.zeros(1 << BLOCK_BITS, bool), np.zeros(1 << BLOCK_BITS, bool)
            if hits is not None:
                at = unpacked(hits)
                twice[at[1:][at[1:] == at[:-1]]] = True
                twice[at[once[at]]] = True
                once[at] = True
            if first is not None:
                a, b = (np.unpackbits(np.frombuffer(x, np.uint8)).view(bool) for x in (first, second))
                twice |= b | (once & a)
                once |= a
    if now is not None:
        yield result()


def flagged(keys: np.ndarray, bits: int, flags: np.ndarray) -> np.ndarray:
    """For each key whether all of its counters have the flag: it may occur twice (or at all)."""
    out = np.ones(len(keys), bool)
    for row in range(DEPTH):
        at = cells(keys[out], row, bits) + (row << bits)
        out[out] = (flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
    return out


def merged_flags(frame: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], expected: int,
                 max_bits: int = MAX_BITS, flag: str = "twice") -> tuple[int, np.ndarray]:
    """The merged sketch of all keys that `keys_of` draws from the batches of a frame: the bits of a row's width and
    the flags of counters hit twice (or `once`), small enough to broadcast.

    `expected`: about how many keys there are; it sets the width only."""
    bits = BLOCK_BITS
    while (DEPTH << bits) < min(CELLS_PER_KEY * expected, max_bits):
        bits += 1

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def rows():
            keys = np.concatenate(held)
            held.clear()
            pairs = list(partial(keys, bits))
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int32()),
                                               pa.array([p[1] for p in pairs], pa.binary())], names=["block", "hits"])

        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                size += len(keys)
                if size > HELD_KEYS:
                    yield rows()
                    size = 0
        if size:
            yield rows()
        release()

    empty = F.lit(None).cast("binary")
    parts = frame.mapInArrow(sketch, "block int, hits binary").select("block", "hits", empty.alias("once"),
                                                                     empty.alias("twice"))
    salts = frame.rdd.getNumPartitions() // MERGED_AT_ONCE
    if salts:  # else one task would merge a block of very many sketches
        salt = F.pmod(F.xxhash64("hits"), F.lit(salts)).cast("int")
        parts = (parts.withColumn("salt", salt).repartition("block", "salt").sortWithinPartitions("block")
                 .drop("salt").mapInArrow(merge, "block int, once binary, twice binary")
                 .select("block", empty.alias("hits"), "once", "twice"))
    merged = (parts.repartition("block").sortWithinPartitions("block")
              .mapInArrow(merge, "block int, once binary, twice binary").select("block", flag))
    size = 1 << BLOCK_BITS >> 3
    flags = np.zeros(DEPTH << bits >> 3, np.uint8)
    for block, hit in merged.collect():
        flags[block * size:(block + 1) * size] = np.frombuffer(hit, np.uint8)
    return bits, flags
