"""Helpers of this package: stored tables, the id rule, text buffers and hashes of words and bytes.

Ids are whole numbers. A null id stands for itself in results and counts as larger than any other id where
documents are compared. Rows with one id and equal texts are one document that is returned once per row; rows with
one id and different texts are documents of their own that happen to share the id.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimwright.session import shared_dir

#: Stands for a null id in comparisons.
NO_ID = 2**63 - 1
#: Text handled at once inside a task.
CHUNK_BYTES = 1_000_000
#: White space of a word, as bytes.
SPACES = b" \t\n\x0b\x0c\r"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the folder that all executors share and read again: what follows does not go back
    beyond it when an executor is lost."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_batches(spark: SparkSession) -> None:
    """Texts travel to workers a thousand or four megabytes at a time: ten thousand long ones are held several times
    over, in the executor's direct memory and in the worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_id(column: str = "doc_id") -> Column:
    """The id that comparisons use."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def with_copy(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Columns doc_id, id, copy and text of every row, and of one row of each document.

    `copy` tells apart texts that share an id and is 0 where none do, so that the usual case carries no second key
    through its shuffles."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), order_id().alias("id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shared = docs.groupBy("id").count().where("count > 1").limit(1).count()
    docs = docs.withColumn("copy", F.xxhash64("text") if shared else F.lit(0).cast("long"))
    return docs, docs.dropDuplicates(["id", "copy"]) if shared else docs


def release() -> None:
    """Gives memory that is free again back to the system: workers stay for other tasks, which need their own."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
    if trim:
        trim(0)


def chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `size` bytes of text; one text is never cut. What the last batch left is released."""
    release()
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    totals = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        before = totals[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(totals, before + size, side="right")))
        yield batch.slice(start, end - start)
        start = end


def buffer_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another and where each begins, with the end of the last; null is empty."""
    array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) else "").cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    if not len(array) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; `is_space` tells for each byte value whether it parts words."""
    space = is_space[data]
    before = np.empty(len(data), bool)
    before[1:] = space[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    before[first] = True
    starts = np.flatnonzero(before & ~space)
    after = np.empty(len(data), bool)
    after[:-1] = space[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = True
    return starts, np.flatnonzero(after & ~space) + 1


def byte_set(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Each 64-bit value scrambled (a one-to-one map)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd base and of its inverse modulo 2^64, and values for the 256 bytes."""
    base = int(mixed(np.array([1000 + lane], np.uint64))[0]) | 5
    both = []
    for b in (base, pow(base, -1, 2**64)):
        run = np.full(n + 1, b, np.uint64)
        run[0] = 1
        both.append(np.multiply.accumulate(run))
    return both[0], both[1], mixed(np.arange(256, dtype=np.uint64), 77 + lane)


class Rolling:
    """Hashes of byte ranges of a buffer: polynomials modulo 2^64 over scrambled byte values, scrambled again."""

    def __init__(self, lane: int = 0):
        self.lane, self.n = lane, -1

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(data) > self.n:
            self.n = max(len(data), CHUNK_BYTES)
            self.up, self.down, self.values = powers(self.n, self.lane)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:len(data)], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (sums[ends] - sums[starts]) * self.down[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), self.lane)


def sequences(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A hash of each `length` consecutive values."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    step = np.uint64((0xC2B2AE3D27D4EB4F + 2 * seed) | 1)
    for k in range(length):
        out = out * step + hashes[k:k + n]
    return mixed(out, seed + 13)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
