"""Embedding rows as stored tiles of whole numbers, and sums over them.

A vector takes part unless it is null or holds a null or non-finite entry. Each entry c, as a double, becomes
floor(scale * c), held within +-2^40. Vectors shorter than the longest count as continued by zeros. A tile holds rows
as they come, up to about TILE_BYTES, so a task's memory does not grow with its rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from claimwright.llm.common import stored

TILE_BYTES = 1_000_000
LARGEST = float(2**40)

TILE = "n long, width long, ids array<long>, labels array<long>, cells binary"


def taking_part(vector: str) -> Column:
    """Whether a vector is set and all its entries are finite."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce(F.forall(F.col(vector), finite), F.lit(False))


def matrix(row: dict, width: int) -> np.ndarray:
    """The rows of a tile, each continued by zeros to `width`."""
    cells = np.frombuffer(row["cells"], np.int64).reshape(row["n"], row["width"])
    return np.pad(cells, ((0, 0), (0, width - row["width"])))


def _whole(vectors: pa.Array, scale: int) -> np.ndarray:
    lengths = np.diff(np.asarray(vectors.offsets))
    flat = np.asarray(vectors.flatten().cast(pa.float64()))
    whole = np.clip(np.floor(flat * scale), -LARGEST, LARGEST).astype(np.int64)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = whole
    return out


def tiles(rows: DataFrame, scale: int, name: str, vector: str = "embedding") -> DataFrame:
    """Tiles, stored, of rows with columns vec_id, label (both long) and a vector."""
    size = TILE_BYTES  # as a value of the function, so that workers get it with the code

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_bytes = [], 0

        def tile() -> pa.RecordBatch:
            width = max(m.shape[1] for _, _, m in held)
            cells = np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for _, _, m in held])
            ids, labels = ([v for part in held for v in part[k].to_pylist()] for k in (0, 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([len(cells)], pa.int64()), pa.array([width], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([labels], pa.list_(pa.int64())), pa.array([cells.tobytes()], pa.binary())],
                names=["n", "width", "ids", "labels", "cells"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                # as many rows as fit beside those held, by the longest vector of the batch
                lengths = np.diff(np.asarray(batch.column(2).offsets))
                row_bytes = 8 * max(int(lengths.max(initial=1)), 1)
                end = min(batch.num_rows, at + max(1, (size - held_bytes) // row_bytes))
                piece = batch.slice(at, end - at)
                held.append((piece.column(0), piece.column(1), _whole(piece.column(2), scale)))
                held_bytes += row_bytes * (end - at)
                at = end
                if held_bytes >= size:
                    yield tile()
                    held, held_bytes = [], 0
        if held:
            yield tile()

    valid = rows.where(taking_part(vector)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"))
    return stored(valid.mapInArrow(build, TILE), name)


def shape(tiled: DataFrame) -> tuple[int, int]:
    """Number of rows and of dimensions."""
    n, width = tiled.agg(F.sum("n"), F.max("width")).first()
    return n or 0, width or 0
