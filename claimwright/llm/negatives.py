"""Hard negatives: inner products of anchors and all rows by Strassen's recursion, kept in mergeable heaps.

Rows are stored as tiles of whole numbers (`vectors`). Anchors are taken in groups of at most ANCHORS rows (the bound of
what is sent to the tasks); for each group every tile is multiplied twice: with the anchors of its rows' labels for the
positives, then with all of them for the negatives. A product is Strassen's: seven products of half the size in every
direction, odd sides padded by zeros, exact additions of 64-bit integers, down to blocks of LEAF. Each task keeps, for
each anchor, a heap of the best positives, and for each positive a heap of the best rows in its window of scores; heaps
of two parts merge into the best of both, which Spark does by anchor, whatever the order.

A score is exact as long as it fits into 64 bits. Best means higher score, then smaller id, a null id last, then the
order in which rows are stored. Rows with a null label or a vector that takes no part (`vectors`) are left out. Rows
that share an id are rows of their own: an anchor's other rows are all rows but itself, and each of two anchors with
one id gets its results. A null id is no anchor. No rows give no rows; further columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from claimwright.llm.common import NO_ID, stored
from claimwright.llm.vectors import matrix, shape, tiles

#: Anchors sent to the tasks at once, by rows and by bytes.
ANCHORS, ANCHOR_BYTES = 8_192, 32_000_000
#: Smaller blocks are multiplied directly.
LEAF = 16


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two matrices of 64-bit integers, exact modulo 2^64."""
    (rows, inner), columns = a.shape, b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b
    a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
    b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
    r, i, c = (s // 2 for s in (a.shape[0], *b.shape))
    a11, a12, a21, a22 = a[:r, :i], a[:r, i:], a[r:, :i], a[r:, i:]
    b11, b12, b21, b22 = b[:i, :c], b[:i, c:], b[i:, :c], b[i:, c:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * c), np.int64)
    out[:r, :c] = m1 + m4 - m5 + m7
    out[:r, c:] = m3 + m5
    out[r:, :c] = m2 + m4
    out[r:, c:] = m1 - m2 + m3 + m6
    return out[:rows, :columns]


class Heaps:
    """For each slot the best `size` entries seen, as (score, id, row), best first."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.score = np.zeros((slots, size), np.int64)
        self.id = np.zeros((slots, size), np.int64)
        self.row = np.zeros((slots, size), np.int64)
        self.filled = np.zeros((slots, size), bool)

    def merge(self, slot: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        held = self.filled[slot]
        score, ids, rows = (np.concatenate([own[slot][held], new]) for own, new in
                            ((self.score, score), (self.id, ids), (self.row, rows)))
        order = np.lexsort((rows, ids, ~score))[:self.size]  # ~ falls as the score rises, without overflow
        k = len(order)
        self.score[slot, :k], self.id[slot, :k], self.row[slot, :k] = score[order], ids[order], rows[order]
        self.filled[slot, :k] = True


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Tiles with the number of their first row; numbers have gaps."""
    tiled = tiles(rows, 256, name)
    at = F.monotonically_increasing_id()  # 33 bits of it count within a task; a tile has less than 2^20 rows
    first = F.shiftleft(F.shiftright(at, 33), 40) + F.shiftleft(at.bitwiseAND(F.lit(2**33 - 1)), 20)
    return stored(tiled.withColumn("first", first), f"{name}-numbered")


def _ids(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.array([NO_ID if i is None else i for i in row["ids"]], np.int64)
    return ids, np.array(row["labels"], np.int64), row["first"] + np.arange(row["n"])


def _anchor_groups(tiled: DataFrame, every: int, width: int) -> Iterator[dict]:
    """Anchors in groups of bounded size, by stored row."""
    size = max(1, min(ANCHORS, ANCHOR_BYTES // (8 * max(width, 1))))
    spot = F.posexplode("ids").alias("place", "id")
    flat = tiled.select("first", "labels", "cells", "width", spot).where(F.pmod("id", F.lit(every)) == 0).select(
        (F.col("first") + F.col("place")).alias("row"), "id", F.get("labels", "place").alias("label"),
        F.substring("cells", F.col("place") * F.col("width") * 8 + 1, F.col("width") * 8).alias("cells"))
    anchors = stored(flat, "anchors")
    total, after = anchors.count(), -1
    for _ in range(-(-total // size)):
        group = anchors.where(F.col("row") > after).orderBy("row").limit(size).collect()
        after = group[-1]["row"]
        cells = np.zeros((len(group), width), np.int64)
        for k, row in enumerate(group):
            own = np.frombuffer(row["cells"], np.int64)
            cells[k, :len(own)] = own
        yield {"row": np.array([r["row"] for r in group]), "id": np.array([r["id"] for r in group]),
               "label": np.array([r["label"] for r in group]), "cells": cells}


def _best(frame: DataFrame, by: list[str], score: str, ident: str, row: str, size: int) -> DataFrame:
    """The first `size` rows of each group; every task sends on no more than that."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), ident, row)
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def hard_negatives(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10,
                   window: tuple[int, int] = (30, 90)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of rows with vec_id, label and
    embedding. Anchors are the rows whose id is divisible by `every`. For each of an anchor's best `positives` of its
    label: the best `negatives` of other labels with window[0] * p <= 100 * score <= window[1] * p."""
    low, high = window
    tiled = _numbered(rows.where("label is not null"), "vectors")
    _, width = shape(tiled)
    results = []
    for group in _anchor_groups(tiled, every, width):
        sent = tiled.sparkSession.sparkContext.broadcast(group)

        def near(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            anchors = sent.value
            heaps = Heaps(len(anchors["row"]), positives)
            for batch in batches:
                for tile in batch.to_pylist():
                    ids, labels, numbers = _ids(tile)
                    cells = matrix(tile, width)
                    for label in np.intersect1d(labels, anchors["label"]):
                        mine, theirs = np.flatnonzero(anchors["label"] == label), np.flatnonzero(labels == label)
                        scores = strassen(anchors["cells"][mine], np.ascontiguousarray(cells[theirs].T))
                        for slot, line in zip(mine, scores):
                            other = numbers[theirs] != anchors["row"][slot]
                            take = np.flatnonzero(other)
                            if len(take) > positives:  # all that tie with the last place go on
                                least = np.partition(line[take], len(take) - positives)[len(take) - positives]
                                take = take[line[take] >= least]
                            heaps.merge(slot, line[take], ids[theirs[take]], numbers[theirs[take]])
            slots, places = np.nonzero(heaps.filled)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a) for a in (anchors["row"][slots], anchors["id"][slots], heaps.score[slots, places],
                                       heaps.id[slots, places], heaps.row[slots, places])],
                names=["anchor", "anchor_id", "positive_score", "positive_id", "positive"])

        found = tiled.mapInArrow(near, "anchor long, anchor_id long, positive_score long, positive_id long, positive long")
        best = stored(_best(found, ["anchor"], "positive_score", "positive_id", "positive", positives), "positives")
        # at most `positives` of each anchor of the group: bounded as the anchors are
        windows: dict[int, set[int]] = {}
        for row in best.select("anchor", "positive_score").distinct().collect():
            windows.setdefault(row["anchor"], set()).add(row["positive_score"])
        asked = [sorted(windows.get(int(a), ())) for a in group["row"]]
        sought = tiled.sparkSession.sparkContext.broadcast(asked)

        def far(batches: Iterator[pa.RecordBatch], sent=sent, sought=sought) -> Iterator[pa.RecordBatch]:
            anchors, asked = sent.value, sought.value
            begins = np.cumsum([0, *map(len, asked)])
            heaps = Heaps(int(begins[-1]), negatives)
            for batch in batches:
                for tile in batch.to_pylist():
                    ids, labels, numbers = _ids(tile)
                    order = np.lexsort((numbers, ids))  # ties of score then keep this order
                    ids, labels, numbers = ids[order], labels[order], numbers[order]
                    scores = strassen(anchors["cells"], np.ascontiguousarray(matrix(tile, width)[order].T))
                    for k, line in enumerate(scores):
                        other = np.flatnonzero(labels != anchors["label"][k])
                        ranked = other[np.argsort(~line[other], kind="stable")]
                        falling = ~line[ranked]
                        for slot, p in zip(range(begins[k], begins[k + 1]), asked[k]):
                            most, least = high * p // 100, -(-low * p // 100)
                            start = np.searchsorted(falling, ~most)
                            take = ranked[start:start + negatives]
                            take = take[line[take] >= least]
                            if len(take):
                                heaps.merge(slot, line[take], ids[take], numbers[take])
            slots, places = np.nonzero(heaps.filled)
            owner = np.searchsorted(begins, slots, side="right") - 1
            scores = np.array([p for list_of in asked for p in list_of], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a) for a in (anchors["row"][owner], scores[slots], heaps.score[slots, places],
                                       heaps.id[slots, places], heaps.row[slots, places])],
                names=["anchor", "positive_score", "negative_score", "negative_id", "negative"])

        found = tiled.mapInArrow(far, "anchor long, positive_score long, negative_score long, negative_id long, negative long")
        windowed = _best(found, ["anchor", "positive_score"], "negative_score", "negative_id", "negative", negatives)
        results.append(stored(best.drop("rank").join(windowed, ["anchor", "positive_score"]).select(
            "anchor_id", _id("positive_id"), "rank", _id("negative_id"), "positive_score", "negative_score"), "negatives"))
        sent.destroy()
        sought.destroy()
    if not results:
        return tiled.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                      "positive_score long, negative_score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _id(name: str):
    return F.when(F.col(name) != NO_ID, F.col(name)).alias(name)
