"""Removal of word windows that an earlier document already has, behind a count-min prefilter.

0. A text that is a whole copy of an earlier document's is settled by its hash: it stands for no window of its own.
1. Every chunk of text sketches its windows; merged, the sketches tell which windows may be repeated.
2. Only those windows are grouped exactly, by 96 bits of hash, to the smallest id that has them.
3. Windows that an earlier document has go back to their documents, which drop the words they cover.

The grouping combines on the map side, and the way back is a join that adaptive execution splits where one window has
very many rows. Documents without a window that comes back never leave their task.

Defined cases: a null or empty text has no words; shorter texts than a window keep all words; rows of one document
(one id and text) come back once each and do not count as earlier; a null id is later than any other; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import (SPACES, Rolling, as_long, buffer_of, byte_set, chunks, sequences, stored,
                                    with_copy, word_spans)
from claimwright.llm.rewrite import rewritten
from claimwright.llm.sketch import MAX_BITS, flagged, key_column, merged_flags

WINDOW = 13
#: Stands for all windows of a document.
WHOLE = -1


class Windows:
    """Windows of consecutive words of the texts of a batch."""

    def __init__(self, length: int):
        self.length, self.spaces = length, byte_set(SPACES)
        self.lanes = [Rolling(0), Rolling(1)]

    def of(self, texts: pa.Array, lanes: int = 1) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Hashes in each lane, row of the window's text, and number of its first word in the text."""
        data, offsets = buffer_of(texts)
        starts, ends = word_spans(data, offsets, self.spaces)
        first = np.searchsorted(starts, offsets)  # of each text's words
        row = np.repeat(np.arange(len(texts)), np.diff(first))
        n = max(0, len(starts) - self.length + 1)
        inside = row[:n] == row[self.length - 1:self.length - 1 + n]
        hashes = [sequences(lane.ranges(lane.prefix(data), starts, ends), self.length)[inside]
                  for lane in self.lanes[:lanes]]
        row = row[:n][inside]
        return hashes, row, np.flatnonzero(inside) - first[row]


def kept_words(text: str, places: np.ndarray, window: int) -> tuple[int, list[bytes]]:
    """Number of words, and those that no window beginning at `places` covers."""
    words = text.encode().split()
    if not len(places):
        return len(words), words
    if places[0] == WHOLE:
        return len(words), [] if len(words) >= window else words
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, places, 1)
    np.add.at(step, places + window, -1)
    return len(words), [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)]


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, max_bits: int = MAX_BITS,
                   texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if `texts`, the kept words of every row of (doc_id, text)."""
    docs, _ = with_copy(docs)
    context = docs.sparkSession.sparkContext
    # Whole copies, as (id, copy). Flags tell documents that surely are none; the few others are told apart by a join.
    same = docs.select("id", "copy", F.md5("text").alias("hash"))
    first = same.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    copies = stored(same.join(first, "hash").where("first < id").select("id", "copy").distinct(), "copies")
    n_copies = copies.count()
    copied = context.broadcast(merged_flags(copies.select("id"), key_column("id"), n_copies, flag="once"))

    def maybe_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(flagged(np.asarray(batch.column("id")).view(np.uint64), *copied.value)))

    bare = docs.select("id", "copy", "text")
    rescued = stored(bare.mapInArrow(maybe_copies, "id long, copy long, text string")
                     .join(copies, ["id", "copy"], "left_anti"), "rescued")
    size, n_docs = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()

    originals = bare.withColumn("sure", F.lit(False)).unionByName(rescued.withColumn("sure", F.lit(True)))

    def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The originals: rescued ones, and those that the flags do not name."""
        hit = flagged(np.asarray(batch.column("id")).view(np.uint64), *copied.value)
        yield from chunks(batch.filter(pa.array(np.asarray(batch.column("sure")) | ~hit)))

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        windows = Windows(window)
        for part in parts_of(batch):
            yield windows.of(part.column("text"))[0][0]

    twice = context.broadcast(merged_flags(originals, keys, (size or 0) // 6 + 1, max_bits))

    def candidates(names: list[str]) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = Windows(window)
            for batch in batches:
                for part in parts_of(batch):
                    (a, b), row, place = windows.of(part.column("text"), 2)
                    keep = flagged(a, *twice.value)
                    ids, copies = (np.asarray(part.column(c)) for c in ("id", "copy"))
                    row = row[keep]
                    columns = {"a": as_long(a[keep]), "b": as_long(b[keep]).astype(np.int32), "id": ids[row],
                               "copy": copies[row], "place": place[keep].astype(np.int32)}
                    yield pa.RecordBatch.from_arrays([pa.array(columns[c]) for c in names], names=names)
        kinds = {"a": "long", "b": "int", "id": "long", "copy": "long", "place": "int"}
        return originals.mapInArrow(rows, ", ".join(f"{c} {kinds[c]}" for c in names))

    # Exact: the smallest id of each window.
    earliest = candidates(["a", "b", "id"]).groupBy("a", "b").agg(F.min("id").alias("earliest"))
    rows = candidates(["a", "b", "id", "copy", "place"])
    repeats = stored(rows.join(earliest, ["a", "b"]).where("earliest < id")
                     .groupBy("id", "copy").agg(F.array_sort(F.collect_set(F.col("place").cast("long"))).alias("marks"))
                     .unionByName(copies.withColumn("marks", F.array(F.lit(WHOLE).cast("long")))), "repeats")
    for flags in (copied, twice):  # what follows reads stored tables only
        flags.destroy()

    def result(text: str, places: np.ndarray) -> tuple:
        n, words = kept_words(text, places, window)
        kept = b" ".join(words)
        return n, n - len(words), hashlib.sha256(kept).hexdigest(), *([kept.decode()] if texts else [])

    columns = {"n_words": "long", "n_removed": "long", "kept_sha256": "string"} | ({"kept": "string"} if texts else {})
    return rewritten(docs, repeats, n_docs, result, columns)
