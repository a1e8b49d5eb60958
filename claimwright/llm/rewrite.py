"""Results of documents from their texts and marks that were found for some of them elsewhere.

Documents surely without marks get their result where they are read; only the others send their text to the join.
"Surely" comes from flags over the marked ids, which never miss one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimwright.llm.common import chunks
from claimwright.llm.sketch import flagged, key_column, merged_flags


def rewritten(docs: DataFrame, marks: DataFrame, n_docs: int, result: Callable[[str, np.ndarray], tuple],
              columns: dict[str, str]) -> DataFrame:
    """doc_id and the columns that `result(text, marks)` returns, for every row of docs (doc_id, id, copy, text).

    `marks`: (id, copy, marks array<long>). `columns`: name and type of each result, `long` or `string`."""
    touched = docs.sparkSession.sparkContext.broadcast(
        merged_flags(marks.select("id"), key_column("id"), n_docs, flag="once"))
    names = list(columns)
    types = [{"long": pa.int64(), "string": pa.string()}[t] for t in columns.values()]
    none = np.zeros(0, np.int64)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                wait = flagged(np.asarray(part.column("id")).view(np.uint64), *touched.value)
                texts = part.column("text").to_pylist()
                done = [(None,) * len(names) if w else result(t, none) for w, t in zip(wait, texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("id"), part.column("copy"),
                     pa.array([t if w else None for w, t in zip(wait, texts)], pa.string()),
                     *(pa.array([d[k] for d in done], t) for k, t in enumerate(types))],
                    names=["doc_id", "id", "copy", "text", *names])

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                done = list(zip(*(part.column(c).to_pylist() for c in names)))
                done = [d if t is None else result(t, m.values.to_numpy() if m.is_valid else none) for d, t, m in
                        zip(done, part.column("text").to_pylist(), part.column("marks"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array([d[k] for d in done], t) for k, t in enumerate(types))],
                    names=["doc_id", *names])

    kinds = ", ".join(f"{n} {t}" for n, t in columns.items())
    waiting = docs.select("doc_id", "id", "copy", "text").mapInArrow(
        near, f"doc_id long, id long, copy long, text string, {kinds}")
    return (waiting.join(marks, ["id", "copy"], "left").select("doc_id", "text", "marks", *names)
            .mapInArrow(far, f"doc_id long, {kinds}"))
