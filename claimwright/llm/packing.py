"""Packing of tokenised documents into sequences of bounded length.

Documents are cut into pieces (`pieces`), and only the histogram of piece lengths decides the plan (`plan`): patterns
of up to four length classes that fill a sequence are enumerated, their repeat counts fitted to the histogram by
non-negative least squares and rounded down, the classes realised by exact lengths with the last one chosen by best
fit, and what is left goes by best fit, longest first, into the room that remains or into new sequences. The histogram
has one number for each length, so the plan's work and size do not grow with the corpus. Pieces are then numbered
within their length, in buckets, and a piece's number gives its sequence and offset (`pack`).

Defined cases: a null or empty text is the end token alone; a null id stays null; each row of the input is packed, also
repeated ones; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from claimwright.llm.common import chunks, stored

SEQUENCE = 2048
CLASSES = 64
PARTS = 4
#: Room that a pattern may leave.
SLACK = 2
END = 0
ROWS_PER_BUCKET = 50_000
#: Up to here the two tokenizer libraries agree on which characters are letters, digits and spaces.
PLAIN = "ɏ"
#: White space in a row from which on the faster library, which keeps a step for each character, is not asked.
LONG_RUN = 10_000


# --- tokens -----------------------------------------------------------------------------------------------------

class Tokens:
    """Token ids of a byte-level BPE, as little-endian 32-bit numbers. The vocabulary is read from the tokenizer's
    file; texts of plain characters go through the faster of two libraries that agree on them, unless they hold
    LONG_RUN of white space or an added token. With `added`, ids are those of the tokenizer as loaded, which knows
    added tokens inside a text; without, the text of an added token is text like any other."""

    def __init__(self, path: str, *, added: bool = False):
        import json
        import re

        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        spec = json.load(open(path, encoding="utf-8"))
        shown = {c: b for b, c in enumerate_bytes(pre_tokenizers.ByteLevel.alphabet())}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(shown[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = not added
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.long_run = re.compile(rf"(?<!\s)\s{{{LONG_RUN}}}")

    def of(self, text: str) -> bytes:
        plain = (max(text, default="") <= PLAIN and not any(t in text for t in self.added)
                 and not (len(text) >= LONG_RUN and self.long_run.search(text)))
        ids = self.fast.encode_ordinary(text) if plain else self.full.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


def enumerate_bytes(alphabet: list[str]) -> list[tuple[int, str]]:
    """The byte that each shown character of a byte-level vocabulary stands for: printable ones stand for
    themselves, the others for the characters from U+0100 on, in order."""
    own = [b for b in range(256) if chr(b) in alphabet]
    rest = [b for b in range(256) if b not in own]
    return [(b, chr(b)) for b in own] + [(b, chr(256 + k)) for k, b in enumerate(rest)]


def pieces(docs: DataFrame, tokenizer: str, *, sequence: int = SEQUENCE, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian 32-bit numbers)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = Tokens(tokenizer, added=True), np.array([END], "<u4").tobytes()
        for batch in batches:
            for part in chunks(batch):
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    data = tokens.of(text or "") + end
                    total = len(data) // 4
                    bounds = [0, *range(total % sequence or sequence, total, sequence), total]
                    if total <= sequence:
                        bounds = [0, total]
                    for k, (a, b) in enumerate(itertools.pairwise(bounds)):
                        own = data[4 * a:4 * b]
                        rows.append((doc_id, k, a, b - a, zlib.crc32(own), own if ids else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                        (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return out if ids else out.drop("ids")


# --- plan -------------------------------------------------------------------------------------------------------

def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The x of no negative number that makes |a x - b| least, by an active set."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    scale = max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(3 * n):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= 1e-9 * scale:
            break
        active[best] = True
        while True:
            trial = np.zeros(n)
            trial[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            low = active & (trial <= 0)
            if not low.any():
                x = trial
                break
            step = np.min(x[low] / np.maximum(x[low] - trial[low], 1e-300))
            x = x + step * (trial - x)
            active &= x > 1e-12
            x[~active] = 0
    return x


def class_patterns(classes: int, parts: int) -> list[tuple[int, ...]]:
    """Falling lists of up to `parts` classes with the sum `classes`."""
    def grow(left: int, most: int, room: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif room:
            for c in range(min(left, most), 0, -1):
                if c * room < left:
                    break
                for rest in grow(left - c, c, room - 1):
                    yield (c, *rest)
    return list(grow(classes, classes, parts))


class Lengths:
    """How many pieces of each length are left."""

    def __init__(self, histogram: dict[int, int]):
        self.left = {k: v for k, v in histogram.items() if v > 0}
        self.order = sorted(self.left)

    def longest(self, most: int, least: int = 1) -> int | None:
        at = bisect_left(self.order, most + 1) - 1
        return self.order[at] if at >= 0 and self.order[at] >= least else None

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            self.order.pop(bisect_left(self.order, length))


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of sequences that hold every piece of the histogram."""
    lengths = Lengths(histogram)
    width = -(-sequence // CLASSES)
    classes = -(-sequence // width)
    counts = np.zeros(classes)
    for length, n in lengths.left.items():
        counts[-(-length // width) - 1] += n
    patterns = class_patterns(classes, PARTS)
    matrix = np.zeros((classes, len(patterns)))
    for column, pattern in enumerate(patterns):
        for c in pattern:
            matrix[c - 1, column] += 1
    repeats = np.floor(nonnegative_least_squares(matrix, counts) + 1e-9).astype(int)

    groups: list[tuple[tuple[int, ...], int]] = []
    for column in np.flatnonzero(repeats):
        groups += realised(patterns[column], int(repeats[column]), lengths, width, sequence)
    return best_fit(groups, lengths, sequence)


def realised(pattern: tuple[int, ...], repeats: int, lengths: Lengths, width: int,
             sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences of exact lengths in the classes of a pattern, as far as pieces are left."""
    out = []
    while repeats:
        chosen: list[int] = []
        for k, c in enumerate(pattern):
            room = sequence - sum(chosen)
            most = room if k == len(pattern) - 1 else min(room, c * width)
            spent = {x: chosen.count(x) for x in chosen}
            length = lengths.longest(most, (c - 1) * width + 1)
            while length is not None and lengths.left[length] <= spent.get(length, 0):
                length = lengths.longest(length - 1, (c - 1) * width + 1)
            if length is None:
                return out
            chosen.append(length)
        if sequence - sum(chosen) > SLACK:  # best fit does better
            return out
        n = min([repeats, *(lengths.left[x] // chosen.count(x) for x in chosen)])
        for x in chosen:
            lengths.take(x, n)
        out.append((tuple(chosen), n))
        repeats -= n
    return out


def best_fit(groups: list[tuple[tuple[int, ...], int]], lengths: Lengths,
             sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """The rest, longest first, each into the sequence with the least room that takes it; equal ones at once."""
    rooms: list[int] = []
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(group: tuple[int, ...], n: int) -> None:
        room = sequence - sum(group)
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append((group, n))

    for group, n in groups:
        put(group, n)
    while lengths.order:
        length = lengths.order[-1]
        n = lengths.left[length]
        at = bisect_left(rooms, length)
        if at == len(rooms):
            each = sequence // length
            whole, rest = divmod(n, each)
            if whole:
                put((length,) * each, whole)
            if rest:
                put((length,) * rest, 1)
            lengths.take(length, n)
            continue
        room = rooms[at]
        group, there = by_room[room].pop()
        if not by_room[room]:
            del by_room[room]
            rooms.pop(at)
        n = min(n, there)
        if there > n:
            put(group, there - n)
        put((*group, length), n)
        lengths.take(length, n)
    return [x for room in rooms for x in by_room[room]]


def places(groups: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """For each length and range of numbers within it: key (length, first number), first sequence and offset."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for group, n in groups:
        offset = 0
        for length in group:
            first = used.get(length, 0)
            rows.append((length, first, base, offset))
            used[length] = first + n
            offset += length
        base += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return (table[:, 0] << 44) + table[:, 1], table[:, 1], table[:, 2], table[:, 3]


def pack(cut: DataFrame, *, sequence: int = SEQUENCE) -> DataFrame:
    """sequence_id and offset for every piece; `cut` has length and the columns that tell pieces apart."""
    cut = stored(cut, "pieces")
    counted = cut.groupBy("length").count().collect()  # one row for each length
    buckets = sum(r["count"] for r in counted) // ROWS_PER_BUCKET + 1
    spark = cut.sparkSession
    slots = spark.sparkContext.broadcast(places(plan({r["length"]: r["count"] for r in counted}, sequence)))

    bucketed = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    so_far = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = (bucketed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .select("length", "bucket", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before")))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (bucketed.withColumn("own", F.row_number().over(within) - 1).join(begins, ["length", "bucket"])
                .withColumn("number", F.col("own") + F.col("before")).drop("own", "before", "bucket"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, firsts, bases, offsets = slots.value
        for batch in batches:
            number = np.asarray(batch.column("number"))
            at = np.searchsorted(keys, (np.asarray(batch.column("length")) << 44) + number, side="right") - 1
            rest = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(bases[at] + number - firsts[at]),
                                              pa.array(offsets[at])], names=[*names, "sequence_id", "offset"])

    names = cut.columns
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return numbered.select(*names, "number").mapInArrow(place, f"{kinds}, sequence_id long, offset long")
