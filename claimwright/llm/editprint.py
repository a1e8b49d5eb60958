"""Document fingerprints by a randomised edit embedding.

A walk reads a text from its first character: at each step it writes the character it stands on and then moves on or
stays, as a random function of the step and the character says, the same function for all texts. Two texts at a small
edit distance soon walk in step again behind an edit, so their written strings differ in few places. A fingerprint
keeps the written string after every d steps, d a power of two so chosen that a text has between SAMPLES and twice as
many samples; a coarser fingerprint's steps are among a finer one's, so texts of different lengths compare as well.

Likeness is the share of equal samples among the steps that either text reaches. Near pairs come from bands of samples
drawn from the fingerprint and are verified by their likeness.

Every text is walked from beginning to end, so an edit is paid for once however long the text is. Walks run side by
side, so that each step is one operation on many texts; where few texts are still walking, each goes on alone. Only the
samples of a walk are kept beyond a block of steps.

Defined cases: null and empty texts have an empty fingerprint, alike (1) to each other and to nothing else; equal texts
have equal fingerprints; rows may repeat or lack an id (a null id is larger than any other) and each comes back once;
extra columns are ignored; an empty table gives an empty result; the only row is its own next one.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import NO_ID, mixed, order_id

SAMPLES = 64
#: Steps of a walk for each character: half of them move on.
PACE = 2
#: Steps between which only samples are kept, and texts below which walks no longer run side by side.
BLOCK, SIDE = 65_536, 32
#: Characters and texts that are walked side by side; together they bound the table of written strings.
WALKED_AT_ONCE, TEXTS_AT_ONCE = 3_000_000, 4000
#: Bytes of text in a bucket of neighbouring ids, as long as there are no more than MAX_BUCKETS.
BUCKET_BYTES, MAX_BUCKETS = 16_000_000, 10_000
BAND, BANDS = 8, 12
LIKE = 0.8

MOVE, ONE = np.uint32(15), np.uint32(1)
DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)


def spacing(n: np.ndarray) -> np.ndarray:
    """Steps between samples of texts of n characters, as a power of two's exponent."""
    return np.maximum(0, np.floor(np.log2(np.maximum(n * PACE, 1) / SAMPLES))).astype(np.int64)


def walk(points: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Samples (values 0 to 15) of each text's written string; texts are code points one after another."""
    n = np.diff(offsets)
    order = np.argsort(-n, kind="stable")
    total, gaps = n[order] * PACE, 1 << spacing(n[order])
    at, last = offsets[:-1][order], offsets[1:][order] - 1
    hashes = mixed(np.arange(256, dtype=np.uint64), 41).astype(np.uint32)
    codes = hashes[points & 255] ^ ((points >> np.uint32(8)) * np.uint32(0x9E3779B1))
    samples: list[list[np.ndarray]] = [[] for _ in order]
    for begin in range(0, int(total.max(initial=0)), BLOCK):
        left = total[:np.searchsorted(-total, -begin, side="left")] - begin
        steps = min(BLOCK, int(left[0]))
        marks = mixed(np.arange(begin, begin + steps, dtype=np.uint64), 42).astype(np.uint32) | np.uint32(1)
        walking = np.searchsorted(-left, -np.arange(1, steps + 1), side="right")
        together = int(np.searchsorted(-walking, -SIDE, side="right"))
        first = np.concatenate([[0], np.cumsum(walking[:together])])
        values = np.empty(first[-1], np.uint32)  # of one step after another
        active = -1
        for step, (a, b) in enumerate(itertools.pairwise(first.tolist())):
            if b - a != active:
                active = b - a
                here, end, moves = at[:active], last[:active], np.empty(active, np.uint32)
            value, mark = values[a:b], marks[step]
            codes.take(here, out=value, mode="clip")  # none is out of range; this mode needs no copy
            np.add(value, mark, out=value)
            np.multiply(value, mark, out=value)
            np.right_shift(value, MOVE, out=moves)
            np.bitwise_and(moves, ONE, out=moves)
            np.add(here, moves, out=here)
            np.minimum(here, end, out=here)
        written = (values >> np.uint32(28)).astype(np.uint8)
        for k, stop in enumerate(np.minimum(left, steps).tolist()):
            place = np.arange(-(begin + 1) % gaps[k], stop, gaps[k])
            samples[k].append(written[first[place[place < together]] + k])
            if stop > together:
                own, moved = walk_alone(codes[at[k]:min(last[k], at[k] + stop - together) + 1].tolist(),
                                        marks[together:stop].tolist())
                at[k] += moved
                samples[k].append(own[place[place >= together] - together])
    out = [np.zeros(0, np.uint8)] * len(n)
    for k, parts in zip(order, samples):
        if parts:
            out[k] = np.concatenate(parts)
    return out


def walk_alone(codes: list[int], marks: list[int]) -> tuple[np.ndarray, int]:
    """What one walk writes in the steps of `marks`, and how far it moves; it stays on the last of its codes."""
    written, at, last = bytearray(), 0, len(codes) - 1
    for mark in marks:
        value = (codes[at] + mark) * mark & 0xFFFFFFFF
        written.append(value >> 28)
        if value & 0x8000 and at < last:
            at += 1
    return np.frombuffer(written, np.uint8), at


def fingerprints(texts: list[str]) -> list[str]:
    """For each text the exponent of its spacing and its samples, as hexadecimal digits."""
    out: list[str] = []
    k = 0
    sizes = np.cumsum([len(t) for t in texts])
    while k < len(texts):
        before = sizes[k - 1] if k else 0
        end = max(k + 1, int(np.searchsorted(sizes, before + WALKED_AT_ONCE, side="right")))
        end = min(end, k + TEXTS_AT_ONCE)
        points = np.frombuffer("".join(texts[k:end]).encode("utf-32-le", "surrogatepass"), np.uint32)
        n = np.array([len(t) for t in texts[k:end]])
        samples = walk(points, np.concatenate([[0], np.cumsum(n)]))
        out += [f"{e:02x}" + DIGITS[s].tobytes().decode() if len(s) else ""
                for e, s in zip(spacing(n), samples)]
        k = end
    return out


def likeness(x: str, y: str) -> float:
    """Share of equal samples at the coarser spacing of two fingerprints."""
    if not x or not y:
        return float(x == y)
    a, b = int(x[:2], 16), int(y[:2], 16)
    e = max(a, b)
    # The j-th sample stands behind (j + 1) d steps.
    u, v = (np.frombuffer(s[1 + (1 << e - k)::1 << e - k].encode(), np.uint8) for s, k in ((x, a), (y, b)))
    n = min(len(u), len(v))
    return float((u[:n] == v[:n]).sum() / max(len(u), len(v)))


# --- operators --------------------------------------------------------------------------------------------------

def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every row of (doc_id, text)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(fingerprints(texts), pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(rows, "doc_id long, n_chars long, fingerprint string")


def near_pairs(prints: DataFrame, *, like: float = LIKE) -> DataFrame:
    """(a, b, likeness): documents (doc_id, fingerprint) with the least id of a band's bucket, as far as verified.

    A band is BAND samples at drawn places of the fingerprint, at the coarsest spacing that its length or half of it
    has; every document of a bucket is compared with the bucket's first only, so groups give a star, not all pairs."""
    rng = np.random.default_rng(5)
    places = np.array([rng.choice(SAMPLES // 2, BAND, replace=False) for _ in range(BANDS)])

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, mark in zip(batch.column("doc_id").to_pylist(), batch.column("fingerprint").to_pylist()):
                if not mark:
                    continue
                e = int(mark[:2], 16)
                for up in (0, 1):
                    samples = mark[1 + (1 << up)::1 << up]
                    for k, chosen in enumerate(places):
                        if chosen.max() < len(samples):
                            out.append((f"{k}:{e + up}:" + "".join(samples[i] for i in chosen), doc_id, mark))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(
                (pa.string(), pa.int64(), pa.string()))], names=["band", "doc_id", "fingerprint"])

    rows = prints.select("doc_id", "fingerprint").mapInArrow(bands, "band string, doc_id long, fingerprint string")
    first = rows.groupBy("band").agg(F.min_by(F.struct("doc_id", "fingerprint"), "doc_id").alias("first"))
    pairs = (rows.join(first, "band").where(F.col("first.doc_id") < F.col("doc_id"))
             .select(F.col("first.doc_id").alias("a"), F.col("doc_id").alias("b"),
                     F.col("first.fingerprint").alias("x"), F.col("fingerprint").alias("y")).dropDuplicates(["a", "b"]))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = [likeness(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            found = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(value, pa.float64())],
                                               names=["a", "b", "likeness"])
            yield found.filter(pa.array([v >= like for v in value], pa.bool_()))

    return pairs.mapInArrow(verify, "a long, b long, likeness double")


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last third of its code points replaced by as many first
    ones (or all) of the next document by falling id; and their likeness to the text's and the next document's.

    Documents are dealt to buckets by ranges of ids. Each bucket also gets the first document of the one after it, so
    every document stands before its next one in some bucket, in order, and one pass does the rest."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), order_id().alias("id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(MAX_BUCKETS, size // BUCKET_BYTES + 1)
    shares = [k / buckets for k in range(1, buckets)]
    cuts = docs.where(F.col("id") < NO_ID).approxQuantile("id", shares, 0.2 / buckets) if shares else []
    cuts = np.unique(np.array(cuts, np.int64))  # at most a number for each bucket

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = len(cuts) - np.searchsorted(cuts, np.asarray(batch.column("id")), side="left")
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), *batch.columns],
                                             names=["bucket", *batch.schema.names])

    ids = docs.select("id").mapInArrow(deal, "bucket int, id long")
    heads = sorted((r.bucket, r.head) for r in ids.groupBy("bucket").agg(F.max("id").alias("head")).collect())
    before = {head: heads[k - 1][0] for k, (_, head) in enumerate(heads)}  # bucket 0 has the largest ids

    def deal_twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row to its bucket, and the first rows of a bucket also behind the bucket before it."""
        firsts = np.array(sorted(before), np.int64)
        for batch in deal(batches):
            for extra in (False, True):
                part = batch
                if extra:
                    id_ = np.asarray(batch.column("id"))
                    at = np.minimum(np.searchsorted(firsts, id_), len(firsts) - 1)
                    part = batch.filter(pa.array(firsts[at] == id_))
                    targets = pa.array([before[x] for x in part.column("id").to_pylist()], pa.int32())
                    part = part.set_column(0, "bucket", targets)
                yield pa.RecordBatch.from_arrays([pa.array([extra] * part.num_rows, pa.bool_()), *part.columns],
                                                 names=["extra", *part.schema.names])

    tied = F.xxhash64("text")  # the order of rows that share an id
    in_order = (docs.mapInArrow(deal_twice, "extra boolean, bucket int, doc_id long, id long, text string")
                .repartition(max(buckets, 1), "bucket")
                .sortWithinPartitions("bucket", "extra", F.desc("id"), tied))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows (bucket, extra, doc_id, text) without their next one

        def result() -> pa.RecordBatch:
            texts = [r[3] for r in held]
            pairs = [k for k in range(len(held) - 1) if held[k][0] == held[k + 1][0] and not held[k][1]]
            edited = []
            for k in pairs:
                n = len(texts[k]) // 3
                edited.append(texts[k][:len(texts[k]) - n] + texts[k + 1][:n])
            own, changed = fingerprints(texts), fingerprints(edited)
            return pa.RecordBatch.from_arrays([
                pa.array([held[k][2] for k in pairs], pa.int64()),
                pa.array([len(texts[k]) for k in pairs], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                pa.array([own[k] for k in pairs], pa.string()), pa.array(changed, pa.string()),
                pa.array([likeness(own[k], c) for k, c in zip(pairs, changed)], pa.float64()),
                pa.array([likeness(own[k], own[k + 1]) for k in pairs], pa.float64())], names=NAMES)

        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "extra", "doc_id", "text"))):
                held.append(row)
                size += len(row[3])
                if size > WALKED_AT_ONCE:
                    yield result()
                    held, size = [row], len(row[3])
        if held:
            yield result()

    return in_order.mapInArrow(compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                        "edited_fingerprint string, near_edited double, near_next double")


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
