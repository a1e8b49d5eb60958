"""Repeated byte strings by longest-previous-factor arrays.

A string of `length` bytes that occurs twice is found through an anchor inside it: of its byte runs of length // 2,
the one with the smallest hash is chosen by content alone, so both occurrences choose the same. Each anchor's
segment reaches as far to both sides as a string through the anchor can. Segments with one anchor meet:

1. Anchors that a merged sketch estimates repeated are counted exactly, with a hash of their whole segment.
2. A segment that occurs twice is repeated as a whole. It is not sorted again for each copy: one stands for all.
3. Where different segments share an anchor, the texts of the different ones are sorted together: the suffix array over
   their left and right sides, of each position where a string through the anchor begins. Positions whose longest
   previous factor has the whole length are later copies, and the factor's source is the earlier one: the two are
   neighbours in the suffix order, so shorter factors are not looked for.
4. Anchors with very many different segments are not sorted in one task: their segments are split by pairs of shorter
   sides, one of which any two segments with a string in common share; groups that are still too large have their
   strings counted by hash.

What a match means for a document goes back to it as a range of bytes: both the later copy and its source, so that every
byte of a string that stands anywhere else as well is covered. `later_copies` keeps the first occurrence instead.

Defined cases: a null or empty text has no bytes; shorter texts than `length` have no repeats; rows of one document (one
id and text) are one document and come back once each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import Rolling, as_long, buffer_of, chunks, mixed, stored, with_copy
from claimwright.llm.rewrite import rewritten
from claimwright.llm.sketch import flagged, key_column, merged_flags

LENGTH = 200
#: Different segments of an anchor that are sorted together.
GROUP = 4000
#: Segments handled at once, or the groups that hold as many: what is sorted stays near the processor.
SORTED_AT_ONCE = 1000
#: Of fewer symbols three ranks make one number, so a round of sorting makes ranks of three times the length.
TRIPLED = 2**20
#: Pairs of sides that segments of a larger group are told apart by.
PARTS = 5


def sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """`pick` (minimum or maximum) over each `width` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[:-step], x[step:])
        done += step
    return x


class Anchors:
    """Content-chosen byte runs: in every `length` bytes of a text there is at least one."""

    def __init__(self, length: int):
        self.length, self.run = length, length // 2
        self.lanes = [Rolling(0), Rolling(1)]

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the buffer and hashes."""
        n, width = len(data), self.length - self.run + 1
        if n < self.length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        sums = self.lanes[0].prefix(data)
        raw = (sums[self.run:] - sums[:-self.run]) * self.lanes[0].down[:n - self.run + 1]
        hashes = mixed(raw, 5) | np.uint64(1)
        least = sliding(hashes, width, np.minimum)  # of each string's runs
        crossing = np.zeros(n + 1, np.int32)  # strings that do not lie in one text
        ends = offsets[1:-1]
        np.add.at(crossing, np.maximum(ends - self.length + 1, 0), 1)
        np.add.at(crossing, ends, -1)
        least[np.cumsum(crossing)[:len(least)] > 0] = 0
        pad = np.zeros(width - 1, np.uint64)
        highest = sliding(np.concatenate([pad, least, pad]), width, np.maximum)
        at = np.flatnonzero(highest == hashes)
        return at, hashes[at]


def suffix_ranks(symbols: np.ndarray, group: np.ndarray, depth: int,
                 places: np.ndarray | None = None) -> list[tuple[int, np.ndarray]]:
    """Ranks of each position by (group, the next symbols), equal ones sharing a rank, for 5, 15, 45 (or 5, 10, 20) and
    so on symbols up to `depth`; those for the whole depth of the `places` only, if given. Symbols are below 2^9 and 0
    ends a text."""
    packing = min(5, depth)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(depth + packing, np.int64)])
    n = len(symbols)
    key = group.astype(np.int64)
    for k in range(packing):
        key = (key << 9) | padded[k:k + n]
    # What lies behind a text's end is not compared.
    room = room_of(symbols)
    for k in range(1, packing):
        key[room < k] &= ~(np.int64(511) << np.int64(9 * (packing - 1 - k)))
    ranks = [(packing, dense(key))]
    while ranks[-1][0] < depth:
        done, rank = ranks[-1]
        reach = min((3 if n < TRIPLED else 2) * done, depth)
        key = rank
        for step in ([done] if reach > 2 * done else []) + [reach - done]:
            follow = np.zeros(n, np.int64)
            follow[:-step or None] = rank[step:] + 1
            follow[room < step] = 0
            key = key * (n + 2) + follow
        if reach < depth or places is None:
            ranks.append((reach, dense(key)))
        else:
            last = np.full(n, -1, np.int64)
            last[places] = dense(key[places])
            ranks.append((reach, last))
    return ranks


def room_of(symbols: np.ndarray) -> np.ndarray:
    """Symbols from each place on before its text ends."""
    at = np.arange(len(symbols))
    ends = np.where(symbols == 0, at, len(symbols))
    return np.minimum.accumulate(ends[::-1])[::-1] - at


def dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
    return rank


def previous_smaller(values: np.ndarray, reach: int | None = None) -> np.ndarray:
    """For each index the nearest one before it with a smaller value, or -1: least values of runs of 1, 2, 4 and so on
    are made first, then the longest runs that hold no smaller value are passed over. Where there is none in the last
    `reach` indices, any one beyond them."""
    n = len(values)
    reach = n if reach is None else min(reach, n)
    least = [values]
    while 2 ** len(least) <= reach:
        half = 2 ** (len(least) - 1)
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))  # of the run that begins at each index
    at = np.arange(n)  # nothing in at .. index is smaller
    for k in reversed(range(len(least))):
        begin = at - 2 ** k
        over = (begin >= 0) & (least[k][np.maximum(begin, 0)] > values)
        at[over] = begin[over]
    return at - 1


def common_prefix(symbols: np.ndarray, ranks: list[tuple[int, np.ndarray]], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Equal symbols from the places x and y of one group on, up to the depth of the ranks and the texts' ends."""
    ends = np.flatnonzero(symbols == 0)
    room = np.append(ends, len(symbols))[np.searchsorted(ends, x)] - x
    n, last = np.zeros(len(x), np.int64), len(symbols) - 1
    lengths = [1, *(length for length, _ in ranks)]
    again = [-(-b // a) - 1 for a, b in zip(lengths, lengths[1:])]  # how often each length fits into the next
    steps = [ranks[-1]]
    for times, (length, rank) in zip(again[:0:-1], ranks[-2::-1]):
        steps += [(length, rank)] * times
    steps += [(1, symbols)] * again[0]
    open_ = np.ones(len(x), bool)
    for k, (length, rank) in enumerate(steps):
        same = open_ & (rank[np.minimum(x + n, last)] == rank[np.minimum(y + n, last)])
        n[same] += length
        open_ &= n < room
        if k == 0:
            open_ &= ~same  # the whole depth
        if length == 1:
            open_ &= same
    return np.minimum(n, room)


def longest_previous_factors(symbols: np.ndarray, group: np.ndarray, depth: int,
                             places: np.ndarray | None = None, shorter: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """For each of the `places` (all, if not given; in order) the length, up to `depth`, of the longest string from
    there on that an earlier one of them in its group begins with too, and that place: the nearest one where the whole
    depth is equal, -1 where nothing is. Without `shorter`, factors that do not have the whole depth count as none.

    Of all earlier places, those that stand nearest before and behind in the suffix order (its previous and next
    smaller values) have the longest strings in common; those with the whole depth in common stand together in it."""
    places = np.arange(len(symbols)) if places is None else places
    ranks = suffix_ranks(symbols, group, depth, places)
    whole, m = ranks[-1][1][places], len(places)
    order = np.sort(whole * m + np.arange(m)) % max(m, 1)  # equal ones by place
    lengths, source = np.zeros(m, np.int64), np.full(m, -1, np.int64)
    if not shorter:
        equal = (whole[order[1:]] == whole[order[:-1]]) & (room_of(symbols)[places[order[1:]]] >= depth)
        later = order[1:][equal]
        lengths[later], source[later] = depth, places[order[:-1][equal]]
        return lengths, source
    reach = int(np.unique(group[places], return_counts=True)[1].max(initial=0))  # a group stands together
    before, behind = previous_smaller(order, reach), len(order) - 1 - previous_smaller(order[::-1], reach)[::-1]
    for near in (before, np.where(behind < len(order), behind, -1)):
        own, other = order[near >= 0], order[near[near >= 0]]
        one = group[places[own]] == group[places[other]]
        own, other = own[one], other[one]
        n = common_prefix(symbols, ranks, places[own], places[other])
        longer = n > lengths[own]
        lengths[own[longer]], source[own[longer]] = n[longer], places[other[longer]]
    return lengths, source


def later_copies(texts: list[str], length: int) -> list[list[tuple[int, int]]]:
    """Byte ranges of each text that earlier text or an earlier place of it covers with strings of `length` bytes; the
    first occurrence is left out. For texts that one task holds."""
    data = [t.encode() for t in texts]
    symbols = np.concatenate([np.append(np.frombuffer(d, np.uint8).astype(np.int64) + 1, 0) for d in data])
    starts = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])
    factors, _ = longest_previous_factors(symbols, np.zeros(len(symbols), np.int64), length)
    out = []
    for k, d in enumerate(data):
        own = np.flatnonzero(factors[starts[k]:starts[k] + len(d)] >= length)
        out.append(merged_spans(np.stack([own, own + length], 1).ravel()))
    return out


def repeated_sides(group: np.ndarray, left: list[bytes], right: list[bytes], run: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each segment the most and the least left bytes of a string through its anchor that another segment of its
    group has too; most < least where there is none."""
    ends = np.array([len(x) for x in left])
    totals = ends + 2 + np.array([len(x) for x in right])
    starts = np.concatenate([[0], np.cumsum(totals)])
    # left side, the anchor as one symbol, right side, end
    joined = b"".join(a + b"\0" + b + b"\0" for a, b in zip(left, right))
    symbols = np.frombuffer(joined, np.uint8).astype(np.int64) + 1
    anchor = starts[:-1] + ends
    symbols[anchor] = 300
    symbols[starts[1:] - 1] = 0
    owner = np.repeat(np.arange(len(left)), totals)
    before = anchor[owner] - np.arange(len(symbols))  # left bytes of a string from here
    inside = starts[1:][owner] - 1 - np.arange(len(symbols)) > run  # the string ends before its text does
    # Equal strings have the anchor at the same place, else they are another anchor's to find.
    places = np.flatnonzero((before >= 0) & (before <= run) & inside)
    factors, source = longest_previous_factors(symbols, group[owner], run + 1, places, shorter=False)
    whole = factors > run
    later, source = places[whole], source[whole]
    hit = np.concatenate([later, source])
    most, least = np.full(len(left), -1, np.int64), np.full(len(left), run + 1, np.int64)
    np.maximum.at(most, owner[hit], before[hit])
    np.minimum.at(least, owner[hit], before[hit])
    return most, least


def repeated_ranges(docs: DataFrame, one: DataFrame, size: int, length: int = LENGTH) -> DataFrame:
    """(id, copy, begin, end): byte ranges that cover every string of `length` bytes that occurs twice."""
    run = length // 2
    context = docs.sparkSession.sparkContext

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        anchors = Anchors(length)
        for part in chunks(batch):
            yield anchors.of(*buffer_of(part.column("text")))[1]

    twice = context.broadcast(merged_flags(one.select("text"), keys, size // run + 1))

    def segments(flags, texts: bool):
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors = Anchors(length)
            for batch in batches:
                for part in chunks(batch):
                    data, offsets = buffer_of(part.column("text"))
                    at, a = anchors.of(data, offsets)
                    keep = np.ones(len(a), bool)
                    for f in flags:
                        keep[keep] = flagged(a[keep], *f.value)
                    at, a = at[keep], a[keep]
                    row = np.searchsorted(offsets, at, side="right") - 1
                    begin = np.maximum(at - run, offsets[row])
                    end = np.minimum(at + 2 * run, offsets[row + 1])
                    lane = anchors.lanes[1]
                    sums = lane.prefix(data)
                    b = lane.ranges(sums, at, at + run)
                    c = mixed(lane.ranges(sums, begin, end) ^ mixed((at - begin).astype(np.uint64), 3), 9)
                    out = {"a": as_long(a), "b": as_long(b).astype(np.int32), "c": as_long(c)}
                    if texts:
                        _, first = np.unique(c, return_index=True)
                        out = {k: v[first] for k, v in out.items()}
                        raw, at, begin, end = data.tobytes(), at[first], begin[first], end[first]
                        out["left"] = pa.array([raw[i:j] for i, j in zip(begin, at)], pa.binary())
                        out["right"] = pa.array([raw[i + run:j] for i, j in zip(at, end)], pa.binary())
                    else:
                        out |= {"l": (at - begin).astype(np.int16), "r": (end - at - run).astype(np.int16),
                                "id": np.asarray(part.column("id"))[row], "copy": np.asarray(part.column("copy"))[row],
                                "place": (at - offsets[row])}
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in out.values()], names=list(out))
        own = "left binary, right binary" if texts else "l short, r short, id long, copy long, place long"
        return one.select("id", "copy", "text").mapInArrow(rows, f"a long, b int, c long, {own}")

    occurrences = stored(segments([twice], False), "occurrences")
    counted = occurrences.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"), F.first("l").alias("l"),
                                                     F.first("r").alias("r"))
    distinct = stored(counted, "segments")
    anchors = (distinct.groupBy("a", "b").agg(F.count(F.lit(1)).alias("segments"), F.min("n").alias("fewest"))
               .where("segments > 1 AND fewest = 1").select("a", "b", "segments"))
    several = stored(anchors, "anchors")
    shared = context.broadcast(merged_flags(several.select("a"), key_column("a"), several.count(), flag="once"))
    texts = (segments([twice, shared], True).groupBy("a", "b", "c")
             .agg(F.first("left").alias("left"), F.first("right").alias("right")))
    texts = stored(texts.join(several, ["a", "b"]), "texts")

    def together(frame: DataFrame) -> DataFrame:
        return (frame.repartition("a", "b", "k").sortWithinPartitions("a", "b", "k", "c")
                .mapInArrow(lambda batches: sorted_groups(batches, run), "a long, b int, c long, most long, least long"))

    # Anchors of very many different segments: two that share a string share one of PARTS pairs of shorter sides, so
    # groups by anchor and pair will do, with PARTS times the rows.
    small = F.col("segments") <= GROUP
    paired = stored(texts.where(~small).drop("segments").mapInArrow(
        lambda batches: side_pairs(batches, run), "a long, b int, c long, k long, left binary, right binary"), "pairs")
    sizes = paired.groupBy("a", "b", "k").agg(F.count(F.lit(1)).alias("segments")).where("segments > 1")
    paired = paired.join(sizes, ["a", "b", "k"])
    # Where even such a group is too large, each string through the anchor is counted by its hash.
    strings = paired.where(~small).dropDuplicates(["a", "b", "c"]).mapInArrow(
        lambda batches: strings_of(batches, run), "a long, b int, c long, before long, s long, t long")
    again = strings.groupBy("a", "b", "s", "t").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    counted = (strings.join(again, ["a", "b", "s", "t"]).groupBy("a", "b", "c")
               .agg(F.max("before").alias("most"), F.min("before").alias("least")))
    found = (together(texts.where(small).withColumn("k", F.lit(0).cast("long"))).unionByName(together(paired.where(small)))
             .unionByName(counted))
    partly = found.where("most >= least").groupBy("a", "b", "c").agg(F.max("most").alias("most"),
                                                                     F.min("least").alias("least"))

    whole = (distinct.where("n > 1").select("a", "b", "c", F.col("l").cast("long").alias("most"),
                                            F.greatest(F.lit(0), run - F.col("r")).cast("long").alias("least")))
    single = distinct.where("n = 1").select("a", "b", "c").join(partly, ["a", "b", "c"])
    reach = whole.unionByName(single)
    return occurrences.join(reach, ["a", "b", "c"]).select(
        "id", "copy", (F.col("place") - F.col("most")).alias("begin"),
        (F.col("place") - F.col("least") + 2 * run).alias("end"))


def sorted_groups(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """Segments in the order of their anchors; whole groups are sorted together."""
    names = ["a", "b", "c", "left", "right", "k"]
    held: list[list] = [[] for _ in names]

    def solved(n: int) -> pa.RecordBatch:
        a, b, c, left, right, k = (x[:n] for x in held)
        for x in held:
            del x[:n]
        first = np.array([i == 0 or (a[i], b[i], k[i]) != (a[i - 1], b[i - 1], k[i - 1]) for i in range(n)])
        most, least = repeated_sides(np.cumsum(first) - 1, left, right, run)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int32()), pa.array(c, pa.int64()), pa.array(most),
             pa.array(least)], names=["a", "b", "c", "most", "least"])

    for batch in batches:
        for x, name in zip(held, names):
            x.extend(batch.column(name).to_pylist())
        while len(held[0]) > SORTED_AT_ONCE:
            n = SORTED_AT_ONCE
            while n < len(held[0]) and all(held[i][n] == held[i][n - 1] for i in (0, 1, 5)):
                n += 1
            if n == len(held[0]):  # the group may go on
                break
            yield solved(n)
    if held[0]:
        yield solved(len(held[0]))


def side_pairs(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """Each segment under each pair of sides that it has: the nearest i / PARTS of the left bytes and what is missing
    to (PARTS - 1) / PARTS of the run on the right. Of two segments with a string in common, with x of its bytes on the
    left, the pair with the largest i / PARTS up to x is the same."""
    step = -(-run // PARTS)
    for batch in batches:
        rows = []
        for a, b, c, left, right in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "c", "left", "right"))):
            for i in range(PARTS):
                x = i * step
                y = max(0, run - x - step)
                if x <= len(left) and y <= len(right):
                    mark = hashlib.blake2b(b"%d:" % i + left[len(left) - x:] + b":" + right[:y], digest_size=8)
                    rows.append((a, b, c, int.from_bytes(mark.digest(), "little", signed=True), left, right))
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(
            (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
            names=["a", "b", "c", "k", "left", "right"])


def strings_of(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """Two hashes of each string through the anchor of each segment."""
    lanes = [Rolling(0), Rolling(1)]
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            left, right = part.column("left").to_pylist(), part.column("right").to_pylist()
            data, offsets = buffer_of(pa.array([x + y for x, y in zip(left, right)], pa.binary()))
            anchor = offsets[:-1] + [len(x) for x in left]
            row = np.repeat(np.arange(len(left)), run + 1)
            before = np.tile(np.arange(run + 1), len(left))
            begin = anchor[row] - before
            good = (begin >= offsets[row]) & (begin + run <= offsets[row + 1])
            row, before, begin = row[good], before[good], begin[good]
            mark = mixed(before.astype(np.uint64), 4)
            s, t = (as_long(mixed(x.ranges(x.prefix(data), begin, begin + run) ^ mark, 6)) for x in lanes)
            yield pa.RecordBatch.from_arrays(
                [part.column(c).take(pa.array(row)) for c in ("a", "b", "c")] +
                [pa.array(before), pa.array(s), pa.array(t)], names=["a", "b", "c", "before", "s", "t"])


def merged_spans(ranges: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of a flat list of (begin, end)."""
    if not len(ranges):
        return []
    begins, ends = ranges[0::2], ranges[1::2]
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], begins[1:] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(ends) - 1]])
    return list(zip(begins[new].tolist(), ends[last].tolist()))


def remove_repeated_bytes(docs: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the removed spans as begin-end, comma-joined."""
    if length < 2 or length % 2:
        raise ValueError("the length must be an even number")
    docs, one = with_copy(docs)
    size, n_docs = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    ranges = repeated_ranges(docs, one, size or 0, length)
    marks = stored(ranges.groupBy("id", "copy")
                   .agg(F.flatten(F.collect_set(F.array("begin", "end"))).alias("marks")), "ranges")

    def result(text: str, found: np.ndarray) -> tuple:
        data = text.encode()
        spans = merged_spans(found)
        edges = [0, *(x for span in spans for x in span), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[0::2], edges[1::2]))
        return (len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                ",".join(f"{a}-{b}" for a, b in spans))

    return rewritten(docs, marks, n_docs, result, {"n_bytes": "long", "n_removed": "long", "n_spans": "long",
                                                   "kept_sha256": "string", "spans": "string"})
