"""Groups of documents whose sets of word shingles have a high Jaccard likeness, by prefix filters under several orders.

Two sets that are alike enough share a shingle among the first few of each, under any order of all shingles; so
candidates must share one under every order used. All orders put shingles first that occur in one document only, as a
merged sketch says; those make no candidates, and a document that has enough of them is alike to nothing. Beyond that
each order is a hash of its own.

Equal sets are one node. The work on large groups is kept small: first each node is compared with one node of its
shingles' lists for each order, the one with the fewest shingles of its own; links found so far give components, and
after that only pairs of nodes from different components are left to compare, all of them that share a listed shingle
and whose sizes, counts of shingles that any other document has, and marks (1,024 hashed bits of each set) allow the
likeness. Lists are split by classes of sizes for that: only sets of one class or of neighbouring ones meet. So no link
that matters for the components is lost.

The lists of that last comparison must stay short as tables grow: they are the prefixes under one more order, which puts
last the shingles that are repeated within small parts of the rows, the common ones. It is the same for all sets, so
what two sets have in common begins with one shingle in both; a pair is left out at shingles that have too few of either
set behind them, and a pair that is alike is found at the first.

What is shuffled is kept small: nodes have numbers, which take less room in lists than their names; shingles that one
node alone has in its list, and in the last comparison those that one component alone has, are left out behind sketches
before lists go anywhere; and of equal sets only the one that stands for the node is sent to be compared.

Defined cases: null and empty texts have no shingles, are linked with nothing and are components of their own; a text
with fewer words than a shingle has its whole sequence as one; rows are documents of their own also if repeated (equal
rows are linked); a null id is larger than any other, and a component of such rows only has a null id; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from claimwright.llm.common import (NO_ID, SPACES, Rolling, as_long, buffer_of, byte_set, chunks, mixed, order_id,
                                    sequences, stored, word_spans)
from claimwright.llm.graph import components
from claimwright.llm.sketch import flagged, key_column, merged_flags

SHINGLE = 4
LIKE = (85, 100)
ORDERS = 3
#: A shingle repeated within one in so many rows is a common one; each part sorts more of them out.
PARTS = (4, 32)
#: 64-bit words of a set's marks.
WORDS = 16

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Shingles:
    def __init__(self, length: int):
        self.length, self.spaces, self.lane = length, byte_set(SPACES), Rolling(0)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Different shingles of each text as hashes, sorted within it, and where each text's begin."""
        data, offsets = buffer_of(texts)
        data = LOWER[data]
        starts, ends = word_spans(data, offsets, self.spaces)
        words = self.lane.ranges(self.lane.prefix(data), starts, ends)
        first = np.searchsorted(starts, offsets)
        row = np.repeat(np.arange(len(texts)), np.diff(first))
        n = max(0, len(words) - self.length + 1)
        inside = row[:n] == row[self.length - 1:self.length - 1 + n]
        hashes, row = sequences(words, self.length)[inside], row[:n][inside]
        counts = np.diff(first)
        for k in np.flatnonzero((counts > 0) & (counts < self.length)):
            hashes = np.append(hashes, sequences(words[first[k]:first[k + 1]], int(counts[k]), seed=int(counts[k])))
            row = np.append(row, k)
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        hashes, row = hashes[new], row[new]
        return hashes, np.searchsorted(row, np.arange(len(texts) + 1))


def node_names(hashes: np.ndarray, begins: np.ndarray) -> list[bytes | None]:
    """128 bits of each set, the same for any order of its members; None for the empty set."""
    lanes = []
    for seed in (21, 22):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes, seed), dtype=np.uint64)])
        lanes.append(mixed((sums[begins[1:]] - sums[begins[:-1]]), seed))
    pairs = np.stack(lanes, 1).astype(">u8")
    return [pairs[k].tobytes() if begins[k + 1] > begins[k] else None for k in range(len(pairs))]


def marked(spots: np.ndarray) -> np.ndarray:
    """WORDS numbers of 64 bits with the bits at `spots` set."""
    bits = np.zeros(64 * WORDS, np.uint8)
    bits[spots] = 1
    return np.packbits(bits).view(np.int64)


def size_class(n: str, like: tuple[int, int]) -> Column:
    """Sets that are alike enough are of one class of sizes or of neighbouring ones."""
    width = math.log(max(like[1] / like[0], 1.05)) * 1.001  # rounding does not move a set by a class
    return F.floor(F.ln(n) / width)


def keys_of(names: list[bytes], ids: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x[:8] for x in names), np.uint64) ^ mixed(np.asarray(ids).view(np.uint64), 8)


def flagged_lists(frame: DataFrame, column: str, flags, seed: int | None = None) -> DataFrame:
    """A row (token, place in the list, other columns) for each member of the lists in `column` that is flagged, as
    it is or scrambled by `seed`."""
    rest = [c for c in frame.columns if c != column]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(column)
            tokens, row = np.asarray(pc.list_flatten(lists)).view(np.uint64), np.asarray(pc.list_parent_indices(lists))
            place = np.arange(len(row)) - np.searchsorted(row, row)
            keep = flagged(tokens if seed is None else mixed(tokens, seed), *flags.value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(as_long(tokens[keep])), pa.array(place[keep]),
                 *(batch.column(c).take(pa.array(row[keep])) for c in rest)], names=["token", "place", *rest])

    kinds = ", ".join(f"{c} {frame.schema[c].dataType.simpleString()}" for c in rest)
    return frame.mapInArrow(rows, f"token long, place long, {kinds}")


def prefix_sets(docs: DataFrame, *, shingle: int = SHINGLE, like: tuple[int, int] = LIKE) -> DataFrame:
    """Of every row of (doc_id, id, text) the name and size of its set, the number of shingles that other documents
    have too, marks, and the shingles in its prefix under each order (p0, p1, ...; null where it can be alike to none)
    and, sorted, under the one that has common shingles last (rare)."""
    num, den = like
    context = docs.sparkSession.sparkContext
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        shingles = Shingles(shingle)
        for part in chunks(batch):
            yield shingles.of(part.column("text"))[0]

    def flags_of(rows: DataFrame, expected: int):
        return context.broadcast(merged_flags(rows.select("text"), keys, expected))

    twice = flags_of(docs, size // 6 + 1)
    common = [flags_of(docs.where(F.pmod(F.xxhash64("id", F.lit(part)), F.lit(part)) == 0), size // 6 // part + 1)
              for part in PARTS]

    def commonness(hashes: np.ndarray) -> np.ndarray:
        """In how many of the parts a shingle is repeated, as the sketches say, and behind that its hash."""
        places = mixed(hashes, 30) >> np.uint64(2)
        for flags in common:
            places += flagged(hashes, *flags.value).astype(np.uint64) << np.uint64(62)
        return places

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            for part in chunks(batch):
                hashes, begins = shingles.of(part.column("text"))
                shared = flagged(hashes, *twice.value)
                n_shared = np.diff(np.concatenate([[0], np.cumsum(shared)])[begins])
                prefixes: list[list] = [[] for _ in range(ORDERS)]
                rare: list = []
                spots = (mixed(hashes, 55) % np.uint64(64 * WORDS)).astype(np.int64)
                marks: list = []
                for a, b in zip(begins[:-1], begins[1:]):
                    n = int(b - a)
                    length = n + (-n * num // den) + 1 if n else 0
                    own = hashes[a:b][shared[a:b]]
                    left = length - (n - len(own))  # of the prefix, behind the shingles no other document has
                    marks.append(marked(spots[a:b]) if left > 0 and len(own) else None)
                    rare.append(as_long(own[np.argsort(commonness(own))[:left]]) if left > 0 else None)
                    for k, out in enumerate(prefixes):
                        if left <= 0:
                            out.append(None)
                        elif left >= len(own):
                            out.append(as_long(own))
                        else:
                            out.append(as_long(own[np.argpartition(mixed(own, 30 + k), left - 1)[:left]]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("id"), pa.array(node_names(hashes, begins), pa.binary()),
                     pa.array(np.diff(begins)), pa.array(n_shared),
                     pa.array(marks, pa.list_(pa.int64())), pa.array(rare, pa.list_(pa.int64())),
                     *(pa.array(p, pa.list_(pa.int64())) for p in prefixes)],
                    names=["doc_id", "id", "node", "n", "shared", "marks", "rare", *(f"p{k}" for k in range(ORDERS))])

    arrays = ", ".join(f"p{k} array<long>" for k in range(ORDERS))
    rows = stored(docs.mapInArrow(summarise, "doc_id long, id long, node binary, n long, shared long, "
                                             f"marks array<long>, rare array<long>, {arrays}"), "sets")
    for flags in (twice, *common):
        flags.destroy()
    return rows


def may_be_alike(like: tuple[int, int], n_x: str, n_y: str, shared_x: str, shared_y: str,
                 marks: tuple[str, str] | None = None) -> Column:
    """Two sets have no more in common than either shares with any document, and every mark that only one of them
    has stands for a shingle that only it has."""
    num, den = like
    most = F.least(n_x, n_y, shared_x, shared_y)
    if marks:
        x, y = ([F.col(m)[k] for k in range(WORDS)] for m in marks)
        only_x = sum((F.bit_count(p.bitwiseAND(F.bitwise_not(q))) for p, q in zip(x, y)), F.lit(0))
        only_y = sum((F.bit_count(q.bitwiseAND(F.bitwise_not(p))) for p, q in zip(x, y)), F.lit(0))
        most = F.least(most, F.col(n_x) - only_x, F.col(n_y) - only_y)
    return den * most >= num * (F.col(n_x) + F.col(n_y) - most)


def pairs_across(nodes: DataFrame, roots: DataFrame, like: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of `nodes` of different components, by `roots` (node, root), that may be alike."""
    context = nodes.sparkSession.sparkContext
    placed = stored(nodes.select("node", "n", "shared", "rare").join(roots, "node", "left")
                    .withColumn("root", F.coalesce("root", "node")), "placed")
    split = stored(placed.select("root", F.explode("rare").alias("token")).groupBy("token")
                   .agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token"), "split")
    flags = context.broadcast(merged_flags(split, key_column("token"), split.count(), flag="once"))
    labelled = stored(flagged_lists(placed, "rare", flags)
                      .select("token", "node", "n", (F.col("shared") - F.col("place")).alias("shared"), "root")  # from here on
                      .join(split, "token"), "lists")
    flags.destroy()
    labelled = labelled.select("token", size_class("n", like).alias("size"), "node", "n", "shared", "root")
    smaller = labelled.toDF("token", "size", "a", "n_a", "shared_a", "root_a")
    larger = (labelled.withColumn("size", F.explode(F.array("size", F.col("size") - 1)))
              .toDF("token", "size", "b", "n_b", "shared_b", "root_b"))
    pairs = (smaller.join(larger, ["token", "size"])
             .where("root_a <> root_b AND (n_a < n_b OR n_a = n_b AND a < b)")
             .where(may_be_alike(like, "n_a", "n_b", "shared_a", "shared_b"))
             .select("a", "b").distinct())
    # Marks are wide: they go to the pairs that are left, not to every list.
    sides = [nodes.select(F.col("node").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n", "shared", "marks")))
             for s in "ab"]
    return (pairs.join(sides[0], "a").join(sides[1], "b")
            .where(may_be_alike(like, "n_a", "n_b", "shared_a", "shared_b", ("marks_a", "marks_b")))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def similar_groups(docs: DataFrame, *, shingle: int = SHINGLE, like: tuple[int, int] = LIKE) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (to other sets, as far as they were compared) for every row."""
    num, den = like
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), order_id().alias("id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    context = docs.sparkSession.sparkContext
    orders = [f"p{k}" for k in range(ORDERS)]
    rows = prefix_sets(docs, shingle=shingle, like=like)
    nodes = stored(rows.where("p0 IS NOT NULL").select(F.col("node").alias("name"), "id", "n", "shared", "marks", "rare",
                                                       *orders)
                   .dropDuplicates(["name"]).withColumn("node", F.monotonically_increasing_id()), "nodes")
    listed = nodes.agg(F.sum(F.size("p0"))).first()[0] or 0

    def tokens_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for k, order in enumerate(orders):
            yield mixed(np.asarray(pc.list_flatten(batch.column(order))).view(np.uint64), 60 + k)

    repeated = context.broadcast(merged_flags(nodes.select(*orders), tokens_of, ORDERS * listed))

    def lists(k: int) -> DataFrame:
        """Of one order, without the shingles that surely are in one list only."""
        return flagged_lists(nodes.select("node", "n", "shared", orders[k]), orders[k], repeated, 60 + k).drop("place")

    def ends_of(pairs: DataFrame, *columns: str) -> DataFrame:
        return (pairs.select(*(F.col(f"{c}_a").alias(c) for c in columns))
                .union(pairs.select(*(F.col(f"{c}_b").alias(c) for c in columns))).distinct())

    def verified(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The pairs (a, b) that pass the filters of all orders, and those of them that are alike enough."""
        pairs = stored(pairs, "pairs")
        ends = stored(ends_of(pairs.toDF("node_a", "node_b"), "node"), "ends")
        compared = context.broadcast(merged_flags(ends, key_column("node"), ends.count(), flag="once"))

        def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(flagged(np.asarray(batch.column("node")).view(np.uint64), *compared.value)))

        wide = nodes.select("node", "name", "id", *orders)
        wide = wide.mapInArrow(some, wide.schema)
        sides = [wide.toDF(s, f"name_{s}", f"id_{s}", *(f"{p}_{s}" for p in orders)) for s in "ab"]
        pairs = pairs.join(sides[0], "a").join(sides[1], "b")
        for p in orders:
            pairs = pairs.where(F.arrays_overlap(f"{p}_a", f"{p}_b"))
        candidates = stored(pairs.select("a", "b", "name_a", "name_b", "id_a", "id_b"), "candidates")
        compared.destroy()
        ends = stored(ends_of(candidates, "name", "id"), "ends")
        wanted = context.broadcast(merged_flags(
            ends, lambda batch: [keys_of(batch.column("name").to_pylist(), batch.column("id"))], ends.count(), flag="once"))

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shingles = Shingles(shingle)
            for batch in batches:
                for part in chunks(batch):
                    hashes, begins = shingles.of(part.column("text"))
                    names = node_names(hashes, begins)
                    some = np.flatnonzero(np.diff(begins) > 0)
                    ids = part.column("id").take(pa.array(some))
                    some = some[flagged(keys_of([names[k] for k in some], ids), *wanted.value)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[k] for k in some], pa.binary()),
                         pa.array([hashes[begins[k]:begins[k + 1]].tobytes() for k in some], pa.binary())],
                        names=["node", "members"])

        members = stored(docs.select("id", "text").mapInArrow(sets, "node binary, members binary").dropDuplicates(["node"]),
                         "members")
        full = (candidates.select("a", "b", "name_a", "name_b").join(members.toDF("name_a", "members_a"), "name_a")
                .join(members.toDF("name_b", "members_b"), "name_b").select("a", "b", "members_a", "members_b"))

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for x, y in zip(batch.column("members_a"), batch.column("members_b")):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(den * both >= num * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        same = stored(full.mapInArrow(check, "a long, b long"), "alike")
        wanted.destroy()
        return candidates.select("a", "b"), same

    # One node of each list against the others: the one with the fewest shingles of its own, which is the likeliest to
    # be what the others are copies of. Each node keeps the best such pair of each order.
    stars = None
    for k in range(ORDERS):
        whole = lists(k)
        own = (F.col("n") - F.col("shared")).alias("own")
        centre = whole.groupBy("token").agg(F.min(F.struct(own, "node", "n", "shared")).alias("c"))
        centre = centre.select("token", "c.own", F.col("c.node").alias("a"), F.col("c.n").alias("n_a"),
                               F.col("c.shared").alias("shared_a"))
        star = (whole.join(centre, "token").where(F.col("node") != F.col("a"))
                .where(may_be_alike(like, "n", "n_a", "shared", "shared_a"))
                .groupBy(F.col("node").alias("b")).agg(F.min(F.struct("own", "a")).alias("best"))
                .select(F.col("best.a").alias("a"), "b"))
        stars = star if stars is None else stars.union(star)
    stars = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tried, alike = verified(stars)
    repeated.destroy()

    # Every other pair, as far as it would join two components.
    across = pairs_across(nodes, components(alike), like).join(tried, ["a", "b"], "left_anti")
    _, more = verified(across)
    links = alike.union(more)
    degree = (links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count(F.lit(1)).alias("n_links")))
    names = nodes.select("node", "name")
    roots = stored(components(links).join(degree, "node").join(names, "node")
                   .join(names.toDF("root", "root_name"), "root")
                   .select(F.col("name").alias("node"), F.col("root_name").alias("root"), "n_links"), "roots")

    named = rows.select("doc_id", "id", "n", "node").join(roots, "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    least = named.where("n > 0").groupBy("root").agg(F.min("id").alias("least"))
    component = F.coalesce("least", "id")
    return (named.join(least, "root", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(component < NO_ID, component).alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))
