"""Gradient-boosted trees over binned columns: Spark ML's algorithm and random draws, other bookkeeping.

Spark's own fit keeps an object of some 140 bytes for each row, two tuples beside it, and visits them one by one, for each
level of each tree. Here a row is a byte for each feature, its label, its margin and the target of the tree that is
grown: 38 bytes for 21 features, in blocks of columns. A pass takes a block's rows down the tree as lists of row numbers
and adds a node's rows to its histograms at once.

What is grown is the same: bins, bootstrap rows by partition, the features drawn for a node, the order of nodes, the
choice of a split and the merging of equal leaves are those of `org.apache.spark.ml.tree.impl` (Spark 4.1). Sums are
added up in the order of rows and partitions; beyond DRIVER_SUMS partitions in any order, as in Spark, so that of splits
that are equally good but for rounding another may be taken."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel
from pyspark.ml import classification
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

# Rows of a block, at least, unless a partition ends.
BLOCK_ROWS = 32_768
# Trees after which rows are derived from the binned columns again, not from the rows of the tree before: it bounds what
# a lost executor's tasks go back through.
RENEWED_AFTER = 20
# Partitions whose histograms the driver adds up by itself; more are added up by tasks first.
DRIVER_SUMS = 128
MASK = (1 << 64) - 1
# Rows that one lane of the generator draws for.
LANE_ROWS = 32
# Smallest impurity that is told from 0 (`Utils.EPSILON`).
EPSILON = 2.0**-52


# --- Spark's random numbers -----------------------------------------------------------------------------


def murmur3(data: bytes, seed: int) -> int:
    """MurmurHash3 of 8 bytes, as Scala's `bytesHash`."""
    h = seed
    for at in (0, 4):
        k = int.from_bytes(data[at:at + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = (h << 13 | h >> 19) & 0xFFFFFFFF
        h = (h * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= 8
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def first_state(seed: int) -> int:
    """State of Spark's `XORShiftRandom` for a seed."""
    data = (seed & MASK).to_bytes(8, "big")
    low = murmur3(data, 0x3C074A61)
    return murmur3(data, low) << 32 | low


def stepped(x):
    """The next state, of a number or of an array of them."""
    x = x ^ (x << 21 & MASK if isinstance(x, int) else x << np.uint64(21))
    x = x ^ (x >> 35 if isinstance(x, int) else x >> np.uint64(35))
    return x ^ (x << 4 & MASK if isinstance(x, int) else x << np.uint64(4))


def draws(seed: int) -> Iterator[float]:
    """`nextDouble` again and again."""
    x = first_state(seed)
    while True:
        x = stepped(x)
        high = x & (1 << 26) - 1
        x = stepped(x)
        yield ((high << 27) + (x & (1 << 27) - 1)) * 2.0**-53


def reservoir(n: int, k: int, seed: int) -> list[int]:
    """`k` of the numbers below `n`, as `SamplingUtils.reservoirSampleAndCount`."""
    kept, numbers = list(range(min(n, k))), draws(seed)
    for item in range(len(kept), n):
        place = int(next(numbers) * (item + 1))
        if place < k:
            kept[place] = item
    return kept


def jump_tables(lanes: int = 16) -> np.ndarray:
    """For k below `lanes`, the step over 2^k lanes as one table for each byte of a state: states are bits, and a step is
    linear in them."""
    columns = stepped(np.uint64(1) << np.arange(64, dtype=np.uint64))

    def moved(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        for bit in range(64):
            out ^= np.where(x >> np.uint64(bit) & np.uint64(1), columns[bit], np.uint64(0))
        return out

    for _ in range((2 * LANE_ROWS).bit_length() - 1):  # two steps a draw
        columns = moved(columns, columns)
    tables = np.empty((lanes, 8, 256), np.uint64)
    for k in range(lanes):
        for byte in range(8):
            tables[k, byte] = moved(columns, np.arange(256, dtype=np.uint64) << np.uint64(8 * byte))
        columns = moved(columns, columns)
    return tables


def drawn(state: int, n: int, rate: float, tables: np.ndarray) -> tuple[np.ndarray, int]:
    """Whether each of the next `n` rows is drawn, and the state after them."""
    lanes = np.array([state], np.uint64)
    for table in tables:
        if len(lanes) * LANE_ROWS >= n:
            break
        ahead = np.zeros_like(lanes)
        for byte in range(8):
            ahead ^= table[byte][(lanes >> np.uint64(8 * byte) & np.uint64(255)).astype(np.intp)]
        lanes = np.concatenate([lanes, ahead])
    lanes = lanes[:-(-n // LANE_ROWS)]
    taken, last = np.empty((LANE_ROWS, len(lanes)), bool), 0
    for row in range(LANE_ROWS):
        lanes = stepped(lanes)
        high = (lanes & np.uint64((1 << 26) - 1)) << np.uint64(27)
        lanes = stepped(lanes)
        number = (high + (lanes & np.uint64((1 << 27) - 1))).astype(float) * 2.0**-53
        taken[row] = number < rate
        if row == (n - 1) % LANE_ROWS:
            last = int(lanes[-1])
    return taken.T.ravel()[:n], last


# --- bins -----------------------------------------------------------------------------------------------


def thresholds(values: np.ndarray, rows: float, share: float, most: int) -> np.ndarray:
    """At most about `most` thresholds between the values of a column, of which `values` are a sample of `share` of
    `rows` rows (`findSplitsForContinuousFeature`): zeros count as often as they are expected."""
    found, counts = np.unique(values[values != 0], return_counts=True)
    if not len(found):
        return np.empty(0)
    counts, expected, seen = counts.astype(float), share * rows, int(counts.sum())
    if expected - seen > EPSILON * seen * 100:
        at = np.searchsorted(found, 0.0)
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, expected - seen)
    between = (found[:-1] + found[1:]) / 2.0
    if len(between) <= most:
        return between
    stride = expected / (most + 1)
    chosen, target, total = [], stride, counts[0]
    for k in range(1, len(found)):
        before, total = total, total + counts[k]
        if abs(before - target) < abs(total - target):
            chosen.append(between[k - 1])
            target += stride
    return np.array(chosen)


@dataclass(frozen=True)
class Bins:
    """Bins of each feature: thresholds of a number, None for a category, which is its own bin."""

    limits: list[np.ndarray | None]
    numbers: list[int]

    def of(self, feature: int, values: np.ndarray) -> np.ndarray:
        limits = self.limits[feature]
        if limits is not None:
            return np.searchsorted(limits, values).astype(np.uint8)
        found = values.astype(np.int64)
        if len(found) and not 0 <= found.min() <= found.max() < self.numbers[feature]:
            raise ValueError(f"feature {feature} has a category outside 0 to {self.numbers[feature] - 1}")
        return found.astype(np.uint8)


def find_bins(rows: DataFrame, vectors: str, arity: dict[int, int], max_bins: int, seed: int) -> tuple[Bins, int]:
    """Bins of the columns of a vector, from a sample where there are more than 10,000 rows, and the number of rows."""
    spark, context = rows.sparkSession, rows.sparkSession.sparkContext
    only = rows.select(F.col(vectors).alias("x"))
    n = only.count()
    if not n:
        raise ValueError("there are no rows to train on")
    most = min(max_bins, n)
    if max([*arity.values(), 0]) > most:
        raise ValueError(f"a feature has {max(arity.values())} categories, which is more than {most} bins")
    needed = max(most * most, 10_000)
    share = needed / n if needed < n else 1.0
    if share < 1:
        draw = context._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        few = only._jdf.rdd().sample(False, share, draw)  # by places in partitions, so the same rows as in Spark's fit
        only = DataFrame(spark._jsparkSession.createDataFrame(few, only._jdf.schema()), spark)
    sample = np.array([r[0] for r in only.select(vector_to_array("x")).collect()], float)
    sample = sample.reshape(-1, rows.select(F.size(vector_to_array(vectors))).first()[0])
    limits: list[np.ndarray | None] = []
    numbers: list[int] = []
    for feature in range(sample.shape[1]):
        own = None if feature in arity else thresholds(sample[:, feature], n, share, most - 1)
        limits.append(own)
        # a single category is no choice: as many bins as a number may have, of which one is used
        numbers.append(len(own) + 1 if own is not None else arity[feature] if arity[feature] > 1 else most)
    return Bins(limits, numbers), n


# --- rows as blocks -------------------------------------------------------------------------------------


#: Rows next to each other, as a tuple of arrays: number of their partition, sign of the label, bins (feature, row), margin
#: so far, and the target of the tree that is grown, NaN for rows it does not see.
Block = tuple
# Rows that a task takes, at most, where there are more of them than cores.
TASK_ROWS = 4_000_000


def binned(rows: DataFrame, n: int, label: str, vectors: str, bins: Bins) -> RDD:
    """The `n` rows as blocks, in their partitions and their order. A task takes several partitions, as a pass is short."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, columns, held = [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([np.concatenate(labels).tobytes()], pa.binary()),
                pa.array([np.concatenate(columns, axis=1).tobytes()], pa.binary())], names=["sign", "bins"])

        for batch in batches:
            own = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), float)
            x = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False), float).reshape(len(own), -1)
            if not np.isin(own, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            if not np.isfinite(x).all():
                raise ValueError("features must be finite numbers")
            if not len(own):
                continue
            labels.append((2 * own - 1).astype(np.int8))
            columns.append(np.array([bins.of(f, x[:, f]) for f in range(x.shape[1])], np.uint8))
            held += len(own)
            if held >= BLOCK_ROWS:
                yield block()
                labels, columns, held = [], [], 0
        if held:
            yield block()

    def unpack(partition: int, packed: Iterable) -> Iterator[Block]:
        for row in packed:
            sign = np.frombuffer(bytes(row["sign"]), np.int8)
            yield partition, sign, np.frombuffer(bytes(row["bins"]), np.uint8).reshape(-1, len(sign)), None, None

    packed = rows.select(F.col(label).cast("double"), vector_to_array(vectors)).mapInArrow(
        pack, "sign binary, bins binary")
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
    return packed.rdd.mapPartitionsWithIndex(unpack).coalesce(tasks)


@dataclass
class Node:
    """A node of a tree. `stats` are rows, sum and sum of squares of the target; `set_value` is the value of a leaf that
    stands for two."""

    index: int
    stats: tuple[float, float, float] | None
    impurity: float
    set_value: float | None = None
    gain: float | None = None
    feature: int | None = None
    goes_left: np.ndarray | None = None
    categories: list[float] | None = None
    left: Node | None = None
    right: Node | None = None

    @property
    def level(self) -> int:
        return self.index.bit_length() - 1

    @property
    def value(self) -> float:
        if self.set_value is not None:
            return self.set_value
        return self.stats[1] / self.stats[0] if self.stats[0] else 0.0


#: A node as it is sent to tasks: feature, which bins go left, left child, right child; or the value of a leaf.
Sent = tuple


def sent(node: Node, numbers: dict[int, int] | None = None) -> Sent:
    """A tree for tasks. With `numbers`, nodes with an index there end as their number, and what does not lead to one of
    them as None."""
    if numbers is not None and node.index in numbers:
        return (numbers[node.index],)
    if node.left is None:
        return (node.value,) if numbers is None else None
    left, right = sent(node.left, numbers), sent(node.right, numbers)
    if numbers is not None and left is None and right is None:
        return None
    return node.feature, node.goes_left, left, right


def ends(tree: Sent, bins: np.ndarray, rows: np.ndarray) -> Iterator[tuple[object, np.ndarray]]:
    """Where rows end in a tree: what the end holds, and the rows that come to it."""
    todo = [(tree, rows)]
    while todo:
        at, rows = todo.pop()
        if at is None or not len(rows):
            continue
        if len(at) == 1:
            yield at[0], rows
            continue
        feature, goes_left, left, right = at
        to_left = goes_left[bins[feature][rows]]
        todo.append((right, rows[~to_left]))
        todo.append((left, rows[to_left]))


def java_exp(x: np.ndarray) -> np.ndarray:
    """`exp` as fdlibm and so Java work it out: NumPy's can differ in the last bit, which decides between equal splits."""
    x = np.clip(x, -800.0, 800.0)  # 0 and infinity beyond
    size = np.abs(x)
    k = np.where(size < 1.5 * math.log(2), np.sign(x), np.trunc(1.44269504088896338700 * x + np.copysign(0.5, x)))
    k[size <= 0.5 * math.log(2)] = 0.0
    high, low = x - k * 6.93147180369123816490e-01, k * 1.90821492927058770002e-10
    r = high - low
    t = r * r
    c = r - t * (1.66666666666666019037e-01 + t * (-2.77777777770155933842e-03 + t * (
        6.61375632143793436117e-05 + t * (-1.65339022054652515390e-06 + t * 4.13813679705723846039e-08))))
    with np.errstate(over="ignore", under="ignore"):
        return np.ldexp(1.0 - ((low - r * c / (2.0 - c)) - high), k.astype(np.int32))


def targets(margin: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Negative gradient of the log loss."""
    return 4.0 * sign / (1.0 + java_exp(2.0 * sign * margin))


def advance(trees: list[tuple[Sent, float]], seed: int, rate: float, tables: np.ndarray | None,
            first: bool) -> Callable[[Iterable[Block]], Iterator[Block]]:
    """Adds trees to the margins and draws the rows of the next one. The first tree's target is the label."""
    def run(blocks: Iterable[Block]) -> Iterator[Block]:
        states: dict[int, int] = {}
        for partition, sign, bins, before, _ in blocks:
            n = len(sign)
            margin = np.zeros(n) if before is None else before.copy()
            every = np.arange(n)
            for tree, weight in trees:
                for value, rows in ends(tree, bins, every):
                    margin[rows] += weight * value
            target = sign.astype(float) if first else targets(margin, sign)
            if rate < 1:
                state = states.get(partition)
                taken, states[partition] = drawn(
                    first_state(seed + partition + 1) if state is None else state, n, rate, tables)
                target[~taken] = np.nan
            yield partition, sign, bins, margin, target

    return run


def binned_sum(before: np.ndarray, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values by bin, added one by one to those of earlier rows."""
    if before.any():
        at, values = np.concatenate([np.arange(len(before)), at]), np.concatenate([before, values])
    return np.bincount(at, values, len(before))


def histograms(tree: Sent, features: list[list[int]], width: int) -> Callable[[Iterable[Block]], Iterator[tuple]]:
    """Rows, sums and sums of squares of the target, by bin, of the features of each node of a group, for each partition.
    Within a partition rows are added up in their order, so that equal features have equal sums, as in Spark."""
    def run(blocks: Iterable[Block]) -> Iterator[tuple]:
        sums: dict[int, np.ndarray] = {}
        for partition, _, bins, _, targets in blocks:
            found = sums.setdefault(partition, np.zeros((len(features), len(features[0]), 3, width)))
            for number, rows in ends(tree, bins, np.flatnonzero(~np.isnan(targets))):
                target = targets[rows]
                squares = target * target
                for own, feature in zip(found[number], features[number]):
                    at = bins[feature][rows].astype(np.intp)
                    own[0] += np.bincount(at, minlength=width)
                    own[1] = binned_sum(own[1], at, target)
                    own[2] = binned_sum(own[2], at, squares)
        yield from sums.items()

    return run


def added_up(parts: RDD, partitions: int) -> np.ndarray:
    """The sum of the arrays of all partitions, in their order where the driver adds them up."""
    if partitions > DRIVER_SUMS:
        return parts.values().treeReduce(lambda a, b: a + b)
    first, *others = (sums for _, sums in sorted(parts.collect(), key=lambda part: part[0]))
    for other in others:
        first += other
    return first


# --- growing --------------------------------------------------------------------------------------------


def variance(n, total, squares):
    """Impurity of rows; of none, 0."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(n == 0, 0.0, (squares - total * total / n) / n)


@dataclass
class Grower:
    """Grows trees by Spark's rules from sums that `count` finds: `count(tree, features)` has the histograms of the
    features of the nodes that the tree ends in."""

    bins: Bins
    max_depth: int
    per_node: int
    min_rows: int
    min_gain: float
    memory: int
    random: Callable[[int], Callable[[], int]]
    count: Callable[[Sent, list[list[int]]], np.ndarray] = field(default=None)

    def grow(self, seed: int) -> Node:
        features = len(self.bins.numbers)
        next_long = self.random(seed) if self.per_node < features else None
        root = Node(1, None, 0.0)
        stack = [root]
        while stack:
            group, own, used = [], [], 0
            while stack and (used < self.memory or not used):
                chosen = reservoir(features, self.per_node, next_long()) if next_long else list(range(features))
                bytes_ = 8 * 3 * sum(self.bins.numbers[f] for f in chosen)
                if used + bytes_ <= self.memory or not used:
                    group.append(stack.pop())
                    own.append(chosen)
                used += bytes_
            found = self.count(sent(root, {node.index: k for k, node in enumerate(group)}), own)
            for node, chosen, sums in zip(group, own, found):
                self.split(node, chosen, sums)
                if node.left is not None and node.level + 1 < self.max_depth:
                    stack += [child for child in (node.left, node.right) if abs(child.impurity) >= EPSILON]
        return merged(root)

    def split(self, node: Node, features: list[int], sums: np.ndarray) -> None:
        best = None
        for feature, own in zip(features, sums):
            size = self.bins.numbers[feature]
            if size < 2:
                continue
            own, order = own[:, :size], np.arange(size)
            if self.bins.limits[feature] is None:  # categories by their mean, those without rows last
                with np.errstate(invalid="ignore", divide="ignore"):
                    order = np.argsort(np.where(own[0] == 0, np.finfo(float).max, own[1] / own[0]), kind="stable")
            below = np.cumsum(own[:, order], axis=1)
            left, right = below[:, :-1], below[:, -1:] - below[:, :-1]
            if node.stats is None:
                node.stats = tuple(float(v) for v in left[:, 0] + right[:, 0])
                node.impurity = float(variance(*node.stats))
            n_left, n_right = variance(*left), variance(*right)
            total = left[0] + right[0]
            with np.errstate(invalid="ignore", divide="ignore"):
                gain = node.impurity - left[0] / total * n_left - right[0] / total * n_right
                valid = (left[0] >= self.min_rows) & (right[0] >= self.min_rows) & (gain >= self.min_gain)
            gain = np.where(valid, gain, -np.finfo(float).max)
            k = int(np.argmax(gain))
            if best is None or gain[k] > best[0]:
                best = gain[k], feature, order[:k + 1], left[:, k], right[:, k], bool(valid[k])
        if node.stats is None:  # no feature has two bins
            node.stats = tuple(float(v) for v in sums[0].sum(axis=1))
        if best is None or not best[5]:
            node.impurity = -1.0  # as Spark marks a leaf for which no split is allowed
            return
        gain, feature, bins_left, left, right, _ = best
        if gain <= 0:
            return
        node.gain, node.feature = float(gain), feature
        node.goes_left = np.zeros(256, bool)
        node.goes_left[bins_left] = True
        node.categories = None if self.bins.limits[feature] is not None else [float(c) for c in bins_left]
        for side, stats, index in (("left", left, 2 * node.index), ("right", right, 2 * node.index + 1)):
            setattr(node, side, Node(index, tuple(float(v) for v in stats), float(variance(*stats))))

    def threshold(self, node: Node) -> float:
        return float(self.bins.limits[node.feature][int(node.goes_left.sum()) - 1])


def merged(node: Node) -> Node:
    """The tree without splits whose sides are leaves of the same value."""
    if node.left is None:
        return node
    node.left, node.right = merged(node.left), merged(node.right)
    if node.left.left is None and node.right.left is None and node.left.value == node.right.value:
        return Node(node.index, node.stats, node.impurity, node.left.value)
    return node


def boost(rows: RDD, partitions: int, grower: Grower, iterations: int, step: float, seed: int, rate: float) -> list[Node]:
    """Trees one after the other, of blocks of so many partitions. A tree's rows are made once, by its first pass, and kept until the next tree's are."""
    tables = jump_tables() if rate < 1 else None
    shared = rows.context.broadcast(tables)
    width = max(grower.bins.numbers)
    rows = rows.persist(StorageLevel.DISK_ONLY)
    trees: list[Node] = []
    added: list[tuple[Sent, float]] = []
    before = current = None
    try:
        for number in range(iterations):
            renew = current is None or number % RENEWED_AFTER == 0
            before, source = current, rows if renew else current
            run = drawing(added if renew else added[-1:], seed + number, rate, shared, number == 0)
            current = source.mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK)
            grower.count = lambda tree, features, of=current: added_up(
                of.mapPartitions(histograms(tree, features, width)), partitions)
            trees.append(grower.grow(seed + number))
            added.append((sent(trees[-1]), step if number else 1.0))
            if before is not None:
                before.unpersist()
    finally:
        for kept in (before, current, rows):
            if kept is not None:
                kept.unpersist()
        shared.unpersist()
    return trees


def drawing(trees: list[tuple[Sent, float]], seed: int, rate: float, tables, first: bool):
    """`advance` with tables that are broadcast."""
    return lambda blocks: advance(trees, seed, rate, tables.value, first)(blocks)


# --- Spark's model --------------------------------------------------------------------------------------


def java_tree(context: SparkContext, tree: Node, grower: Grower, features: int):
    """A tree as Spark's regression tree."""
    jvm, ml = context._jvm, context._jvm.org.apache.spark.ml
    nodes: list[Node] = []
    todo = [tree]
    while todo:
        node = todo.pop()
        nodes.append(node)
        if node.left is not None:
            todo += [node.right, node.left]
    # rows, sum, squares, rows without weights: all in one array, whose bytes are sent at once
    stats = np.array([[*node.stats, node.stats[0]] for node in nodes], ">f8")
    numbers = context._gateway.new_array(jvm.double, stats.size)
    jvm.java.nio.ByteBuffer.wrap(stats.tobytes()).asDoubleBuffer().get(numbers)
    aggregator = jvm.org.apache.spark.mllib.tree.impurity.VarianceAggregator()
    made = {}
    for k in range(len(nodes) - 1, -1, -1):  # children come after their parents
        node, calculator = nodes[k], aggregator.getCalculator(numbers, 4 * k)
        if node.left is None:
            made[id(node)] = ml.tree.LeafNode(node.value, node.impurity, calculator)
            continue
        if node.categories is None:
            split = ml.tree.ContinuousSplit(node.feature, grower.threshold(node))
        else:
            left = context._gateway.new_array(jvm.double, len(node.categories))
            for place, category in enumerate(node.categories):
                left[place] = category
            split = ml.tree.CategoricalSplit(node.feature, left, grower.bins.numbers[node.feature])
        made[id(node)] = ml.tree.InternalNode(node.value, node.impurity, node.gain, made.pop(id(node.left)),
                                              made.pop(id(node.right)), split, calculator)
    return ml.regression.DecisionTreeRegressionModel(made[id(tree)], features)


class GBTClassifier(classification.GBTClassifier):
    """Spark's estimator, fitted over binned columns. Settings that these do not cover are left to Spark's own fit."""

    def _covered(self) -> bool:
        return (self.getOrDefault("featureSubsetStrategy") in ("all", "auto", "sqrt")
                and not any(self.isDefined(p) and self.getOrDefault(p)
                            for p in ("weightCol", "validationIndicatorCol", "minWeightFractionPerNode"))
                and self.getOrDefault("maxBins") <= 256)

    def _fit_java(self, dataset: DataFrame):
        if not self._covered():
            return super()._fit_java(dataset)
        self._transfer_params_to_java()
        context, own = dataset.sparkSession.sparkContext, self._java_obj
        jvm = context._jvm
        vectors, seed = self.getFeaturesCol(), self.getSeed()
        categories = getattr(jvm.org.apache.spark.ml.util, "MetadataUtils$").__getattr__("MODULE$").getCategoricalFeatures(
            dataset._jdf.schema().apply(vectors))
        arity = {int(k): int(v) for k, v in dict(jvm.scala.jdk.javaapi.CollectionConverters.asJava(categories)).items()}
        bins, n = find_bins(dataset, vectors, arity, self.getMaxBins(), seed)
        features = len(bins.numbers)
        per_node = math.ceil(math.sqrt(features)) if self.getFeatureSubsetStrategy() == "sqrt" else features
        grower = Grower(bins, self.getMaxDepth(), per_node, self.getMinInstancesPerNode(), self.getMinInfoGain(),
                        self.getMaxMemoryInMB() * 1024 * 1024, lambda seed: jvm.java.util.Random(seed).nextLong)
        rows = binned(dataset, n, self.getLabelCol(), vectors, bins)
        found = boost(rows, dataset.rdd.getNumPartitions(), grower, self.getMaxIter(), self.getStepSize(), seed, self.getSubsamplingRate())
        trees = context._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(found))
        weights = context._gateway.new_array(jvm.double, len(found))
        empty = jvm.org.apache.spark.ml.param.ParamMap.empty()
        for k, tree in enumerate(found):
            trees[k] = own.copyValues(java_tree(context, tree, grower, features), empty)
            weights[k] = self.getStepSize() if k else 1.0
        model = jvm.org.apache.spark.ml.classification.GBTClassificationModel(own.uid(), trees, weights, features, 2)
        return own.copyValues(model.setParent(own), empty)
