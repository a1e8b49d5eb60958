"""Boosted trees over binned columns against Spark's own fit."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml import classification
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from claimwright.ml import boosting


def test_random_numbers_are_those_of_spark(spark):
    generator = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom
    for seed in (42, 0, -7, 2**40 + 5):
        theirs = generator(seed)
        assert list(itertools.islice(boosting.draws(seed), 50)) == [theirs.nextDouble() for _ in range(50)]


def test_rows_are_drawn_in_any_lots():
    tables, state, found = boosting.jump_tables(), boosting.first_state(9), []
    for n in (1000, 1, 31, 33, 2000, 935):
        taken, state = boosting.drawn(state, n, 0.8, tables)
        found += list(taken)
    assert found == [x < 0.8 for x in itertools.islice(boosting.draws(9), 4000)]


def test_exponential_is_that_of_java(spark):
    rng = np.random.default_rng(0)
    xs = np.concatenate([rng.normal(size=200) * 4, rng.normal(size=50) * 1e-3, [0.0, -0.0, 1e-10, 700.5, -700.5, 0.35, 1.04, -1.04]])
    java = spark.sparkContext._jvm.java.lang.StrictMath.exp
    assert list(boosting.java_exp(xs)) == [java(float(x)) for x in xs]
    assert list(boosting.java_exp(np.array([-1e9, 1e9]))) == [0.0, math.inf]


def test_sums_go_on_from_block_to_block():
    rng = np.random.default_rng(1)
    at, values = rng.integers(0, 4, 90), rng.normal(size=90)
    whole = np.bincount(at, values, 4)
    first = boosting.binned_sum(np.zeros(4), at[:31], values[:31])
    assert list(boosting.binned_sum(first, at[31:], values[31:])) == list(whole)


@pytest.fixture(scope="module")
def rows(spark):
    """Numbers with many and few values and zeros, a constant, and categories; in partitions of which one is empty."""
    rng = np.random.default_rng(5)
    n = 14_000
    kind, code = rng.integers(0, 5, n), rng.integers(0, 2, n)
    x, y = rng.normal(size=n).round(4), np.where(rng.random(n) < 0.6, 0.0, rng.random(n).round(3))
    few = rng.integers(-2, 3, n).astype(float)
    odds = 1.5 * x * (kind == 3) - y + 0.3 * few * code - 0.4 + rng.normal(size=n)
    table = [(float(o > 0), float(a), float(b), float(c), 7.0, float(k), float(d))
             for o, a, b, c, k, d in zip(odds, x, y, few, kind, code)]
    frame = spark.createDataFrame(table, "label double, x double, y double, few double, same double, kind double, code double")
    nominal = {"ml_attr": {"type": "nominal", "vals": ["a", "b", "c", "d", "e"], "name": "kind"}}
    frame = frame.withColumn("kind", F.col("kind").alias("kind", metadata=nominal))
    made = VectorAssembler(inputCols=frame.columns[1:], outputCol="features").transform(frame)
    return made.repartitionByRange(5, F.least("x", F.lit(2.0))).unionByName(made.limit(0)).cache()


def nodes(model):
    """Every node in order: feature, where it splits, value, rows, impurity, gain."""
    found = []

    def walk(node):
        leaf = node.getClass().getSimpleName() == "LeafNode"
        split = None if leaf else node.split()
        found.append((None if leaf else split.featureIndex(),
                      None if leaf else list(split.leftCategories()) if split.getClass().getSimpleName() == "CategoricalSplit"
                      else split.threshold(),
                      node.prediction(), node.impurityStats().count(), node.impurity(), 0.0 if leaf else node.gain()))
        if not leaf:
            walk(node.leftChild())
            walk(node.rightChild())

    for tree in model._java_obj.trees():
        walk(tree.rootNode())
    return found


@pytest.mark.parametrize("params", [
    dict(maxIter=5, maxDepth=4, subsamplingRate=0.7, featureSubsetStrategy="sqrt", seed=42),
    dict(maxIter=3, maxDepth=3, subsamplingRate=1.0, minInstancesPerNode=400, seed=3, maxBins=9),
    dict(maxIter=2, maxDepth=5, subsamplingRate=0.9, minInfoGain=0.01, seed=-1),
])
def test_trees_are_those_of_spark(rows, params):
    theirs = classification.GBTClassifier(**params).fit(rows)
    own = boosting.GBTClassifier(**params).fit(rows)
    assert own.numFeatures == theirs.numFeatures and own.treeWeights == theirs.treeWeights
    assert own.getMaxIter() == params["maxIter"] and own.uid.startswith("GBTClassifier_")
    a, b = nodes(theirs), nodes(own)
    assert [n[:2] for n in a] == [n[:2] for n in b] and [n[3] for n in a] == [n[3] for n in b]
    assert any(isinstance(n[1], list) for n in a) and any(isinstance(n[1], float) for n in a)
    for mine, other in zip(b, a):
        assert all(math.isclose(p, q, rel_tol=1e-9, abs_tol=1e-12) for p, q in zip(mine[2:], other[2:]))


def test_small_and_lopsided_tables(spark):
    """A table of a few rows, one class alone, equal rows with both labels."""
    for labels in ([0, 1, 1], [1, 1, 1, 1], [0, 1, 0, 1, 1]):
        frame = spark.createDataFrame([(float(y), Vectors.dense(k % 2, 4.0)) for k, y in enumerate(labels)],
                                      ["label", "features"])
        theirs = classification.GBTClassifier(maxIter=3, maxDepth=2, seed=1).fit(frame)
        own = boosting.GBTClassifier(maxIter=3, maxDepth=2, seed=1).fit(frame)
        got = [(n[0], n[1], n[3], round(n[2], 9)) for n in nodes(own)]
        assert got == [(n[0], n[1], n[3], round(n[2], 9)) for n in nodes(theirs)]


def test_what_spark_refuses_is_refused(spark):
    for row in ((2.0, Vectors.dense(1.0)), (None, Vectors.dense(1.0)), (1.0, Vectors.dense(float("inf")))):
        frame = spark.createDataFrame([(1.0, Vectors.dense(2.0)), row], ["label", "features"])
        with pytest.raises(Exception):
            boosting.GBTClassifier(maxIter=1).fit(frame)
    with pytest.raises(ValueError):
        boosting.GBTClassifier(maxIter=1).fit(frame.limit(0))


def test_other_settings_go_to_spark(spark, rows):
    weighted = rows.withColumn("w", F.lit(2.0))
    own = boosting.GBTClassifier(maxIter=1, maxDepth=1, weightCol="w", seed=1)
    assert not own._covered() and own.fit(weighted).getNumTrees == 1


def test_a_pass_makes_no_more_tasks_than_cores(rows):
    many = rows.repartition(40)
    bins, n = boosting.find_bins(many, "features", {4: 5}, 32, 1)
    blocks = boosting.binned(many, n, "label", "features", bins)
    assert blocks.getNumPartitions() == rows.sparkSession.sparkContext.defaultParallelism
    found = blocks.collect()
    assert sorted({b[0] for b in found}) == list(range(40)) and sum(len(b[1]) for b in found) == n
