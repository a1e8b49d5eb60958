"""Training, evaluation and explanation with small models on the smallest tables."""

import hashlib
import math
from datetime import datetime
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from claimwright.ml import attribution, training, trees
from claimwright.operators import evaluation
from claimwright.schema import FEATURES

RUN_TS = datetime(2024, 1, 8)


@pytest.fixture(scope="module")
def split_sets(features):
    train, test = training.train_test(features)
    return train.cache(), test.cache()


@pytest.fixture(scope="module")
def gbt_path(split_sets, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "gbt")
    training.save_model(training.train_gbt(split_sets[0], maxIter=6, maxDepth=4), path)
    return path


@pytest.fixture(scope="module")
def scored(split_sets, gbt_path):
    return PipelineModel.load(gbt_path).transform(split_sets[1]).cache()


def test_no_claim_is_on_both_sides(features, split_sets):
    train, test = split_sets
    assert train.join(test, "claim_id", "left_semi").count() == 0
    assert train.select("claim_id").distinct().count() + test.count() <= features.count()
    assert train.count() > train.select("claim_id").distinct().count()  # oversampled
    assert test.count() == test.select("claim_id").distinct().count()  # and this not


def test_split_after_oversampling_leaks(features):
    train, test = training.train_test(features, split_first=False)
    assert train.join(test, "claim_id", "left_semi").count() > 0


def test_unusable_rows(features):
    holes = features.limit(100).withColumn("bmi", F.when(F.col("children") > 0, F.col("bmi")))
    row = training.unusable_rows(holes).first()
    assert row["rows"] == 100 and row["skipped_rows"] == holes.filter("bmi is null").count() > 0
    assert training.assembler().transform(holes).count() == 100 - row["skipped_rows"]


def test_reloaded_model_scores_alike(scored, split_sets, gbt_path, tmp_path):
    again = training.save_model(PipelineModel.load(gbt_path), str(tmp_path / "copy"))
    again = training.save_model(again, str(tmp_path / "copy"))  # overwrites
    key = ["claim_id", "probability"]
    assert sorted(map(repr, again.transform(split_sets[1]).select(key).collect())) == sorted(
        map(repr, scored.select(key).collect()))


def test_metrics(scored):
    metrics = {r["metric_name"]: r["metric_value"] for r in training.evaluate(scored, "gbt", RUN_TS).collect()}
    assert list(metrics) == ["auc_roc", "auc_pr", "f1", "precision", "recall", "accuracy"]
    spark_names = {"f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall", "accuracy": "accuracy"}
    for ours, theirs in spark_names.items():
        exact = MulticlassClassificationEvaluator(labelCol="label", metricName=theirs).evaluate(scored)
        assert metrics[ours] == round(exact, 4)
    assert 0.9 < metrics["auc_roc"] <= 1.0


def test_metrics_of_a_class_never_predicted(spark):
    rows = spark.createDataFrame([(0, 0.0), (0, 0.0), (1, 0.0)], "label int, prediction double")
    row = evaluation.class_metrics(rows).first()
    for ours, theirs in {"f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"}.items():
        exact = MulticlassClassificationEvaluator(labelCol="label", metricName=theirs).evaluate(rows)
        assert math.isclose(row[ours], exact)
    assert evaluation.confusion_matrix(rows).first().asDict() == {"tp": 0, "tn": 2, "fp": 0, "fn": 1}
    table = {r["actual"]: (r["Predicted_Normal"], r["Predicted_Fraud"])
             for r in evaluation.confusion_table(rows).collect()}
    assert table == {"Actual_Normal": (2, 0), "Actual_Fraud": (1, 0)}


def test_auc_equals_pair_counting(spark, tmp_path):
    rows = [(i % 3 == 0, float((i * 7) % 13)) for i in range(60)]
    frame = spark.createDataFrame([(int(a), b) for a, b in rows], "label int, s double")
    pairs = [(p, n) for a, p in rows if a for b, n in rows if not b]
    want = sum((p > n) + 0.5 * (p == n) for p, n in pairs) / len(pairs)
    assert math.isclose(evaluation.exact_auc(frame, "s", str(tmp_path / "ranks")).first()["auc_roc"], want)


def test_prediction_sample(scored):
    sample = training.prediction_sample(scored, 20)
    assert sample.columns == [*training.SAMPLE_COLUMNS, "prob_fraud"] and len(sample.columns) == 13
    rows = sample.collect()
    assert len(rows) == 20 and all(0 <= r["prob_fraud"] <= 1 for r in rows)
    by_hash = sorted((r["claim_id"] for r in scored.collect()), key=lambda c: hashlib.md5(c.encode()).hexdigest())
    assert [r["claim_id"] for r in rows] == by_hash[:20]


def pair_auc(rows):
    fraud, normal = ([s for label, s in rows if label == k] for k in (1, 0))
    won = sum((a > b) + (a == b) / 2 for a in fraud for b in normal)
    return won / (len(fraud) * len(normal))


def test_exact_areas_of_groups(spark, tmp_path):
    """Ties over parts, groups of very different sizes, a group with one class, a null group."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rng = np.random.default_rng(2)
    rows = [(("a" if k % 3 else "b") if k % 50 else None, int(rng.random() < 0.3), float(rng.integers(0, 40)))
            for k in range(900)] + [("one", 1, 0.5), ("one", 1, 0.7)]
    frame = spark.createDataFrame(rows, "g string, label int, s double").repartition(7)
    got = {r["g"]: r for r in evaluation.exact_auc(frame, "s", str(tmp_path / "ranks"), "g").collect()}
    assert got["one"]["auc_roc"] is None and got["one"]["auc_pr"] == 1.0
    for g in ("a", "b", None):
        assert math.isclose(got[g]["auc_roc"], pair_auc([r[1:] for r in rows if r[0] == g]), rel_tol=1e-12)
        own = frame.where(F.col("g").eqNullSafe(F.lit(g)))
        theirs = BinaryClassificationEvaluator(
            labelCol="label", rawPredictionCol="s", metricName="areaUnderPR", numBins=0).evaluate(own)
        assert math.isclose(got[g]["auc_pr"], theirs, rel_tol=1e-12)
    nothing = evaluation.exact_auc(frame.where("false"), "s", str(tmp_path / "none")).first()
    assert tuple(nothing) == (None, None)


def test_ranks_do_not_gather_a_hot_score(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 2).cast("int").alias("label"),
                                    F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 1000).alias("s"))
    ranks = evaluation.score_ranks(rows, "s", str(tmp_path / "ranks")).collect()
    hot = [r for r in ranks if r["score"] == 0.5]
    assert len(ranks) == len({r["score"] for r in ranks}) and len(hot) == 1 and hot[0]["p"] + hot[0]["n"] >= 334
    assert all(r["p_above"] == sum(q["p"] for q in ranks if q["score"] > r["score"]) for r in ranks)


def test_margin_as_expression(spark, scored, gbt_path):
    margin = trees.margin_expression(trees.tree_nodes(spark, gbt_path), FEATURES)
    gap = F.abs(margin - vector_to_array("rawPrediction")[1])
    row = scored.select(gap.alias("gap")).agg(F.max("gap"), F.count("gap")).first()
    assert row[0] < 1e-12 and row[1] == scored.count()
    plan = scored.select(*FEATURES).select(margin.alias("m"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_gradient_is_zero_at_the_optimum_only(split_sets):
    model = training.train_lr(split_sets[0], tol=1e-10, maxIter=500)
    rows = training.lr_gradient(split_sets[0], model).collect()
    assert [r["term"] for r in rows] == ["intercept", *FEATURES]
    assert max(abs(r["gradient"]) for r in rows) < 1e-6
    early = training.train_lr(split_sets[0], maxIter=1)
    assert max(abs(r["gradient"]) for r in training.lr_gradient(split_sets[0], early).collect()) > 1e-3


def deep_tree(depth, n_features, rng):
    """A chain-like tree in which features come back on a path, as rows of a node relation."""
    nodes, todo = [], [(0, 0, 2**40)]
    number = 1
    while todo:
        node_id, level, n = todo.pop()
        row = dict(tree_id=0, node_id=node_id, prediction=float(rng.normal()), n_rows=n, left_child=None, right_child=None,
                   feature_index=None, threshold=None, left_categories=None, tree_weight=0.5)
        if level < depth:
            left = int(n * rng.uniform(0.3, 0.7))
            row.update(left_child=number, right_child=number + 1, feature_index=int(rng.integers(n_features)),
                       threshold=float(rng.normal()))
            # one side goes on to the full depth, the other stops soon
            todo += [(number, level + 1, left), (number + 1, max(level + 1, depth - 1), n - left)]
            number += 2
        nodes.append(row)
    return nodes


class Relation:
    """Rows that are collected like a DataFrame's."""

    def __init__(self, rows):
        self.rows = rows

    def collect(self):
        return self.rows


@pytest.mark.parametrize("depth, n_features, rows", [(16, 8, 3), (16, 16, 2), (3, 4, 40), (1, 2, 5)])
def test_deep_paths_equal_brute_force(depth, n_features, rows):
    rng = np.random.default_rng(depth * n_features)
    nodes = deep_tree(depth, n_features, rng)
    if depth == 16:
        ensemble, _ = trees.load_ensemble(Relation(nodes))
        assert max(len(leaf.features) for leaf in ensemble[0].leaves) > 6
    ensemble, base = trees.load_ensemble(Relation(nodes))
    x = rng.normal(size=(rows, n_features))
    got = trees.attribute(ensemble, x)
    by_id = {n["node_id"]: n for n in nodes}

    def margin(row, node_id=0):
        n = by_id[node_id]
        if n["left_child"] is None:
            return n["prediction"] * n["tree_weight"]
        return margin(row, n["left_child"] if row[n["feature_index"]] <= n["threshold"] else n["right_child"])

    assert np.allclose(base + got.sum(1), [margin(row) for row in x], atol=1e-10)
    if n_features <= 8:
        assert np.allclose(got, brute_force_shapley(x, nodes), atol=1e-10)


def test_paths_are_worked_out_once_not_for_each_batch(monkeypatch):
    rng = np.random.default_rng(7)
    nodes = deep_tree(5, 6, rng)
    ensemble, _ = trees.load_ensemble(Relation(nodes))
    tables = trees.tabulate(ensemble)
    assert sum(len(found) for _, found, _ in tables) < len(ensemble[0].leaves) and not any(left for *_, left in tables)
    x = rng.normal(size=(trees.BLOCK_ROWS + 50, 6))
    x[3, 2] = np.nan  # a missing value goes right
    # leaf by leaf, as trees beyond the tables' bytes are, and in branches of any size
    by_leaf = trees.attribute_columns(trees.tabulate(ensemble, table_bytes=0), list(x.T))
    few = trees.attribute_columns(trees.tabulate(ensemble, most=3), list(x.T))
    monkeypatch.setattr(trees, "shares", None)  # no row needs it any more
    whole = trees.attribute_columns(tables, list(x.T))
    assert np.allclose(whole, by_leaf, atol=1e-12) and np.allclose(few, by_leaf, atol=1e-12)
    assert np.allclose(whole[:, :5], brute_force_shapley(x[:5], nodes).T, atol=1e-10)


def test_dependence_bins_of_missing_and_constant_values(spark):
    rows = [(float(k % 10), 1.0, k / 10) for k in range(50)] + [(None, 1.0, 5.0)]
    frame = spark.createDataFrame(rows, "u double, v double, shap_u double").withColumn("shap_v", -F.col("shap_u"))
    got = {(r["feature"], r["bin"]): r for r in attribution.dependence_bins(frame, ["u", "v"], bins=5).collect()}
    assert set(got) == {*(("u", k) for k in range(1, 6)), ("u", None), ("v", 1)}
    assert [got["u", k]["n"] for k in range(1, 6)] == [10] * 5 and got["u", None]["n"] == 1
    assert got["u", None]["avg_value"] is None and got["u", None]["max_attribution"] == 5.0
    assert got["u", 5]["avg_value"] == 8.5 and got["v", 1]["n"] == 51 and got["v", 1]["min_attribution"] == -5.0
    assert attribution.dependence_bins(frame.where("false"), ["u", "v"]).collect() == []


def test_cross_validation(split_sets):
    found = training.cross_validate_gbt(
        split_sets[0], grid={"maxIter": [2, 3], "maxDepth": [2]}, folds=2, parallelism=2)
    results = training.cv_results(found)
    assert [r[:2] for r in results] == [(2, 2), (3, 2)] and sum(r[3] for r in results) == 1
    # every row has one score for each combination, and the areas are those of counted pairs
    scores = split_sets[0].sparkSession.read.parquet(found.scores).collect()
    claims = sorted(r["claim_id"] for r in split_sets[0].select("claim_id").collect())
    for k, auc in enumerate(found.auc):
        own = [r for r in scores if r["combination"] == k]
        assert sorted(r["claim_id"] for r in own) == claims
        folds = [[(r["label"], r["score"]) for r in own if r["fold"] == fold] for fold in (0, 1)]
        assert math.isclose(auc, sum(map(pair_auc, folds)) / 2, rel_tol=1e-12)
    assert found.best.transform(split_sets[1]).select("prediction").count() > 0


def test_a_shorter_fit_is_the_beginning_of_a_longer_one(split_sets):
    rows = training.assembler().transform(training.spread(split_sets[0].select("label", *FEATURES))).persist()
    long, short = (training.gbt(maxIter=n, maxDepth=3).fit(rows) for n in (6, 4))
    cut = training.first_trees(long, 4)
    assert cut.getNumTrees == 4 and list(cut.treeWeights) == list(short.treeWeights)
    assert [t.toDebugString.split("\n", 1)[1] for t in cut.trees] == [t.toDebugString.split("\n", 1)[1] for t in short.trees]
    both = cut.transform(rows).select("rawPrediction").collect(), short.transform(rows).select("rawPrediction").collect()
    assert both[0] == both[1]
    rows.unpersist()


def test_combinations_share_fits():
    fits = training.shared_fits([{"maxIter": a, "maxDepth": b} for a in (60, 80) for b in (4, 5)], stepSize=0.2)
    assert [takers for _, takers in fits] == [{0: 60, 2: 80}, {1: 60, 3: 80}]
    assert all(fit["maxIter"] == 80 and fit["stepSize"] == 0.2 for fit, _ in fits) and fits[0][0]["maxDepth"] == 4


def test_fits_side_by_side_have_their_own_properties(spark, split_sets, monkeypatch):
    """With one copy of the local properties in several threads, an execution loses its id to another's end."""
    seen, gbt = [], training.gbt

    class Watched:
        def __init__(self, **params):
            self.own = gbt(**params)

        def fit(self, rows):
            context = spark.sparkContext
            seen.append(context._jvm.System.identityHashCode(context._jsc.sc().getLocalProperties()))
            return self.own.fit(rows)

    monkeypatch.setattr(training, "gbt", Watched)
    training.cross_validate_gbt(split_sets[0], grid={"maxIter": [2], "maxDepth": [1, 2, 3]}, folds=2)
    assert len(seen) == 7 and len(set(seen[:6])) == 6


def test_partitions_in_training_follow_cores_and_rows(spark, split_sets, monkeypatch):
    monkeypatch.setattr(training, "ROWS_PER_PARTITION", 10)
    rows = spark.range(0, 300, 1, 2)
    assert training.spread(rows).rdd.getNumPartitions() == 30
    monkeypatch.setattr(training, "ROWS_PER_PARTITION", 1000)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert training.spread(rows).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_explained_model_parameters(split_sets, monkeypatch):
    monkeypatch.setitem(training.EXPLAINED_GBT_PARAMS, "maxIter", 2)
    model = training.train_explained_gbt(split_sets[0]).stages[-1]
    assert model.getOrDefault("minInstancesPerNode") == 20 and model.getOrDefault("stepSize") == 0.08


def test_tree_relation(spark, gbt_path):
    nodes = trees.tree_nodes(spark, gbt_path)
    assert nodes.select("tree_id").distinct().count() == 6
    inner = nodes.filter("left_child is not null")
    assert inner.filter("(threshold is null) = (left_categories is null)").count() == 0
    assert inner.count() * 2 + 6 == nodes.count()
    assert inner.filter("left_categories is not null").count() > 0  # categorical splits are exercised


def brute_force_shapley(rows, nodes):
    """Path-dependent Shapley values by enumerating coalitions of all features on each tree."""
    by_tree = {}
    for n in nodes:
        by_tree.setdefault(n["tree_id"], {})[n["node_id"]] = n

    def value(tree, x, known, node_id=0):
        n = tree[node_id]
        if n["left_child"] is None:
            return n["prediction"] * n["tree_weight"]
        left, right = n["left_child"], n["right_child"]
        f = n["feature_index"]
        if f in known:
            go = x[f] in n["left_categories"] if n["left_categories"] is not None else x[f] <= n["threshold"]
            return value(tree, x, known, left if go else right)
        share = tree[left]["n_rows"] / n["n_rows"]
        return share * value(tree, x, known, left) + (1 - share) * value(tree, x, known, right)

    phi = np.zeros_like(rows)
    for tree in by_tree.values():
        used = sorted({n["feature_index"] for n in tree.values() if n["feature_index"] is not None})
        for r, x in enumerate(rows):
            worth = {s: value(tree, x, set(s)) for k in range(len(used) + 1) for s in combinations(used, k)}
            for f in used:
                others = [u for u in used if u != f]
                for k in range(len(others) + 1):
                    weight = math.factorial(k) * math.factorial(len(used) - k - 1) / math.factorial(len(used))
                    for s in combinations(others, k):
                        phi[r, f] += weight * (worth[tuple(sorted((*s, f)))] - worth[s])
    return phi


def test_attributions_equal_brute_force(spark, split_sets, tmp_path):
    path = str(tmp_path / "small")
    training.save_model(training.train_gbt(split_sets[0], maxIter=3, maxDepth=3), path)
    rows = split_sets[1].orderBy("claim_id").limit(12)
    explained = attribution.tree_shap(rows, path).select([f"shap_{f}" for f in FEATURES]).collect()
    x = np.array(rows.select(*FEATURES).collect(), dtype=float)
    want = brute_force_shapley(x, trees.tree_nodes(spark, path).collect())
    assert np.allclose(np.array(explained), want, atol=1e-12)


def test_attributions_add_up_to_the_margin(scored, gbt_path):
    total = F.col("base_value") + sum(F.col(f"shap_{f}") for f in FEATURES)
    gap = attribution.tree_shap(scored, gbt_path).agg(
        F.max(F.abs(total - vector_to_array("rawPrediction")[1]))).first()[0]
    assert gap < 1e-9


def test_explanation_summaries(scored, gbt_path):
    explained = attribution.tree_shap(scored, gbt_path).cache()
    importance = attribution.global_importance(explained)
    rows = importance.collect()
    assert len(rows) == 21 and [r[1] for r in rows] == sorted((r[1] for r in rows), reverse=True)
    best = [r["feature"] for r in attribution.top_features(importance, 3).collect()]
    assert best == [r["feature"] for r in rows[:3]]
    bins = attribution.dependence_bins(explained, best, bins=5).collect()
    for f in best:
        assert sum(r["n"] for r in bins if r["feature"] == f) == explained.count()
    assert max(r["bin"] for r in bins) <= 5 and min(r["bin"] for r in bins) == 1
    assert attribution.dependence_pairs(explained, best[0]).count() == explained.count()
    sample = attribution.attribution_sample(explained, 10)
    assert sample.count() == 10 and len(sample.columns) == 44


def test_linear_attributions(split_sets):
    model = training.train_lr(split_sets[0], maxIter=5)
    weights = attribution.linear_weights(model)
    test = split_sets[1]
    explained = attribution.linear_shap(test, weights)
    total = sum(F.col(f"shap_{f}") for f in FEATURES)
    scored = model.transform(explained).withColumn("margin", vector_to_array("rawPrediction")[1])
    low, high = scored.agg(F.min(F.col("margin") - total), F.max(F.col("margin") - total)).first()
    assert math.isclose(low, high, abs_tol=1e-8)  # attributions explain all but the mean margin


def test_linear_attribution_of_integers(spark):
    rows = spark.createDataFrame([(1,), (3,)], "age int")
    got = attribution.linear_shap(rows, {"age": 2.0}).orderBy("age").collect()
    assert [r["shap_age"] for r in got] == [-2.0, 2.0]


def test_fill(spark):
    rows = spark.createDataFrame([(None, None), (2, 0.5)], "age int, bmi double")
    assert attribution.fill_features(rows, ["age", "bmi"]).collect() == [(0, 0.0), (2, 0.5)]


def test_memory_is_left_to_the_passes(split_sets, monkeypatch):
    """The rows that an estimator reads a few times, before it holds its own form of them, are kept on disk."""
    levels = []

    class Watched:
        def __init__(self, stages):
            pass

        def fit(self, rows):
            levels.append(rows.storageLevel)

    monkeypatch.setattr(training, "Pipeline", Watched)
    training.train_lr(split_sets[0])
    assert levels[0].useDisk and not levels[0].useMemory


def test_dependence_stores_what_it_reads(spark, features, monkeypatch, tmp_path):
    from catalog import inputs, queries

    monkeypatch.setattr(inputs, "_stored", {})
    monkeypatch.setattr(inputs, "new_dir", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(queries, "_explained", lambda spark, sf_dir: attribution.linear_shap(
        features, queries.LINEAR_WEIGHTS).withColumn("other", F.lit(1)))
    row = queries.dependence_rows(spark, "somewhere").first()
    assert row["n_features"] == 10 and row["fewest"] == row["most"] == features.count()
    stored = spark.read.parquet(next(iter(inputs._stored.values())))
    assert stored.columns == [*FEATURES, *[f"shap_{f}" for f in FEATURES]]
