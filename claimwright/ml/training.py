"""Training, scoring and evaluating the fraud classifiers."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.util import inheritable_thread_target

from claimwright.ml.boosting import GBTClassifier
from claimwright.operators.evaluation import METRIC_NAMES, class_metrics, exact_auc, with_label
from claimwright.operators.sampling import SEED, first_by_hash, hash_split, oversample_poisson, uniform
from claimwright.schema import FEATURES
from claimwright.session import scratch_dir

# Model parameters, the search grid and the prediction sample.
GBT_PARAMS = dict(maxIter=80, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="sqrt", seed=SEED)
GBT_GRID = {"maxIter": [60, 80], "maxDepth": [4, 5]}
CV_FOLDS = 3
LR_PARAMS = dict(maxIter=150, regParam=0.01, elasticNetParam=0.0)
EXPLAINED_GBT_PARAMS = dict(
    maxIter=120, maxDepth=4, stepSize=0.08, subsamplingRate=0.85, minInstancesPerNode=20, seed=SEED
)
SAMPLE_COLUMNS = [
    "claim_id", "age", "bmi", "children", "claim_amount", "region", "procedure_code", "provider_id",
    "days_since_last_claim", "anomaly_score_proxy", "label", "prediction",
]
SAMPLE_ROWS = 600
# Rows of a partition in training, at most; what is smaller has two partitions for each core.
ROWS_PER_PARTITION = 500_000

MODELS = ("gbt", "logistic_regression")


def assembler() -> VectorAssembler:
    """Feature vector; rows with a null or NaN feature are left out."""
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip")


def unusable_rows(features: DataFrame) -> DataFrame:
    """How many rows the assembler will leave out, and of how many."""
    whole = F.lit(True)
    for name in FEATURES:
        whole = whole & F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double"))
    return features.agg(F.count("*").alias("rows"), F.count_if(~whole).alias("skipped_rows"))


def train_test(features: DataFrame, *, oversample: Callable[[DataFrame], DataFrame] = oversample_poisson,
               split_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """Training and test rows with `label`.

    The split is by claim id and comes before oversampling, so no copy of a training row is tested on.
    `split_first=False` oversamples first and splits at random, for comparison with results made that way."""
    labelled = with_label(features)
    if not split_first:
        train, test = oversample(labelled).randomSplit([0.8, 0.2], seed=SEED)
        return train, test
    split = hash_split(labelled)
    side = {name: split.filter(F.col("split") == name).drop("split") for name in ("train", "test")}
    return oversample(side["train"]), side["test"]


def gbt(**params) -> GBTClassifier:
    return GBTClassifier(labelCol="label", featuresCol="features", **{**GBT_PARAMS, **params})


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt evenly over partitions as training passes over them hundreds of times: two for each core, more where
    one would hold more than ROWS_PER_PARTITION. Their number follows the cores and the rows, not
    `spark.sql.shuffle.partitions`, which cached rows keep whatever their size."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(2 * cores, -(-rows.count() // ROWS_PER_PARTITION)))


def _fit(estimator, train: DataFrame) -> PipelineModel:
    """Fit on the needed columns only. Copies of fraud rows sit beside their originals, so rows are spread first: one
    shuffle against hundreds of passes over uneven partitions.

    The estimators read these rows a few times and hold their own form of them, which they pass over hundreds of
    times: memory is left to that, and the rows are kept on disk (recomputed if an executor is lost)."""
    needed = spread(train.select("label", *FEATURES)).persist(StorageLevel.DISK_ONLY)
    try:
        return Pipeline(stages=[assembler(), estimator]).fit(needed)
    finally:
        needed.unpersist()


def train_gbt(train: DataFrame, **params) -> PipelineModel:
    """Gradient-boosted trees with the fixed parameters, or with `params` instead."""
    return _fit(gbt(**params), train)


def train_explained_gbt(train: DataFrame) -> PipelineModel:
    """The smaller ensemble meant for explanation."""
    estimator = GBTClassifier(labelCol="label", featuresCol="features", **EXPLAINED_GBT_PARAMS)
    return _fit(estimator, train)


def train_lr(train: DataFrame, **params) -> PipelineModel:
    """Logistic regression baseline."""
    estimator = LogisticRegression(labelCol="label", featuresCol="features", **{**LR_PARAMS, **params})
    return _fit(estimator, train)


def with_fold(rows: DataFrame, folds: int = CV_FOLDS, key: str = "claim_id") -> DataFrame:
    """Adds `fold`; all rows of a claim are in one. The hash has a seed of its own, so folds do not follow the split."""
    return rows.withColumn("fold", F.floor(uniform(key, SEED + 1) * folds).cast("int"))


@dataclass(frozen=True)
class GridSearch:
    """Mean AUC over the folds of each combination, in grid order, the first best one fitted on all training rows, and
    where the scores of all rows lie that a model gave which had not seen them (`combination`, `fold`, `claim_id`,
    `label`, `score`)."""

    combinations: list[dict]
    auc: list[float]
    best: PipelineModel
    scores: str


def shared_fits(combinations: list[dict], **params) -> list[tuple[dict, dict[int, int]]]:
    """Fits that serve all combinations: parameters, and how many trees each combination (by number) takes of the fit.

    Combinations that differ in `maxIter` alone share one: a tree depends on those before it and the seed only, so a
    shorter fit is the beginning of a longer one."""
    fits: list[tuple[dict, dict[int, int]]] = []
    for number, combination in enumerate(combinations):
        other = {**GBT_PARAMS, **params, **combination}
        trees = other.pop("maxIter")
        for shared, takers in fits:
            if {k: v for k, v in shared.items() if k != "maxIter"} == other:
                shared["maxIter"] = max(shared["maxIter"], trees)
                takers[number] = trees
                break
        else:
            fits.append(({**other, "maxIter": trees}, {number: trees}))
    return fits


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first `n` trees."""
    if n >= model.getNumTrees:
        return model
    context, stored = SparkContext.getOrCreate(), model._java_obj
    jvm, array = context._jvm, context._gateway.new_array
    trees, weights = array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n), array(jvm.double, n)
    for k in range(n):
        trees[k], weights[k] = stored.trees()[k], stored.treeWeights()[k]
    return GBTClassificationModel(
        jvm.org.apache.spark.ml.classification.GBTClassificationModel(stored.uid(), trees, weights))


def out_of_fold(train: DataFrame, combinations: list[dict], folds: int, path: str, parallelism: int,
                oversample: Callable[[DataFrame], DataFrame], **params) -> DataFrame:
    """Each row scored, for each combination, by the one model that has not seen its claim; stored.

    Folds are drawn by claim, and only the part that is fitted on is oversampled. Several fits run at a time, of one fold
    or of several, each of them distributed; rows are kept on disk, memory is left to the fits."""
    fits = shared_fits(combinations, **params)

    def score(fitted_on: DataFrame, held: DataFrame, fold: int, fit: dict, takers: dict[int, int]) -> None:
        model = gbt(**fit).fit(fitted_on)
        for number, trees in takers.items():
            first_trees(model, trees).transform(held).select(
                "claim_id", "label", vector_to_array("rawPrediction")[1].alias("score")).write.mode(
                "overwrite").parquet(f"{path}/combination={number}/fold={fold}")

    work, kept = [], []
    for fold in range(folds):
        fitted_on = oversample(train.filter(F.col("fold") != fold)).select("label", "features").persist(
            StorageLevel.DISK_ONLY)
        held = train.filter(F.col("fold") == fold).select("claim_id", "label", "features")
        kept.append(fitted_on)
        # wrapped one by one: threads that share a copy of the local properties overwrite each other's execution ids
        work += [inheritable_thread_target(train.sparkSession)(functools.partial(score, fitted_on, held, fold, *fit))
                 for fit in fits]
    try:
        with ThreadPool(parallelism) as pool:
            pool.map(lambda run: run(), work, chunksize=1)
    finally:
        for fitted_on in kept:
            fitted_on.unpersist()
    return train.sparkSession.read.parquet(path)


def cross_validate_gbt(train: DataFrame, *, grid: dict[str, list] | None = None, folds: int = CV_FOLDS,
                       parallelism: int = 4, oversample: Callable[[DataFrame], DataFrame] = oversample_poisson,
                       path: str | None = None, **params) -> GridSearch:
    """Grid search by exact area under ROC over training rows as they are, not oversampled. Vectors are assembled once;
    scores go to `path` (a folder of the shared folder by default)."""
    grid = grid or GBT_GRID
    combinations = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    path = path or scratch_dir(train.sparkSession, "out_of_fold")
    assembled = assembler().transform(train.select("claim_id", "is_fraud", "label", *FEATURES))
    rows = spread(with_fold(assembled.select("claim_id", "is_fraud", "label", "features"), folds)).persist(
        StorageLevel.DISK_ONLY)
    try:
        scores = out_of_fold(rows, combinations, folds, f"{path}/scores", parallelism, oversample, **params)
        found = exact_auc(scores, "score", f"{path}/ranks", "combination", "fold").groupBy("combination").agg(
            F.avg("auc_roc").alias("auc")).collect()  # a row per combination
        by_number = {r["combination"]: r["auc"] for r in found}
        auc = [float("nan") if by_number.get(k) is None else by_number[k] for k in range(len(combinations))]
        best = combinations[best_of(auc)]
        model = gbt(**{**params, **best}).fit(oversample(rows).select("label", "features"))
    finally:
        rows.unpersist()
    return GridSearch(combinations, auc, PipelineModel(stages=[assembler(), model]), f"{path}/scores")


def best_of(auc: list[float]) -> int:
    """The first of the highest; one without a value (a fold without both classes) only if all are."""
    return max(range(len(auc)), key=lambda k: (auc[k] == auc[k], auc[k] if auc[k] == auc[k] else 0.0, -k))


def cv_results(found: GridSearch) -> list[tuple]:
    """`(maxIter, maxDepth, ..., mean AUC, is_best)` per combination, in grid order."""
    best = best_of(found.auc)
    return [(*[int(v) for v in c.values()], auc, k == best)
            for k, (c, auc) in enumerate(zip(found.combinations, found.auc))]


def lr_gradient(train: DataFrame, model: PipelineModel, reg: float = LR_PARAMS["regParam"]) -> DataFrame:
    """`(term, gradient)` of the regularised loss at a logistic regression's coefficients, per feature and for the
    intercept: all are 0 at the optimum. Features count in units of their standard deviation, as the fit takes them.

    Two aggregations over the training rows, built-in expressions only; nulls are left out as in the fit."""
    fitted = model.stages[-1]
    weights = dict(zip(FEATURES, (float(w) for w in fitted.coefficients.toArray())))
    rows = train.select("label", *[F.col(f).cast("double").alias(f) for f in FEATURES]).dropna()
    rows = rows.where(~F.greatest(*[F.isnan(f) for f in FEATURES]))
    spread = rows.agg(*[F.stddev_samp(f).alias(f) for f in FEATURES]).first()
    margin = F.lit(float(fitted.intercept))
    for name, weight in weights.items():
        margin = margin + weight * F.col(name)
    wrong = rows.withColumn("_wrong", 1 / (1 + F.exp(-margin)) - F.col("label"))
    row = wrong.agg(F.avg("_wrong").alias("intercept"), *[
        (F.avg(F.col("_wrong") * F.col(f)) / spread[f] + reg * weights[f] * spread[f]).alias(f)
        if spread[f] else F.lit(0.0).alias(f) for f in FEATURES])
    terms = ["intercept", *FEATURES]
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("term"), F.col(t).alias("gradient")) for t in terms])).alias("s")).select("s.*")


def evaluate(predictions: DataFrame, model: str, run_ts: datetime) -> DataFrame:
    """The six metrics as rows `(model, metric_name, metric_value, run_ts)`, four decimals.

    Precision, recall and f1 are class-weighted, the areas exact. Scoring happens once: what follows reads kept scores."""
    scored = predictions.select(
        "label", "prediction", vector_to_array("rawPrediction")[1].alias("score")).persist()
    try:
        values = class_metrics(scored).first().asDict()
        ranks = scratch_dir(predictions.sparkSession, "ranks")
        values.update(exact_auc(scored, "score", ranks).first().asDict())
    finally:
        scored.unpersist()
    rows = [(model, name, None if values[name] is None else round(float(values[name]), 4), run_ts)
            for name in METRIC_NAMES]
    return predictions.sparkSession.createDataFrame(
        rows, "model string, metric_name string, metric_value double, run_ts timestamp"
    )


def prediction_sample(predictions: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Scored claims with the probability of fraud; a sample by the claim ids' hash."""
    return first_by_hash(predictions, rows).select(
        *SAMPLE_COLUMNS, F.round(vector_to_array("probability")[1], 6).alias("prob_fraud")
    )


def save_model(model: PipelineModel, path: str) -> PipelineModel:
    """Store a fitted pipeline, replacing an older one, and return it loaded."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
