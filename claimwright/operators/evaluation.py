"""Model quality from a `(label, prediction[, score])` DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Reported metric names, in order.
METRIC_NAMES = ["auc_roc", "auc_pr", "f1", "precision", "recall", "accuracy"]
RULE_SCORE = 4


def with_label(df: DataFrame) -> DataFrame:
    """Adds the integer class `label`."""
    return df.withColumn("label", F.col("is_fraud").cast("int"))


def threshold_predictions(features: DataFrame, cut: float = RULE_SCORE) -> DataFrame:
    """The rule as a model: fraud where the anomaly score reaches `cut`."""
    return with_label(features).withColumn(
        "prediction", F.when(F.col("anomaly_score_proxy") >= cut, 1.0).otherwise(0.0)
    )


def confusion_matrix(predictions: DataFrame, *by: str) -> DataFrame:
    """tp, tn, fp, fn in one pass, over all rows or per value of `by`."""
    actual, predicted = F.col("label") == 1, F.col("prediction") == 1.0
    return predictions.groupBy(*by).agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if((F.col("label") == 0) & (F.col("prediction") == 0.0)).alias("tn"),
        F.count_if((F.col("label") == 0) & predicted).alias("fp"),
        F.count_if(actual & (F.col("prediction") == 0.0)).alias("fn"),
    )


def confusion_table(predictions: DataFrame) -> DataFrame:
    """Actual class by predicted class. Fixed pivot values: no extra pass to find them."""
    counts = predictions.groupBy("label").pivot("prediction", [0.0, 1.0]).count()
    return counts.select(
        F.when(F.col("label") == 1, "Actual_Fraud").otherwise("Actual_Normal").alias("actual"),
        F.coalesce(F.col("`0.0`"), F.lit(0)).alias("Predicted_Normal"),
        F.coalesce(F.col("`1.0`"), F.lit(0)).alias("Predicted_Fraud"),
    )


def class_metrics(predictions: DataFrame, *by: str) -> DataFrame:
    """f1, precision and recall weighted by class frequency, and accuracy; overall or per value of `by`.

    The rows are read once, into label-by-prediction counts; the rest is arithmetic on those few counts."""
    counts = predictions.groupBy(*by, F.col("label").cast("double").alias("label"), "prediction").agg(
        F.count("*").alias("n")
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"),
                 hit.cast("long").alias("hits")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("actual"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hits")),
    )
    per_class = counts.select(*by, F.explode(sides).alias("s")).groupBy(*by, "s.cls").agg(
        F.sum("s.actual").cast("double").alias("actual"),
        F.sum("s.predicted").alias("predicted"),
        F.sum("s.hits").alias("hits"),
    )
    # 0 where nothing was predicted, or nothing belongs, to the class
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "actual"), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    total = F.sum("actual")
    return per_class.groupBy(*by).agg(
        F.try_divide(F.sum(f1 * F.col("actual")), total).alias("f1"),
        F.try_divide(F.sum(precision * F.col("actual")), total).alias("precision"),
        F.try_divide(F.sum(recall * F.col("actual")), total).alias("recall"),
        F.try_divide(F.sum("hits"), total).alias("accuracy"),
    )


def score_ranks(predictions: DataFrame, score: str, path: str, *by: str) -> DataFrame:
    """One row per distinct score (and value of `by`): positives and negatives with that score (`p`, `n`), those above
    it (`p_above`, `n_above`) and all (`p_all`, `n_all`).

    Rows are combined to counts per score first. Those are dealt by range and written to `path`, so each part is a
    stretch of the ranking however many rows share a score; running sums stay within a part, and the parts before it
    add one number each (one row per part and group, broadcast)."""
    spark = predictions.sparkSession
    steps = predictions.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    steps.repartitionByRange(*by, F.desc("score")).withColumn("part", F.spark_partition_id()).write.mode(
        "overwrite").parquet(path)
    steps = spark.read.parquet(path)
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = steps.groupBy(*by, "part").agg(F.sum("p").alias("_p"), F.sum("n").alias("_n"))
    parts = parts.select(
        *[F.col(c).alias(f"_{c}") for c in (*by, "part")],
        *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"{c}_before") for c in "pn"],
        *[F.sum(f"_{c}").over(whole).alias(f"{c}_all") for c in "pn"])
    same = F.col("part") == F.col("_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    within = Window.partitionBy(*by, "part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    return steps.join(F.broadcast(parts), same).select(
        *by, "score", "p", "n",
        *[(F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"{c}_before")).alias(f"{c}_above") for c in "pn"],
        "p_all", "n_all")


def exact_auc(predictions: DataFrame, score: str, path: str, *by: str) -> DataFrame:
    """`auc_roc` and `auc_pr` over every distinct score, overall or per value of `by`; null where a class is missing.

    Tied scores are one step, so the area under the ROC is the share of pairs ranked rightly, ties half. The curve of
    precision begins at recall 0 with the precision of the highest score."""
    ranks = score_ranks(predictions, score, path, *by)
    p, n, tp, fp = (F.col(c).cast("double") for c in ("p", "n", "p_above", "n_above"))
    precision = F.try_divide(tp + p, tp + p + fp + n)
    earlier = F.coalesce(F.try_divide(tp, tp + fp), precision)
    pairs = n * (tp + p / 2)
    return ranks.groupBy(*by).agg(
        F.try_divide(F.sum(pairs), F.max("p_all").cast("double") * F.max("n_all")).alias("auc_roc"),
        F.try_divide(F.sum(p * (precision + earlier) / 2), F.max("p_all").cast("double")).alias("auc_pr"))


def split_accuracy(predictions: DataFrame) -> DataFrame:
    """Rows and share of right predictions per `split`."""
    return predictions.groupBy("split").agg(
        F.count("*").alias("n"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
    )
