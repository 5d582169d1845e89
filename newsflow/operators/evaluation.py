"""Model evaluation: hash split (M6), one-pass classification metrics (M7),
rank-form area under ROC (M8) and sample predictions (M9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..session import materialize


def split_bucket(key="article_id", buckets: int = C.TRAIN_BUCKETS) -> Column:
    """Stable bucket of a key: first 32 bits of md5(key) modulo ``buckets``.

    Unlike ``randomSplit`` it does not depend on partitioning or input order,
    so a retried task and a SQL engine give the same split.
    """
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets


def is_train(key="article_id", percent: int = C.TRAIN_PERCENT) -> Column:
    """M6: True for the training share (``percent`` of 100 buckets)."""
    return split_bucket(key) < percent


def random_split(df: DataFrame, weights=(C.TRAIN_FRACTION, 1 - C.TRAIN_FRACTION), seed: int = C.SPLIT_SEED):
    """M6 parity option: ``randomSplit`` (depends on partitioning)."""
    return df.randomSplit(list(weights), seed=seed)


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts per (label, prediction) pair: partial + final aggregation, tiny output."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M7: accuracy, weighted precision, weighted recall, weighted F1 in one pass.

    Equal to ``MulticlassClassificationEvaluator``: classes are the labels
    present; precision of a class never predicted is 0.  The arithmetic runs
    on the (classes x classes) confusion table, not on the data.
    """
    cm = confusion(pred, label, prediction)
    per_label = cm.groupBy("label").agg(
        F.sum("n").alias("n_label"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"))
    per_pred = cm.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("n_pred"))
    per = per_label.join(per_pred, "label", "left").select(
        "label", "n_label", "tp", F.coalesce("n_pred", F.lit(0)).alias("n_pred"))
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.col("tp") / F.col("n_label")
    per = per.select("n_label", "tp", prec.alias("p"), rec.alias("r"))
    f1 = F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0)
    total = F.sum("n_label")
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("p") * F.col("n_label")) / total).alias("weighted_precision"),
        (F.sum(F.col("r") * F.col("n_label")) / total).alias("weighted_recall"),
        (F.sum(f1 * F.col("n_label")) / total).alias("f1"),
        total.cast("bigint").alias("n"))


def auc_rank(pred: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None) -> DataFrame:
    """M8: area under ROC as P(score_pos > score_neg) + P(tie) / 2.

    Scores are first aggregated per distinct value (partial aggregation, so a
    hot score is one row) and range-partitioned into ``buckets`` score ranges,
    written once.  Per-range totals give the count of negatives below each range
    (a table of one row per range) and the running sum runs inside each range
    only, so no window spans all scores.  By default there are 4 ranges per
    shuffle partition, so range size shrinks as the cluster grows.
    """
    if buckets is None:
        buckets = 4 * int(pred.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_score = pred.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(F.when(F.col(label) == 1.0, 1).otherwise(0)).cast("double").alias("pos"),
        F.sum(F.when(F.col(label) == 1.0, 0).otherwise(1)).cast("double").alias("neg"))
    ranges = materialize(per_score.repartitionByRange(int(buckets), "s").withColumn(
        "bucket", F.spark_partition_id()), "auc_ranges")
    totals = ranges.groupBy("bucket").agg(F.sum("neg").alias("bneg"))
    offsets = totals.select("bucket", F.sum("bneg").over(Window.orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)).alias("offset"))
    within = Window.partitionBy("bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranges.join(offsets, "bucket").select(
        "pos", "neg", (F.coalesce("offset", F.lit(0.0)) + F.coalesce(F.sum("neg").over(within), F.lit(0.0)))
        .alias("neg_below"))
    return ranked.agg(
        (F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))) /
         (F.sum("pos") * F.sum("neg"))).alias("auc"))


def area_under_roc(pred: DataFrame, score: str = "margin", label: str = "label") -> float:
    """M8 with an explicit choice of score.

    ``raw``: Spark's evaluator on ``rawPrediction`` (its default; for Naive
    Bayes an unnormalized log-joint, confounded by document length -- kept
    for parity); ``probability``: the evaluator on ``probability`` (ties where
    it saturates); ``margin``: the exact rank form on ``raw[1] - raw[0]``.
    """
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    if score == "margin":
        from .classifier import margin
        return auc_rank(pred.withColumn("_margin", margin()), score="_margin", label=label).first()["auc"]
    col = {"raw": "rawPrediction", "probability": "probability"}[score]
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=col,
                                         metricName="areaUnderROC").evaluate(pred)


def sample_predictions(pred: DataFrame, n: int = 10, order=("article_id",), width: int = 50,
                       content: DataFrame | None = None, key: str = "article_id") -> DataFrame:
    """M9 / R2: first ``n`` rows by ``order`` with content truncated to ``width``.

    With ``content`` (``key, content``), the text is attached *after* the
    limit: the ``n`` sampled rows are broadcast (a bound of ``n`` rows) into
    a join with the content table, instead of joining every prediction.
    """
    top = pred.orderBy(*order).limit(n)
    if content is not None:
        top = content.select(key, "content").join(F.broadcast(top), key)
    cols = [F.substring(F.col(c), 1, width).alias(c) if c == "content" else F.col(c) for c in top.columns]
    return top.select(*cols)
