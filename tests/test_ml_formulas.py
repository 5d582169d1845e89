"""M1-M5: the fitted ML model equals the public TF-IDF / Naive Bayes formulas."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from newsflow import config as C
from newsflow.operators import classifier
from newsflow.operators.evaluation import classification_metrics, is_train
from newsflow.operators.tfidf_nb import prepare
from newsflow.sources.tables import articles

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fitted(spark):
    prep = prepare(articles(spark, SF)).withColumn("is_train", is_train("article_id")).cache()
    train = prep.filter("is_train")
    model = classifier.fit(train)
    return prep, train, model


def test_idf_and_naive_bayes_formulas(fitted):
    prep, train, model = fitted
    tf_model = PipelineModel(stages=model.stages[:3])
    rows = tf_model.transform(train).select("raw_features", "label").collect()
    raw = np.array([r["raw_features"].toArray() for r in rows])
    labels = np.array([r["label"] for r in rows])
    m = raw.shape[0]
    df = (raw > 0).sum(axis=0)
    idf = np.where(df >= C.MIN_DOC_FREQ, np.log((m + 1.0) / (df + 1.0)), 0.0)
    assert np.allclose(model.stages[3].idf.toArray(), idf, atol=1e-9)

    x = raw * idf
    lam, classes = C.SMOOTHING, [0.0, 1.0]
    n = np.array([(labels == c).sum() for c in classes], dtype=float)
    pi = np.log(n + lam) - math.log(m + lam * len(classes))
    s = np.array([x[labels == c].sum(axis=0) for c in classes])
    theta = np.log(s + lam) - np.log(s.sum(axis=1, keepdims=True) + lam * x.shape[1])
    nb = model.stages[4]
    assert np.allclose(nb.pi.toArray(), pi, atol=1e-9)
    assert np.allclose(nb.theta.toArray(), theta, atol=1e-9)

    scored = model.transform(prep.filter(~F.col("is_train"))).select("features", "rawPrediction", "probability")
    for r in scored.limit(5).collect():
        raw_pred = pi + theta @ r["features"].toArray()
        assert np.allclose(r["rawPrediction"].toArray(), raw_pred, atol=1e-6)
        p = np.exp(raw_pred - raw_pred.max())
        assert np.allclose(r["probability"].toArray(), p / p.sum(), atol=1e-9)


def test_probability_columns_and_labels(fitted):
    prep, _, model = fitted
    out = classifier.score(model, prep).select("prediction", "prediction_label", "prob_fake", "prob_true").collect()
    for r in out:
        assert abs(r["prob_fake"] + r["prob_true"] - 1.0) < 1e-9
        assert r["prediction_label"] == ("FAKE" if r["prediction"] == 0.0 else "TRUE")


def test_one_pass_metrics_equal_evaluator(fitted):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    prep, _, model = fitted
    pred = model.transform(prep.filter(~F.col("is_train")))
    mine = classification_metrics(pred).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for ours, name in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                       ("weighted_recall", "weightedRecall"), ("f1", "f1")):
        assert abs(mine[ours] - ev.evaluate(pred, {ev.metricName: name})) < 1e-9


def test_rank_auc_equals_evaluator(fitted):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from newsflow.operators.evaluation import auc_rank
    prep, _, model = fitted
    pred = model.transform(prep).withColumn("margin", classifier.margin())
    ours = auc_rank(pred, score="margin").first()["auc"]
    # Same score for both (probability saturates at 1.0 and would add ties).
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="margin", metricName="areaUnderROC")
    assert abs(ours - ev.evaluate(pred)) < 1e-9


def test_relational_model_equals_spark_naive_bayes_on_exact_vocabulary(spark):
    """M-R = CountVectorizer (whole vocabulary) + IDF + NaiveBayes on the same terms."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IDF, CountVectorizer
    from newsflow.functions.text import terms
    from newsflow.operators import tfidf_nb
    from newsflow.plans import relational
    docs = relational.prepared_articles(spark, SF)
    train = docs.filter("is_train")
    ours = tfidf_nb.fit(train).predict(docs).select("article_id", "prediction", "score0", "score1")
    with_terms = docs.withColumn("t", terms("content"))
    ml = Pipeline(stages=[CountVectorizer(inputCol="t", outputCol="tf", vocabSize=1 << 24, minDF=1.0),
                          IDF(inputCol="tf", outputCol="features", minDocFreq=C.MIN_DOC_FREQ),
                          NaiveBayes(smoothing=C.SMOOTHING, modelType="multinomial")]).fit(
        with_terms.filter("is_train"))
    theirs = ml.transform(with_terms).select("article_id", "prediction", "rawPrediction").collect()
    mine = {r["article_id"]: r for r in ours.collect()}
    assert len(mine) == len(theirs)
    for r in theirs:
        m = mine[r["article_id"]]
        raw = r["rawPrediction"].toArray()
        assert m["prediction"] == r["prediction"]
        assert abs(m["score0"] - raw[0]) < 1e-6 * max(1.0, abs(raw[0]))
        assert abs(m["score1"] - raw[1]) < 1e-6 * max(1.0, abs(raw[1]))


def test_split_options(fitted):
    from newsflow.operators.evaluation import random_split, split_bucket
    prep, train, _ = fitted
    a, b = random_split(prep)
    assert a.count() + b.count() == prep.count()
    buckets = prep.select(split_bucket("article_id").alias("b")).agg(F.min("b"), F.max("b")).first()
    assert 0 <= buckets[0] <= buckets[1] < 100
    assert train.count() == prep.filter(split_bucket("article_id") < 80).count()
