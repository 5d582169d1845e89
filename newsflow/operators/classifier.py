"""M1-M5: the five-stage ``pyspark.ml`` model (tokenize, stop words, hashed
term frequencies, IDF, multinomial Naive Bayes) and its scored output.

Scoring is row-local: the fitted IDF vector (5000 doubles) and the Naive
Bayes matrix (2 x 5000) travel with the task closure, so ``transform`` adds
no shuffle and works unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .labels import class_probability, decode_label


def build_model(num_features: int = C.NUM_FEATURES, min_doc_freq: int = C.MIN_DOC_FREQ,
                smoothing: float = C.SMOOTHING, content: str = "content") -> Pipeline:
    """M4: unfitted estimator chain ``content -> prediction``."""
    return Pipeline(stages=[
        Tokenizer(inputCol=content, outputCol="words"),                          # A1
        StopWordsRemover(inputCol="words", outputCol="filtered_words"),         # A2
        HashingTF(inputCol="filtered_words", outputCol="raw_features", numFeatures=num_features),  # M1
        IDF(inputCol="raw_features", outputCol="features", minDocFreq=min_doc_freq),               # M2
        NaiveBayes(featuresCol="features", labelCol="label", smoothing=smoothing,
                   modelType="multinomial"),                                     # M3
    ])


def fit(train: DataFrame, **kw) -> PipelineModel:
    """M4: fit on rows with ``content`` and ``label``.

    Equivalent to ``build_model(**kw).fit(train)``, but the training set is
    tokenized and hashed once: IDF and Naive Bayes each make a pass over the
    hashed vectors (persisted for the duration of the fit) instead of
    re-tokenizing the text for every estimator.
    """
    stages = build_model(**kw).getStages()
    featurize = PipelineModel(stages=stages[:3])
    tf = featurize.transform(train).select("label", "raw_features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        idf_model = stages[3].fit(tf)
        nb_model = stages[4].fit(idf_model.transform(tf))
    finally:
        tf.unpersist()
    return PipelineModel(stages=stages[:3] + [idf_model, nb_model])


def score(model: PipelineModel, df: DataFrame, keep=None) -> DataFrame:
    """M5 + P5 + P6: predictions with ``prediction_label, prob_fake, prob_true``.

    ``df`` must have a non-NULL ``content`` (the tokenizer rejects NULL);
    route NULL rows away first (X5).
    """
    out = model.transform(df)
    cols = list(keep) if keep is not None else [c for c in df.columns]
    return out.select(*cols, "rawPrediction", "probability", "prediction",
                      decode_label("prediction").alias("prediction_label"),
                      class_probability("probability", 0).alias("prob_fake"),
                      class_probability("probability", 1).alias("prob_true"))


def margin(raw="rawPrediction") -> F.Column:
    """Score for ranking: raw[1] - raw[0] (the log-odds), length-independent."""
    from pyspark.ml.functions import vector_to_array
    a = vector_to_array(F.col(raw))
    return F.get(a, 1) - F.get(a, 0)
