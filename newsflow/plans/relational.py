"""Relational TF-IDF + Naive Bayes: fitted on labelled articles, scoring all of them (M-R job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import tfidf_nb
from ..operators.evaluation import is_train
from ..session import materialize
from ..sources.tables import articles


def prepared_articles(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """All articles that have content, preprocessed, with the shares of the hash split.

    ``is_train`` and ``is_test`` are labelled articles that are long enough (X1); short and unlabelled
    ones are scored all the same, as the serving side does.  The table is written once.
    """
    prep = tfidf_nb.prepare(articles(spark, sf_dir, tasks=tasks, how="left"), None,
                            keep=("article_id", "subject", "date", "label"))
    usable = F.col("label").isNotNull() & (F.length("content") > C.MIN_CONTENT_CHARS)
    prep = materialize(prep.withColumn("is_train", is_train("article_id") & usable).withColumn(
        "is_test", ~is_train("article_id") & usable), "nb_prepared")
    return prep.filter("content is not null")
