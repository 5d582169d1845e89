"""newsflow: a Spark-native news-article analytics package.

Articles are landed from feed documents, cleaned and deduplicated in batch
or as a stream, classified with TF-IDF + multinomial Naive Bayes (both the
``pyspark.ml`` estimator and an exact-vocabulary relational twin), scored
into partitioned tables with replay-safe checkpoints and exported as
summaries.  Everything is expressed with DataFrames, Spark SQL, Structured
Streaming and ``pyspark.ml``; no Python UDF sits on a hot path.
"""

__all__ = ["config", "schema", "session"]
