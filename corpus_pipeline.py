"""Corpus pipeline: documents -> a de-duplicated, decontaminated mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet in the shared folder and reread as the next one's input.  All but the
last return the columns of ``documents``; the last adds ``copy`` and
``shuffle_key``.  ``n_chars`` follows a text that a stage has changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import decontaminate, line_dedup, mixing, setsketch, toxicity
from newsflow.llm.tables import read
from newsflow.session import scratch_path, scratch_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go."""
    return toxicity.reject(docs, toxicity.fit(docs, read(spark, sf_dir, "labels"))).select(COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents go."""
    return line_dedup.drop_frequent_lines(docs).withColumn(
        "n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more on five-word shingles stays."""
    return setsketch.drop_near_duplicates(docs, percent=80, size=5).select(COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark")).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are replicated to equal weights and shuffled globally."""
    return mixing.mix(docs.select(COLUMNS))


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("near-duplicates", drop_near_duplicates),
          ("decontamination", drop_leaks), ("mixing", mix_sources)]
# The toxicity model, the near-duplicate groups and the seed overlaps have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        with scratch_scope(spark):                 # what the stage's operators wrote goes once it is written
            stage(spark, out, sf_dir).write.parquet(path)
        out = spark.read.parquet(path)
    return out
