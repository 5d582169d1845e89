"""User-level jobs: train, score_batch, export, backfill, extract_feeds/publish,
dataset_status.

Each job builds one declarative plan per output and materializes shared
inputs once (a written table in the shared checkpoint folder), instead
of re-reading raw inputs for every action.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.messages import to_message
from ..functions.text import clean_text, preprocessed_content
from ..operators import aggregates, classifier, feeds, ordering
from ..operators.evaluation import area_under_roc, classification_metrics, is_train, sample_predictions
from ..operators.labels import union_labelled, with_label
from ..operators.tfidf_nb import prepare
from ..session import materialize
from ..sinks import files as sinks
from ..sources.files import list_files, read_article_csv, read_predictions
from ..streaming.scoring import predictions


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: dict
    predictions: DataFrame
    preview: DataFrame          # R2: first prepared training rows
    sample: DataFrame           # M9: first predictions of the test share


def labelled_articles(spark: SparkSession, fake_path: str, true_path: str) -> DataFrame:
    """S1 x2 + P4 + U1: the labelled article table."""
    return union_labelled(with_label(read_article_csv(spark, fake_path), 0.0),
                          with_label(read_article_csv(spark, true_path), 1.0))


def train_on(articles: DataFrame, model_paths=(), split_key: str | None = None) -> TrainResult:
    """T3/T4/X1 -> M6 -> M4 fit -> M5 -> M7/M8 -> K9.

    The prepared table is written once; fit and evaluation read it, not the
    raw input.  Without an id column the split key is the content itself.
    """
    keep = ("article_id", "subject", "label") if "article_id" in articles.columns else ("subject", "label")
    prep = prepare(articles, None, keep=keep)
    key = split_key or ("article_id" if "article_id" in prep.columns else "content")
    prep = materialize(prep.withColumn("is_train", is_train(key)), "train_prepared").filter(
        F.length("content") > C.MIN_CONTENT_CHARS)
    model = classifier.fit(prep.filter("is_train"))
    pred = materialize(classifier.score(model, prep.filter(~F.col("is_train"))), "train_predictions")
    m = classification_metrics(pred).first().asDict()
    for s in ("margin", "raw", "probability"):
        m[f"auc_{s}"] = area_under_roc(pred, score=s)
    if model_paths:
        sinks.save_model(model, model_paths)
    order = [c for c in ("article_id", "subject", "content") if c in prep.columns]
    sample = sample_predictions(pred.select(*[c for c in ("article_id", "content", "label", "prediction", "prob_true")
                                              if c in pred.columns]), 10, order[:1] if "article_id" in order else ("content",))
    return TrainResult(model, m, pred, ordering.preview(prep, 5, order, truncate=50), sample)


def train(spark: SparkSession, fake_path: str, true_path: str, model_paths=()) -> TrainResult:
    return train_on(labelled_articles(spark, fake_path, true_path), model_paths)


def score_batch(model: PipelineModel, articles: DataFrame, dead_letter: str | None = None) -> DataFrame:
    """Batch twin of the scoring stream: prediction rows of well-formed articles.

    Articles without title or text can't be scored; they are written to
    ``dead_letter`` (Parquet) if that is named, and are what ``unscorable`` gives.
    """
    if dead_letter:
        unscorable(articles).write.mode("overwrite").parquet(dead_letter)
    good = articles.filter(F.col("title").isNotNull() & F.col("text").isNotNull())
    return predictions(model, good.withColumn("content", preprocessed_content("title", "text")))


def unscorable(articles: DataFrame) -> DataFrame:
    """X5 of a batch: the articles that ``score_batch`` can't score."""
    return articles.filter(F.col("title").isNull() | F.col("text").isNull())


def export(spark: SparkSession, pred_path: str, out_dir: str, single_file: bool = False) -> dict:
    """S3 -> K7 + K8 (G2, G3, G4): the flat CSV and three summary CSVs.

    The flat export is a folder of part files written in parallel unless
    ``single_file`` asks for one file (one task then writes every row); so are
    the summaries.
    """
    df = read_predictions(spark, pred_path)
    flat = df.select("title", "subject", "date", "prediction_label", "prob_fake", "prob_true")
    out = {"predictions": sinks.export_csv(flat, out_dir, "predictions.csv", single_file)}
    # The three summaries come from one grouping-sets pass; its (small) result is written once.
    sets = materialize(aggregates.export_summaries(df), "export_summaries")
    for name, file in (("by_label", "summary_by_label.csv"), ("by_subject", "summary_by_subject.csv"),
                       ("by_date", "summary_by_date.csv")):
        out[name] = sinks.export_summary(aggregates.summary_from(sets, name), out_dir, file, single_file)
    return out


def backfill(spark: SparkSession, input_path: str, out: str) -> int:
    """ST8: CSV -> T1 -> Parquet by subject (K4) + CSV (K5); returns the row count.

    The input is read and cleaned once, straight into the partitioned Parquet,
    which counts its rows while it writes; the CSV is written from there.
    """
    seen = Observation("backfill")
    cleaned = clean_text(read_article_csv(spark, input_path)).observe(seen, F.count(F.lit(1)).alias("rows"))
    sinks.write_parquet(cleaned, f"{out}/parquet", partition_by=("subject",))
    sinks.write_csv(spark.read.schema(cleaned.schema).parquet(f"{out}/parquet").select(cleaned.columns), f"{out}/csv")
    return int(seen.get["rows"])


def extract_and_publish(feed_docs: DataFrame, fmt: str = "json", path: str | None = None,
                        options: dict | None = None) -> DataFrame:
    """Feed documents -> articles -> ``key, value`` messages (K10); returns the messages."""
    arts = feeds.extract_feeds(feed_docs)
    msgs = to_message(arts, ["title", "text", "subject", "date", "timestamp"])
    if path or fmt == "kafka":
        sinks.publish(msgs, fmt, path, options)
    return msgs


def dataset_status(spark: SparkSession, datasets: dict) -> DataFrame:
    """``dataset, files, bytes, latest, children`` for named dataset folders, one row each.

    ``files`` counts every data file below the folder (recursive count);
    ``children`` counts its direct entries, as a plain listing would show.  A
    folder that is missing or empty has 0 files, 0 bytes and no latest time.
    """
    names = spark.createDataFrame([(n,) for n in datasets], "dataset string")
    parts = [names.limit(0).selectExpr("dataset", "'' as path", "0L as length", "current_timestamp() as modificationTime",
                                       "'' as child")]
    for name, p in datasets.items():
        if sinks.path_exists(spark, p):
            listing = list_files(spark, p, recursive=True)
            parts.append(aggregates.direct_children(listing, _qualified(spark, p)).withColumn("dataset", F.lit(name)))
    found = aggregates.dataset_summary(union_labelled(*parts))
    return names.join(found, "dataset", "left").fillna(0, ["files", "bytes", "children"])


def _qualified(spark: SparkSession, path: str) -> str:
    """The fully qualified form of ``path`` (as listed by the file source)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString().rstrip("/")


def latest_files(spark: SparkSession, path: str, n: int = 10, by: str = "path") -> DataFrame:
    """The last ``n`` files of a dataset by name (or by modification time)."""
    return ordering.latest(list_files(spark, path), n, by)


__all__ = ["train", "train_on", "score_batch", "unscorable", "export", "backfill", "extract_and_publish", "dataset_status",
           "latest_files", "labelled_articles"]
