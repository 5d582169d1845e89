"""Counts and summaries.

Every one is a ``groupBy().agg(count)``: partial aggregation map-side, one
exchange on the (low-cardinality) key, final aggregation.  Ordering is only
added where the summary is a sorted report, with a tie-break so the order
is total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    """G1: one row ``n``."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def count_by(df: DataFrame, *keys: str, order: bool = False) -> DataFrame:
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(*keys) if order else out


def by_label(pred: DataFrame) -> DataFrame:
    """``prediction_label, count``."""
    return count_by(pred, "prediction_label")


def by_subject_label(pred: DataFrame) -> DataFrame:
    """``subject, prediction_label, count`` sorted by subject (then label)."""
    return count_by(pred, "subject", "prediction_label", order=True)


def by_date_label(pred: DataFrame) -> DataFrame:
    """``date, prediction_label, count`` sorted by the date *text* (then label)."""
    return count_by(pred, "date", "prediction_label", order=True)


# grouping_id() over (subject, date, prediction_label): a bit is 1 when the
# column is rolled up, so each summary of the export has its own id.
SUMMARY_SETS = {"by_label": (["prediction_label"], 0b110),
                "by_subject": (["subject", "prediction_label"], 0b010),
                "by_date": (["date", "prediction_label"], 0b100)}


def export_summaries(pred: DataFrame) -> DataFrame:
    """G2 + G3 + G4 in one scan and one shuffle: grouping sets tagged by ``gid``."""
    return pred.groupingSets([cols for cols, _ in SUMMARY_SETS.values()], "subject", "date",
                             "prediction_label").agg(F.count(F.lit(1)).alias("count"),
                                                     F.grouping_id().alias("gid"))


def summary_from(sets: DataFrame, name: str) -> DataFrame:
    """One summary out of ``export_summaries``, in report order."""
    cols, gid = SUMMARY_SETS[name]
    out = sets.filter(F.col("gid") == gid).select(*cols, "count")
    return out.orderBy(*cols) if len(cols) > 1 else out


def direct_children(listing: DataFrame, root: str) -> DataFrame:
    """Adds ``child``: the first path component below ``root`` (a file or a folder).

    ``root`` is the qualified folder path as the file source lists it.
    Derived from a recursive listing, so counting direct children stays a
    distributed aggregation (folders without files are not seen).
    """
    rel = F.substring(F.col("path"), len(root.rstrip("/")) + 2, 1 << 30)
    return listing.withColumn("child", F.substring_index(rel, "/", 1))


def dataset_summary(listing: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Per dataset ``files, bytes, latest`` from a file listing."""
    aggs = [F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("latest")]
    if "child" in listing.columns:
        aggs.append(F.count_distinct("child").alias("children"))
    return listing.groupBy(dataset).agg(*aggs)
