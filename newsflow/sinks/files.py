"""Batch sinks: partitioned Parquet (K4), CSV (K5), single-file CSV export (K7),
summary CSVs (K8), model save (K9), message publish (K10), training landing (K11).

CSV is always written with ``escape='"'`` so it reads back with the same
options (quotes, commas and line breaks survive).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.labels import union_labelled, with_label
from ..sources.files import CSV_OPTIONS, read_article_csv

CSV_WRITE_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
                     "ignoreTrailingWhiteSpace": "false"}


def write_parquet(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    """K4: Parquet, optionally partitioned.

    Rows are clustered by the partition columns with a REBALANCE hint, so
    each task writes few large files per partition value instead of one small
    file per (task, value) pair; AQE splits a hot partition value over
    several tasks and merges small ones.
    """
    w = df
    if partition_by:
        w = df.hint("rebalance", *partition_by)
    writer = w.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: header CSV, one file per task."""
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def export_csv(df: DataFrame, out_dir: str, name: str, single_file: bool = False) -> str:
    """K7: CSV export; with ``single_file`` one ``out_dir/name`` file.

    A single file means one task writes everything (``coalesce(1)``), so it is
    opt-in; the part file is moved with the Hadoop FileSystem API, which works
    on any cluster file system.  Without it, ``out_dir/name`` is a directory
    of part files written in parallel.
    """
    spark = df.sparkSession
    target = f"{out_dir.rstrip('/')}/{name}"
    if not single_file:
        write_csv(df, target)
        return target
    tmp = f"{out_dir.rstrip('/')}/_tmp_{name}"
    write_csv(df.coalesce(1), tmp)
    fs, tmp_p, jvm = _hadoop_fs(spark, tmp)
    part = [s.getPath() for s in fs.listStatus(tmp_p) if s.getPath().getName().startswith("part-")]
    dst = jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(dst):
        fs.delete(dst, True)
    if part:
        fs.rename(part[0], dst)
    else:                               # empty result: an empty file, like the folder form
        fs.create(dst).close()
    fs.delete(tmp_p, True)
    return target


def export_summary(summary: DataFrame, out_dir: str, name: str, single_file: bool = False) -> str:
    """K8: a summary table as CSV, written by executors (no driver collect).

    Its keys (subject, date) are free text of messages, so it is a folder of part
    files unless ``single_file`` asks one task to write it.
    """
    return export_csv(summary, out_dir, name, single_file)


def compact(spark: SparkSession, src: str, dst: str, partition_by=(), schema=None) -> None:
    """Rewrite a small-file dataset (streaming sink output) into a new folder.

    Reads ``src`` (for a streaming sink, its committed files only, through
    ``_spark_metadata``) and writes it rebalanced by the partition columns to
    ``dst``; the source is never rewritten in place.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    write_parquet(reader.parquet(src), dst, partition_by=partition_by)


def bucketed_table(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``key`` at ``path``; return it.

    Two tables bucketed by the same key into the same number of buckets join
    without an exchange, so the text-heavy side (documents) is shuffled once,
    when it is bucketed, instead of in every job that joins it.
    """
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path)
     .saveAsTable(name))
    return df.sparkSession.table(name)


def save_model(model, paths) -> list[str]:
    """K9: save (overwrite) the fitted model to each path (primary, backup...)."""
    done = []
    for p in ([paths] if isinstance(paths, str) else list(paths)):
        model.write().overwrite().save(p)
        done.append(p)
    return done


def publish(messages: DataFrame, fmt: str = "json", path: str | None = None, options: dict | None = None,
            mode: str = "append") -> None:
    """Write ``key, value`` messages to Kafka (``fmt='kafka'``) or to files."""
    w = messages.write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        w.save()
    else:
        w.mode(mode).save(path)


def land_training(spark: SparkSession, fake_path: str | None, true_path: str | None, out: str) -> dict:
    """Labelled CSVs -> one Parquet training table partitioned by label.

    A missing input is skipped and reported, as the upload step did.
    """
    parts, report = [], {}
    for label, p in ((0.0, fake_path), (1.0, true_path)):
        if not p or not path_exists(spark, p):
            report[label] = "missing"
            continue
        parts.append(with_label(read_article_csv(spark, p), label))
        report[label] = p
    if parts:
        # every input file has one label already: each task writes into one folder, without a shuffle
        union_labelled(*parts).write.mode("overwrite").partitionBy("label").parquet(out)
    return report


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p, _ = _hadoop_fs(spark, path)
    fs.mkdirs(p)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


__all__ = ["write_parquet", "write_csv", "export_csv", "export_summary", "compact", "bucketed_table", "save_model",
           "publish",
           "path_exists", "land_training", "CSV_OPTIONS", "CSV_WRITE_OPTIONS"]
