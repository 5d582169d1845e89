"""Whole-batch commits of ``foreachBatch`` output.

A batch owns the folder ``out``/batch_id=N.  It is written beside it, under
``out``/_staged (which readers skip), and then put in its place as a whole, so a
replay leaves exactly the rows of the last attempt: also when that has other
partition values (a retrained model's labels) or no rows at all, which dynamic
partition overwrite would not clear.  What crashed attempts of the batch left staged
is deleted by the next one.

The swap is a delete and a rename: one step each on HDFS; a store without atomic
renames copies.  A batch that is written to several outputs commits them one by one;
the query's checkpoint replays it until all are in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .files import _hadoop_fs

BATCH_COLUMN = "batch_id"
STAGED = "_staged"


def _folder(out: str, batch_id: int) -> str:
    return f"{out.rstrip('/')}/{BATCH_COLUMN}={int(batch_id)}"


def _drop_staged(spark: SparkSession, out: str, batch_id: int) -> None:
    fs, at, _ = _hadoop_fs(spark, f"{out.rstrip('/')}/{STAGED}")
    if fs.exists(at):
        for s in fs.listStatus(at):
            if s.getPath().getName().startswith(f"{int(batch_id)}-"):
                fs.delete(s.getPath(), True)


def replace_batch(df: DataFrame, out: str, batch_id: int, fmt: str = "parquet", partition_by=(),
                  options: dict | None = None) -> str:
    """Writes ``df`` as all of batch ``batch_id`` below ``out``; returns the batch's folder."""
    spark, target = df.sparkSession, _folder(out, batch_id)
    _drop_staged(spark, out, batch_id)
    staged = f"{out.rstrip('/')}/{STAGED}/{int(batch_id)}-{uuid.uuid4().hex}"
    writer = df.write.format(fmt).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(staged)
    fs, to, jvm = _hadoop_fs(spark, target)
    if fs.exists(to):
        fs.delete(to, True)
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged), to):
        raise OSError(f"batch {batch_id} could not be moved to {target}")
    return target


def clear_batch(spark: SparkSession, out: str, batch_id: int) -> None:
    """Leaves batch ``batch_id`` without rows (a replay that has none)."""
    _drop_staged(spark, out, batch_id)
    fs, at, _ = _hadoop_fs(spark, _folder(out, batch_id))
    if fs.exists(at):
        fs.delete(at, True)
