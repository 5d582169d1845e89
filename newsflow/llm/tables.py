"""Reading the given tables and identifying a row without a unique column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str | Column = "text") -> Column:
    """Hash of a text: with ``doc_id`` it identifies a row (or rows that are equal)."""
    return F.xxhash64(F.col(text) if isinstance(text, str) else text)


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, so that none clashes with an operator's own names."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, *but: str) -> list[Column]:
    """The columns of ``df`` out of ``row``, without those named in ``but``."""
    names = {b.lower() for b in but}
    return [F.col("row")[c].alias(c) for c in df.columns if c.lower() not in names]


ROWS_AT_ONCE = 1024       # rows of an Arrow batch that are Python objects at the same time
ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
         "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32())}


def map_column(df: DataFrame, keep: list[str], column: str, fn: Callable, fields: dict[str, str]) -> DataFrame:
    """Columns ``keep`` untouched (nulls and 64-bit values too), and ``fields`` (name -> type) that ``fn``
    makes, as a dict of columns, from a list of values of ``column``, ``ROWS_AT_ONCE`` at a time."""
    kinds = dict(df.select(*keep).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                b = batch.slice(at, ROWS_AT_ONCE)
                made = fn(b.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(i) for i in range(len(keep))] + [pa.array(made[n], ARROW[t]) for n, t in fields.items()],
                    names=[*keep, *fields])

    schema = ", ".join(f"`{n}` {t}" for n, t in [*kinds.items(), *fields.items()])
    return df.select(*keep, F.col(column).alias("map_column_value")).mapInArrow(run, schema)
