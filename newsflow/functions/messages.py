"""Message encoding: bytes to text (P1), JSON parse (J1) + flatten (P2),
dead-letter flag (X5) and JSON build (J2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ARTICLE_SCHEMA, CORRUPT_COLUMN
from .text import col_, compute_once, title_key

BAD_COLUMN = "_bad"


def value_as_string(c="value") -> Column:
    """Kafka value bytes (or already text) as a string."""
    return col_(c).cast("string")


def parse_json(c, schema: T.StructType = ARTICLE_SCHEMA, keep_corrupt: bool = False) -> Column:
    """PERMISSIVE JSON parse against a fixed schema.

    With ``keep_corrupt`` the struct gets a ``_corrupt`` field holding the raw
    text of records that are not a JSON object.
    """
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
        return F.from_json(col_(c), schema, {"columnNameOfCorruptRecord": CORRUPT_COLUMN})
    return F.from_json(col_(c), schema)


def parse_messages(df: DataFrame, schema: T.StructType = ARTICLE_SCHEMA, value: str = "value",
                   flag_bad: bool = False, required=("title", "text"), keep=()) -> DataFrame:
    """P1 + J1 + P2, optionally adding the X5 ``_bad`` flag.

    A row is bad when the value is NULL, is not a JSON object, or lacks one of
    the ``required`` fields; bad rows would make the tokenizer fail later.
    """
    keep = list(keep)
    raw = df.select(*keep, value_as_string(value).alias("json_str"))
    if not flag_bad:
        return raw.select(*keep, parse_json("json_str", schema).alias("data")).select(*keep, "data.*")
    # Parsed once: the dead-letter filter downstream reads the parsed fields,
    # and would otherwise be pushed below with the JSON parse inlined.
    parsed = compute_once(raw, {"data": parse_json("json_str", schema, keep_corrupt=True)})
    bad = F.col("json_str").isNull() | F.col(f"data.{CORRUPT_COLUMN}").isNotNull()
    for r in required:
        bad = bad | F.col(f"data.{r}").isNull()
    return parsed.select(*keep, *[F.col(f"data.{f.name}").alias(f.name) for f in schema.fields],
                         F.col("json_str").alias("raw_value"), bad.alias(BAD_COLUMN))


def to_json_value(cols) -> Column:
    """One JSON object per row; NULL fields are written as null."""
    return F.to_json(F.struct(*[col_(c) for c in cols]), {"ignoreNullFields": "false"})


def to_message(df: DataFrame, cols, key_from: str = "title") -> DataFrame:
    """K10 shape: key = first 50 characters of the title, value = JSON object."""
    return df.select(title_key(key_from).alias("key"), to_json_value(cols).alias("value"))
