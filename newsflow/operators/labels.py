"""Label columns: constant label (P4), labelled union (U1), label decode (P5)
and class probabilities out of an ML probability vector (P6)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C


def with_label(df: DataFrame, label: float) -> DataFrame:
    """Constant ``label`` column (0.0 fake, 1.0 true)."""
    return df.withColumn("label", F.lit(float(label)))


def union_labelled(*parts: DataFrame) -> DataFrame:
    """Bag union by column name (not position), no de-duplication."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def decode_label(prediction="prediction") -> Column:
    """P5: 0.0 -> FAKE, anything else (NULL included) -> TRUE."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.when(p == 0.0, F.lit(C.LABEL_FAKE)).otherwise(F.lit(C.LABEL_TRUE))


def class_probability(probability="probability", index: int = 0) -> Column:
    """One class probability out of an ML vector, 0.0 when missing.

    ``get`` (not ``[i]``) keeps an out-of-range index NULL under ANSI mode;
    no Python UDF, so the projection stays inside whole-stage codegen.
    """
    p = F.col(probability) if isinstance(probability, str) else probability
    return F.coalesce(F.get(vector_to_array(p), index), F.lit(0.0))
