"""Previews and latest-N listings (R2, R3); R1 is the order of the reports in ``aggregates``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int, order, truncate: int | None = None) -> DataFrame:
    """R2: first ``n`` rows in ``order``; string columns cut to ``truncate``.

    ``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: each task
    keeps its top ``n``; ``n`` itself is the bound of what is shown.
    """
    out = df.orderBy(*order).limit(n)
    if truncate:
        out = out.select(*[F.substring(F.col(f.name), 1, truncate).alias(f.name)
                           if f.dataType.simpleString() == "string" else F.col(f.name)
                           for f in out.schema.fields])
    return out


def latest(listing: DataFrame, n: int = 10, by: str = "path") -> DataFrame:
    """The ``n`` last entries by name (default, as a sorted listing's tail) or by time."""
    return listing.orderBy(F.desc(by), F.desc("path")).limit(n)
