"""Connected components of a table of links, by alternating stars.

Links are only ever joined and aggregated: nothing of them reaches the driver
but one number per round.  A large star hangs every neighbour of a node on the
smallest one around it, which halves distances; a hot node costs one value of a
map-side aggregation and a join that can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _hang(links: DataFrame, larger_only: bool) -> DataFrame:
    """For each node, its neighbours (larger ones, or smaller ones and itself) linked to the smallest around it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not larger_only:
        both = both.filter("v < u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.join(least, "u")
    if larger_only:
        out = out.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """node, component (the smallest node reachable) of every node of ``links`` (u, v: long).

    Null ends and loops are left out; repeated links count once; no link gives an empty table.
    """
    now = materialize(links.filter("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()

    before = mark(now)
    for _ in range(rounds):
        if not before["n"]:
            break
        now = materialize(_hang(_hang(now, True), False), "links")
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
