"""Mixing sources to target weights by Poisson replication.

A source with target share ``w`` and ``n`` documents gets the mean repetition
rate ``w * total / n``.  Each document draws its number of copies from a Poisson
distribution of that mean by inverting the distribution at a uniform number
hashed from the seed and ``doc_id``; copies are exploded and put into a global
order by a hash of (seed, doc_id, copy).  Sampling is the feature: a rate below
one drops documents, a rate above one repeats them.

Rates above ``SPAN`` are drawn as a sum of independent draws of smaller rate,
which is exact, so no rate makes a long table or a row of unbounded size.
A null source is a source of its own.  Rows that share ``doc_id`` draw alike.
Sources with no or a non-positive weight get no copies.  An empty table gives an
empty result.  All columns of the input are kept
(``copy`` and ``shuffle_key`` are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import packed, unpacked

SPAN = 16.0               # largest rate of one draw
BROADCAST_SOURCES = 100_000   # a rate table of at most so many rows (a few MB) is broadcast
SALTS = 32


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 13 hex digits of an md5: exact in a double."""
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_inverse(u: Column, rate: Column) -> Column:
    """Smallest k whose cumulative Poisson probability exceeds ``u``, for rates of at most ``SPAN``."""
    top = int(SPAN + 12 * SPAN**0.5 + 20)
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.lit(0).alias("k"))
    end = F.aggregate(
        F.sequence(F.lit(1), F.lit(top)), start,
        lambda s, k: F.when(s["c"] > u, s).otherwise(F.struct(
            (s["p"] * rate / k).alias("p"), (s["c"] + s["p"] * rate / k).alias("c"), k.alias("k"))))
    return end["k"]


def rates(docs: DataFrame, weights: dict | None = None, size: float = 1.0) -> DataFrame:
    """source, rate: one row per source.  ``weights``: source -> weight (None: equal weights);
    ``size``: expected documents in the mix as a multiple of the input's."""
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counts = counts.withColumn("w", F.lit(1.0))
    else:
        pairs = [x for k, v in weights.items() if k is not None for x in (F.lit(k), F.lit(float(v)))]
        own = F.element_at(F.create_map(*pairs), F.col("source")) if pairs else F.lit(None).cast("double")
        counts = counts.withColumn("w", F.when(F.col("source").isNull(), F.lit(float(weights.get(None, 0.0))))
                                   .otherwise(F.coalesce(own, F.lit(0.0))))
    counts = materialize(counts.withColumn("w", F.greatest(F.col("w"), F.lit(0.0))), "source-counts")
    total = counts.agg(F.sum("n").alias("total_n"), F.sum("w").alias("total_w"))
    return counts.crossJoin(F.broadcast(total)).select(  # one row of totals
        "source", F.when(F.col("total_w") > 0, F.col("w") / F.col("total_w") * F.col("total_n") * F.lit(float(size))
                         / F.col("n")).otherwise(0.0).alias("rate"))


def replicate(docs: DataFrame, weights: dict | None = None, size: float = 1.0, seed: int = 42) -> DataFrame:
    """``docs`` with each row repeated by its draw, plus ``copy`` (long, from 0) and ``shuffle_key`` (long)."""
    table = materialize(rates(docs, weights, size), "source-rates")
    rows = packed(docs)
    if table.count() <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(table), F.col("row.source").eqNullSafe(F.col("source")))
    else:
        salted = table.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])))
        joined = rows.join(salted, F.col("row.source").eqNullSafe(F.col("source")) &
                           (F.pmod(F.xxhash64("row.doc_id"), F.lit(SALTS)) == F.col("salt")))
    joined = joined.select("row", "rate", F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null")).alias("ident"),
                           F.greatest(F.lit(1), F.ceil(F.col("rate") / SPAN)).cast("int").alias("draws"))
    parts = joined.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("draws") - 1)))
    parts = parts.withColumn("u", uniform(F.lit(str(seed)), F.col("ident"), F.col("part").cast("string")))
    parts = parts.withColumn("k", poisson_inverse(F.col("u"), F.col("rate") / F.col("draws"))).filter("k > 0")
    # copies of part p are numbered from p * 2^20 on; one draw of a rate up to SPAN stays far below that
    out = parts.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumn(
        "copy", F.col("part").cast("long") * (1 << 20) + F.col("j"))
    order = F.md5(F.concat_ws("|", F.lit(f"{seed}s"), F.col("ident"), F.col("copy").cast("string")))
    return out.select(*unpacked(docs, "copy", "shuffle_key"), "copy",
                      F.conv(F.substring(order, 1, 15), 16, 10).cast("long").alias("shuffle_key"))


def mix(docs: DataFrame, weights: dict | None = None, size: float = 1.0, seed: int = 42) -> DataFrame:
    """``replicate`` in a global random order: partition k holds a hashed share, ordered by ``shuffle_key``."""
    out = replicate(docs, weights, size, seed)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartition(n, "shuffle_key").sortWithinPartitions("shuffle_key", "doc_id")


ORACLE = """
with recursive n as (select source, count(*) as n from documents group by source),
t as (select sum(n) as total, count(*) as sources from n),
r as (select source, 1.0::double / sources * total * 1.0::double / n as rate from n, t),
parts as (
  select d.doc_id, d.source, r.rate, greatest(1, ceil(r.rate / 16.0::double))::int as draws
  from documents d join r on d.source is not distinct from r.source),
u as (
  select doc_id, source, part, rate / draws as rate,
         ('0x' || substr(md5('42|' || doc_id || '|' || part), 1, 13))::bigint::double / 4503599627370496.0 as u
  from (select *, unnest(range(0, draws)) as part from parts)),
steps as (
  select doc_id, source, part, rate, u, 0 as k, exp(-rate) as p, exp(-rate) as c from u
  union all
  select doc_id, source, part, rate, u, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) from steps
  where c <= u and k < 84),
k as (select doc_id, source, part, max(k) as k from steps group by all)
select doc_id, source, part::bigint * 1048576 + copy as copy,
       ('0x' || substr(md5('42s|' || doc_id || '|' || (part::bigint * 1048576 + copy)), 1, 15))::bigint as shuffle_key
from (select *, unnest(range(0, k)) as copy from k where k > 0)
"""
