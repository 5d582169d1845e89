"""Line dedup: lines whose key occurs in many documents lose all their copies.

Native: explode normalised lines, hash, count distinct documents per hash,
drop, and reassemble by position.  Only 128-bit keys are exploded and counted;
the text itself moves once, to meet the positions it loses.

A row is identified by ``doc_id`` and its text's hash.  Rows with equal
``doc_id`` count as one document; a null ``doc_id`` is one document too.  A null
or empty text is one empty line.  Empty tables give empty results.  Columns
besides ``doc_id`` and ``text`` are kept as they are (``n_lines`` and ``n_dropped``
are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import packed, text_key

SPACE = " \t\n\x0b\x0c\r"
SALTS = 8                 # tasks that the lines of one frequent key are spread over
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _positions(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, rk, k1, k2, at: the 128-bit key of each line of at least ``min_chars``."""
    lines = docs.select("doc_id", text_key().alias("rk"),
                        F.posexplode(F.transform(split_lines(F.col("text")), line_key)).alias("at", "key"))
    return lines.filter(F.char_length("key") >= min_chars).select(
        "doc_id", "rk", "at", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit("b"), "key").alias("k2"))


def frequent_keys(positions: DataFrame, min_docs: int) -> DataFrame:
    """Keys of at least ``min_docs`` documents.  Pairs (key, document) are made distinct first, so that
    a hot key is spread over its documents and then combined on the map side."""
    return (positions.select("k1", "k2", "doc_id").distinct()
            .groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs).select("k1", "k2"))


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with ``text`` rebuilt from the lines that stay, and ``n_lines``, ``n_dropped`` (long)."""
    positions = _positions(docs, min_chars)
    # a line of a third of all documents would meet its key in one task: keys are repeated for each salt
    keys = frequent_keys(positions, min_docs).withColumn(
        "salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])))
    lost = (positions.withColumn("salt", F.pmod(F.xxhash64("doc_id", "rk"), F.lit(SALTS)))
            .join(keys, ["k1", "k2", "salt"], "left_semi")
            .groupBy(F.col("doc_id").alias("lost_id"), F.col("rk").alias("lost_rk"))
            .agg(F.collect_set("at").alias("lost_at")))
    keyed = packed(docs).withColumn("rk", text_key(F.col("row.text")))
    joined = keyed.join(lost, F.col("row.doc_id").eqNullSafe(F.col("lost_id")) & (F.col("rk") == F.col("lost_rk")), "left")
    # the lines are a column of their own, so that they are split once and not for each position
    joined = joined.select("row", "lost_at", split_lines(F.col("row.text")).alias("lines"))
    n = F.size("lines")
    # array_except hashes, so a long document costs linear time
    kept = F.transform(F.array_except(F.sequence(F.lit(0), n - 1), F.col("lost_at")), lambda at: F.get(F.col("lines"), at))
    text = F.when(F.col("lost_at").isNull(), F.coalesce("row.text", F.lit(""))).otherwise(F.array_join(kept, "\n"))
    out = joined.select("row", text.alias("new_text"), n.cast("long").alias("n_lines"),
                        F.coalesce(F.size("lost_at"), F.lit(0)).cast("long").alias("n_dropped"))
    columns = [F.col("new_text").alias(c) if c.lower() == "text" else F.col("row")[c].alias(c)
               for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return out.select(*columns, "n_lines", "n_dropped")


def line_digest(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    out = drop_frequent_lines(docs.select("doc_id", "text"), min_docs, min_chars)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
hot as (select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(*) filter (key in (select key from hot)) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (key not in (select key from hot)), '')) as kept_sha256
from keyed group by doc_id
"""
