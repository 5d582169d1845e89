"""URL filters: host-suffix and path-prefix rules found by an equi-join on short hash prefixes.

Each URL is expanded into (host suffix, path prefix) expressions: a suffix at
every dot boundary of the host, a prefix at every length that a rule's path
has.  Expressions meet rules on the first four bytes of their SHA-256; the full
digest is then compared, and the longest fitting rule decides.  URLs without a
rule get ``default``.

Null URLs, and URLs without ``://``, have an empty host and path and fit no
rule.  Rows that repeat are judged once and given back as often as they came.
Ties between equally long rules: the longer host, then block before allow.
Rules with a null or empty host or a null path fit nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .line_dedup import LOWER, UPPER
from .tables import packed, unpacked

# (host, path, verdict): fixed values of the query.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
SALTS = 16


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``; columns of those
    names in ``pages`` are replaced."""
    rules = rules.filter("host <> '' and path is not null").select("host", "path", "verdict").distinct()
    # distinct lengths of rule paths: at most the longest path, whatever the number of rules
    lengths = [r[0] for r in rules.select(F.char_length("path")).distinct().collect()]
    urls = pages.select(F.col(url).alias("u_url")).filter(F.col("u_url").contains("://")).distinct().select(
        "u_url", url_host(F.col("u_url")).alias("u_host"), url_path(F.col("u_url")).alias("u_path"))
    labels = F.split("u_host", "\\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"),
                       lambda n: n <= F.char_length("u_path"))
    found = (urls.select("u_url", "u_path", F.explode(suffixes).alias("x_host"))
             .select("u_url", "x_host", F.explode(fitting).alias("n"), "u_path")
             .select("u_url", _digest(F.col("x_host"), F.expr("left(u_path, n)")).alias("x_digest"))
             .select("u_url", "x_digest", F.left("x_digest", F.lit(8)).alias("short"),
                     F.pmod(F.xxhash64("u_url"), F.lit(SALTS)).alias("salt")))
    # one rule may fit a third of all URLs: rules are repeated for each salt
    table = rules.select(_digest(F.col("host"), F.col("path")).alias("r_digest"),
                         F.char_length("host").alias("h"), F.char_length("path").alias("p"),
                         F.concat("host", "path").alias("r_rule"), F.col("verdict").alias("r_verdict"),
                         F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])).alias("salt"))
    table = table.withColumn("short", F.left("r_digest", F.lit(8)))
    best = (found.join(table, ["short", "salt"]).filter(F.col("x_digest") == F.col("r_digest"))
            .groupBy("u_url").agg(F.max(F.struct(
                (F.col("h") + F.col("p")).alias("len"), "h", (F.col("r_verdict") == "block").alias("block"),
                "r_rule", "r_verdict")).alias("best")))
    out = packed(pages).join(best, F.col("row")[url] == F.col("u_url"), "left")
    return out.select(*unpacked(pages, "host", "path", "rule", "verdict"), url_host(F.col("row")[url]).alias("host"),
                      url_path(F.col("row")[url]).alias("path"), F.col("best.r_rule").alias("rule"),
                      F.coalesce(F.col("best.r_verdict"), F.lit(default)).alias("verdict"))


ORACLE = r"""
with rules(rh, rp, rv) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parts as (
  select page_id, url,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
fit as (
  select distinct page_id, url, rh || rp as rule, rv,
         row_number() over (partition by page_id, url order by length(rh) + length(rp) desc, length(rh) desc) as k
  from parts join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp))
select p.page_id, p.host, p.path, f.rule, coalesce(f.rv, 'allow') as verdict
from parts p left join fit f on p.page_id = f.page_id and p.url = f.url and f.k = 1
"""
