"""Quality rules: base rules per document, judged again per host.

Every document is measured on its whole text and held against the base rules.
Failures are added up by host (here ``source``); the failure rate of a host is
shrunk towards all hosts with a beta prior whose two parameters are fitted to
the hosts by moments (empirical Bayes); a host whose shrunk rate is above
``max_rate`` by two standard deviations of its posterior is blocked, and the
verdict is joined back to its documents.

A null text has no words (and fails the base rules).  Null hosts are one host.
Rows are judged one by one, so repeated rows stay.  Empty tables give empty
results; a single host or hosts without spread get the pooled rate.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import map_column
from .words import to_bytes

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
SALTS = 16
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list, size: int = 3) -> int:
    """Words covered by ``size``-word windows that occur twice or more in ``words``."""
    grams = list(zip(*(words[i:] for i in range(size))))
    often = {g for g, n in Counter(grams).items() if n > 1}
    if not often:
        return 0
    covered, to = 0, 0
    for at, g in enumerate(grams):
        if g in often:
            covered += at + size - max(at, to)
            to = at + size
    return covered


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            n += bool(line.split())
        else:
            seen.add(line)
    return n


def measure(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    data = to_bytes(text)
    words = data.split()
    chars = len(b"".join(words).decode("utf-8", "surrogatepass"))      # code points
    return (len(words), chars, sum(map(data.count, (SYMBOLS[i:i + 1] for i in range(len(SYMBOLS))))),
            duplicate_lines(data), repeat_words(words))


def _measure_all(texts: list) -> dict:
    return dict(zip(METRICS, zip(*map(measure, texts)))) if texts else {n: [] for n in METRICS}


def base_metrics(docs: DataFrame, host: str = "source") -> DataFrame:
    """The measures and ``base_failed`` of each row of ``docs``."""
    out = map_column(docs.select("doc_id", F.col(host).alias("host"), "text"), ["doc_id", "host"], "text", _measure_all,
                     dict.fromkeys(METRICS, "long"))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) |
                          (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_verdicts(judged: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, host_docs, host_failed, host_rate (shrunk), host_blocked from rows with ``host``, ``base_failed``."""
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("x"))
    hosts = materialize(hosts, "hosts")
    # method of moments: spread of the hosts' rates beyond what binomial noise gives
    sums = hosts.agg(F.sum("n").alias("sn"), F.sum("x").alias("sx"), F.count(F.lit(1)).alias("h"),
                     F.sum(F.col("x") * F.col("x") / F.col("n")).alias("sxx"))
    mean = F.col("sx") / F.col("sn")
    spread = F.col("sxx") / F.col("sn") - mean * mean - mean * (1 - mean) * F.col("h") / F.col("sn")
    strength = F.when(spread > 0, mean * (1 - mean) / spread - 1).otherwise(F.col("sn").cast("double"))
    prior = sums.select(mean.alias("m"), F.greatest(F.lit(1.0), F.least(strength, F.col("sn").cast("double"))).alias("s"))
    rate = (F.col("x") + F.col("m") * F.col("s")) / (F.col("n") + F.col("s"))
    deviation = F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (F.col("n") + F.col("s") + 1))
    return hosts.crossJoin(F.broadcast(prior)).withColumn("host_rate", rate).select(  # one row of prior
        "host", F.col("n").alias("host_docs"), F.col("x").alias("host_failed"), "host_rate",
        (F.col("host_rate") - 2 * deviation > max_rate).alias("host_blocked"))


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Measures, ``base_failed``, the host's counts and verdict, and ``kept`` of each row of ``docs``."""
    judged = materialize(base_metrics(docs, host), "base-metrics")
    verdicts = host_verdicts(judged, max_rate)
    # a host may have a third of all rows: verdicts are repeated for each salt
    salted = verdicts.withColumnRenamed("host", "v_host").withColumn(
        "v_salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])))
    out = judged.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words"), F.lit(SALTS))).join(
        salted, F.col("host").eqNullSafe(F.col("v_host")) & (F.col("salt") == F.col("v_salt")), "left")
    return out.drop("salt", "v_salt", "v_host").withColumn("kept", ~F.col("base_failed") & ~F.col("host_blocked"))


ORACLE = r"""
with w as (
  select doc_id, source as host, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
gram as (
  select doc_id, pos, words[pos:pos + 2] as g from (select *, unnest(range(1, len(words) - 1)) as pos from w)),
often as (
  select doc_id, pos from (select *, count(*) over (partition by doc_id, g) as n from gram) where n > 1),
covered as (
  select doc_id, count(distinct pos + j) as n from (select *, unnest(range(0, 3)) as j from often) group by doc_id),
line as (
  select doc_id, unnest(string_split(t, chr(10))) as line from w),
dup as (
  select doc_id, sum(n - 1) as n from (
    select doc_id, line, count(*) as n from line where regexp_matches(line, '[^\x20\x09-\x0D]') group by all)
  group by doc_id),
base as (
  select w.doc_id, host, len(words)::bigint as n_words,
         length(array_to_string(words, ''))::bigint as word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols,
         coalesce(dup.n, 0)::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words
  from w left join dup using (doc_id) left join covered using (doc_id)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base),
h as (
  select host, count(*)::bigint as n, sum(base_failed::int)::bigint as x from judged group by host),
m as (
  select sum(x)::double / sum(n) as m, sum(n)::double as sn, count(*) as hosts, sum(x::double * x / n) as sxx from h),
prior as (
  select m, greatest(1.0, least(sn, case when sxx / sn - m * m - m * (1 - m) * hosts / sn > 0
    then m * (1 - m) / (sxx / sn - m * m - m * (1 - m) * hosts / sn) - 1 else sn end)) as s from m),
v as (
  select host, n as host_docs, x as host_failed, (x + m * s) / (n + s) as r, n + s as size from h, prior)
select j.doc_id, j.host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       host_docs, host_failed, r - 2 * sqrt(r * (1 - r) / (size + 1)) > 0.5 as host_blocked,
       not base_failed and not (r - 2 * sqrt(r * (1 - r) / (size + 1)) > 0.5) as kept
from judged j join v on j.host is not distinct from v.host
"""
