"""Quality rules, line dedup, URL filters and mixing: SQL twins, brute force, edge rows."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsflow.checks.compare import compare
from newsflow.llm import line_dedup, mixing, quality_rules, url_filter
from newsflow.llm.queries import ORACLE, QUERIES

from ..conftest import SF_SMALL
from .fixtures import CLASH, documents, empty, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, duck_small, name):
    got = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE[name], duck_small)
    assert got["value_match"], got


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        dup += bool(WORD.search(line)) and line in seen
        seen.add(line)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered))


def test_measures_equal_brute_force(spark):
    df = documents(spark)
    got = rows(quality_rules.base_metrics(df), "doc_id", *quality_rules.METRICS)
    want = sorted(((r.doc_id, *brute_measures(r.text)) for r in df.collect()),
                  key=lambda t: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in t))
    assert got == want
    assert quality_rules.measure("a b c a b c # <x>\nq\nq\n\n") == (10, 12, 3, 1, 6)


def test_bad_host_is_blocked_and_small_hosts_are_shrunk(spark):
    good = " ".join(f"w{i}" for i in range(60))
    data = [(i, good if i % 10 else "short", f"good{i % 8}") for i in range(400)]
    data += [(1000 + i, "short" if i < 190 else good, "bad") for i in range(200)]
    data += [(2000, "short", "tiny"), (2001, good, "tiny"), (2002, good, None)]
    out = quality_rules.judge(spark.createDataFrame(data, "doc_id long, text string, source string"))
    by_host = {r.host: r for r in out.select("host", "host_rate", "host_blocked").distinct().collect()}
    assert by_host["bad"].host_blocked and not any(r.host_blocked for h, r in by_host.items() if h != "bad")
    assert by_host["tiny"].host_rate < 0.5 < by_host["bad"].host_rate < 0.95
    assert out.filter("host = 'bad' and kept").count() == 0
    assert out.filter("doc_id = 2002").first().kept
    assert out.count() == len(data)


def test_rules_take_empty_tables(spark):
    assert quality_rules.judge(empty(spark)).count() == 0


def brute_lines(docs, min_docs):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    where = {}
    for r in docs:
        for line in (r.text or "").split("\n"):
            if key(line):
                where.setdefault(key(line), set()).add(r.doc_id)
    out = []
    for r in docs:
        lines = (r.text or "").split("\n")
        kept = [x for x in lines if len(where.get(key(x), ())) < min_docs]
        out.append((r.doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("min_docs", [1, 2, 3])
def test_lines_equal_brute_force(spark, min_docs):
    df = documents(spark)
    got = rows(line_dedup.drop_frequent_lines(df, min_docs), "doc_id", "n_lines", "n_dropped", "text")
    want = sorted(brute_lines(df.collect(), min_docs),
                  key=lambda t: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in t))
    assert got == want


def test_lines_keep_columns_and_empty_tables(spark):
    out = line_dedup.drop_frequent_lines(documents(spark, clash=True), 2)
    assert out.columns == documents(spark, clash=True).columns + ["n_lines", "n_dropped"]
    assert {tuple(r) for r in out.select(*CLASH).collect()} == {("mine",) * len(CLASH)}
    assert line_dedup.line_digest(empty(spark)).count() == 0
    digest = line_dedup.line_digest(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()
    assert tuple(digest) == (1, 1, 0, hashlib.sha256(b"").hexdigest())


def test_lines_are_native(spark):
    plan = line_dedup.line_digest(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


URLS = [None, "", "nothing", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/1?x=/fr/",
        "https://example.com/en/", "https://a.example.com/en/x#y", "https://a.example.com/fr/en/", "http://x.net/es/1",
        "http://net/fr/", "http://x.net/en/", "http://notcom/", "http://examplexcom/en/", "http://x.com?/en/",
        "http://x.com:80/a", "://com/", "a://b://com/", "http://x.net/es", "http://x..com/", "http://.com/"]


def brute_url(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [(len(h) + len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls_equal_brute_force(spark):
    data = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[7]), (None, URLS[7]), (7, URLS[7])]
    pages = spark.createDataFrame(data, "page_id long, url string")
    for c in CLASH:
        pages = pages.withColumn(c, F.lit("mine"))
    out = url_filter.judge(pages, url_filter.rule_table(spark))
    got = sorted(out.select("page_id", "url", "host", "path", "rule", "verdict").collect(), key=str)
    want = sorted(((i, u, *brute_url(u, url_filter.RULES)) for i, u in data), key=lambda t: str(t))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert out.filter("rate <> 'mine'").count() == 0


def test_urls_longest_rule_wins_ties_and_empty_tables(spark):
    rules = [("b.com", "/x/", "allow"), ("b.com", "/x/", "block"), ("com", "/", "allow"), (None, "/", "block"),
             ("", "/", "block"), ("b.com", None, "block")]
    pages = spark.createDataFrame([(1, "http://a.b.com/x/y"), (2, "http://c.com/x/y")], "page_id long, url string")
    out = url_filter.judge(pages, url_filter.rule_table(spark, rules))
    assert rows(out, "page_id", "rule", "verdict") == [(1, "b.com/x/", "block"), (2, "com/", "allow")]
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark)).count() == 0
    none = url_filter.judge(pages, url_filter.rule_table(spark, rules).limit(0), default="block")
    assert rows(none, "page_id", "rule", "verdict") == [(1, None, "block"), (2, None, "block")]


def test_poisson_draws_follow_the_distribution(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 10, "rare").when(
        F.col("id") < 6_000, "small").otherwise("large").alias("source"))
    out = mixing.replicate(docs, {"rare": 1.0, "small": 2.0, "large": 1.0}).cache()
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    for source, want in (("rare", 5_000), ("small", 10_000), ("large", 5_000)):
        assert abs(n[source] - want) < 5 * math.sqrt(want)
    # each document's count is Poisson: mean and variance agree
    counts = [r["count"] for r in out.filter("source = 'small'").groupBy("doc_id").count().collect()]
    counts += [0] * (5_990 - len(counts))
    mean = sum(counts) / len(counts)
    assert abs(sum((c - mean) ** 2 for c in counts) / len(counts) / mean - 1) < 0.1
    assert out.count() == out.select("doc_id", "copy").distinct().count()
    assert rows(mixing.mix(docs.limit(50))) == rows(mixing.mix(docs.limit(50)))


def test_mix_edges(spark):
    out = mixing.mix(documents(spark, clash=True))
    assert out.columns == [c for c in documents(spark, clash=True).columns if c != "copy"] + ["copy", "shuffle_key"]
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mix(documents(spark), {"nowhere": 1.0}).count() == 0
    assert {r.source for r in mixing.mix(documents(spark), {None: 1.0}, size=50.0).select("source").collect()} == {None}
    both = documents(spark)
    few, mixing.BROADCAST_SOURCES = mixing.BROADCAST_SOURCES, 0
    try:
        salted = rows(mixing.mix(both), "doc_id", "copy", "shuffle_key")
    finally:
        mixing.BROADCAST_SOURCES = few
    assert salted == rows(mixing.mix(both), "doc_id", "copy", "shuffle_key")
