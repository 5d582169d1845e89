"""Steps whose time, shuffle or memory must not outgrow the input."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsflow.checks import fixtures
from newsflow.functions.text import preprocess
from newsflow.operators import tfidf_nb
from newsflow.streaming import dedupe, ingest
from newsflow.streaming.sources import article_stream

from .test_plans import plan


def test_letters_are_kept_as_by_the_plain_class(spark):
    """a class that Java matches fast keeps the same characters."""
    odd = ["A-béCİK kſ\x0b\x0c\r\n\t  x", "", "1 2  3", "a\x1cb\x85c\U0001F600D", None, "ÄÖ ZZ[]^_`@{"]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    old = F.regexp_replace(F.regexp_replace(F.lower("t"), r"[^a-zA-Z\s]", ""), r"\s+", " ")
    got = df.select(preprocess("t").alias("new"), old.alias("old"))
    assert all(r["new"] == r["old"] for r in got.collect())
    assert r"a-zA-Z\s" not in plan(df.select(preprocess("t")))


def test_scoring_shuffles_terms_of_blocks(spark):
    """no exchange of every document's tokens; a repeated or NULL key and a NULL text score as before."""
    train = spark.createDataFrame([(str(i), ("alpha beta " if i % 2 else "gamma delta ") * 5 + f"w{i}", float(i % 2))
                                   for i in range(20)], "article_id string, content string, label double")
    model = tfidf_nb.fit(train, min_doc_freq=1)
    docs = spark.createDataFrame([("x", "alpha  gamma beta", 2 ** 60 + 1), ("x", "alpha", 2 ** 60 + 1), (None, "delta", None),
                                  ("y", None, 3), ("z", "unknown", 4)], "article_id string, content string, n long")
    pred = model.predict(docs, key=("article_id", "n"))
    assert not re.search(r"hashpartitioning\(article_id[^)]*term", plan(pred))
    w = {r["term"]: (r["w0"], r["w1"]) for r in model.weights.collect()}
    got = {(r["article_id"], r["n"]): (r["score0"], r["score1"]) for r in pred.collect()}
    expected = {("x", 2 ** 60 + 1): ["alpha", "gamma", "beta", "alpha"], (None, None): ["delta"], ("y", 3): [], ("z", 4): []}
    assert set(got) == set(expected)
    for k, terms in expected.items():
        for i, prior in enumerate((model.pi0, model.pi1)):
            assert got[k][i] == pytest.approx(prior + sum(w[t][i] for t in terms), abs=1e-12)


def test_prediction_texts_are_shuffled_once(spark, tmp_path):
    """the texts go to the join's exchange, not to one of their own before it, nor to another for the write."""
    body = "some words of an article that is long enough to be used "
    spark.createDataFrame([(i, f"title {i}\n{body}{'good ' if i % 2 else 'bad '}", "s") for i in range(40)],
                          "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert "hashpartitioning(doc_id" not in plan(fixtures.prediction_rows(spark, str(tmp_path)))
    back = spark.read.parquet(fixtures.prediction_dataset(spark, str(tmp_path)))
    assert back.count() == 40 and back.select("title").distinct().count() == 40


class State:
    exists, hasTimedOut, get, timeout, now = False, False, None, None, 0

    def update(self, value):
        self.exists, self.get = True, value

    def setTimeoutTimestamp(self, at):
        self.timeout = at

    def getCurrentWatermarkMs(self):
        return self.now

    def remove(self):
        self.exists = False


def test_titles_of_a_bucket_share_a_group(spark):
    """a bucket's titles are decided together, each by its own sessions and until its own time."""
    state, decide = State(), dedupe._decide_bucket(60, 5000, ["article_id"])

    def send(*rows, arrived=0):
        df = pd.DataFrame([(k, at, at, i, 0, arrived) for k, at, i in rows],
                          columns=["key", "at", "until", "article_id", "tie", "arrived"])
        return sorted(i for out in decide((1,), iter([df[:1], df[1:]]), state) for i in out["article_id"])

    assert send(("tA", 10, "a1"), ("tB", 10, "b1"), ("tA", 0, "a0"), ("u1", 0, "n"), ("u1", 0, "n2")) == ["a0", "b1", "n", "n2"]
    assert state.timeout == 5 and sorted(state.get[0]) == ["tA", "tB"]
    assert send(("tA", 40, "a2"), ("tC", 0, "c0"), ("tB", 500, "b2"), arrived=9) == ["b2", "c0"]
    state.now = 10
    assert send(("tC", 900, "c1"), arrived=11) == ["c1"] and state.timeout == 14
    state.now, state.hasTimedOut = 15, True
    assert list(decide((1,), iter([]), state)) == [] and set(state.get[0]) == {"tC"} and state.timeout == 16
    state.now = 17
    assert list(decide((1,), iter([]), state)) == [] and not state.exists
    state.hasTimedOut = False
    assert send(("u1", 0, "n"), arrived=20) == ["n"] and not state.exists


def test_workers_of_the_deduped_stream_hold_few_rows(spark, tmp_path, monkeypatch):
    """the stream starts with small Arrow batches; the session keeps its own setting."""
    import json
    value = json.dumps({"title": "A", "text": "word " * 40, "subject": "s", "date": "d", "article_id": "1"})
    spark.createDataFrame([(None, value)], "key string, value string").write.json(f"{tmp_path}/src")
    before, seen, start = spark.conf.get(dedupe.ARROW_ROWS), {}, ingest.start

    def started(writer, checkpoint, *args):
        seen[checkpoint.rsplit("/", 1)[1]] = int(spark.conf.get(dedupe.ARROW_ROWS))
        return start(writer, checkpoint, *args)

    monkeypatch.setattr(ingest, "start", started)
    for q in ingest.start_ingest(article_stream(spark, "json", f"{tmp_path}/src"), f"{tmp_path}/out", f"{tmp_path}/ckpt",
                                 available_now=True, dedupe=True):
        q.awaitTermination()
    assert seen["deduped"] <= 1000 and spark.conf.get(dedupe.ARROW_ROWS) == before
