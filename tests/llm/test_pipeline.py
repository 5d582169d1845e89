"""The corpus pipeline against brute force, stage by stage, on a small fixture."""

import os
import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import mixing, toxicity
from newsflow.llm.queries import QUERIES

from .fixtures import DOC_SCHEMA, edited, empty, prose
from .test_duplicates import brute_best, brute_components, toks
from .test_rules_lines_urls import brute_lines

ITEM = prose(900, 40)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder of tables: clean and toxic texts, common lines, copies, near copies, a leak, awkward rows."""
    r = random.Random(4)
    texts = []
    for i in range(120):
        t = prose(1000 + i, 60 + i % 30)
        if i % 5 == 0:
            words = t.split()
            words[r.randrange(len(words))] = r.choice(["vermin", "wretch"])
            t = " ".join(words)
        texts.append(t)
    texts += [f"a very common line\n{prose(2000 + i, 50)}" for i in range(12)]
    texts += [texts[1], texts[2], edited(texts[3], 80, 7), edited(texts[4], 9, 7)]
    texts += [prose(3000, 20) + " " + ITEM + " " + prose(3001, 20), None, "", "\n", texts[1].upper()]
    rows = [(i, t, "en", f"s{0 if i % 3 else i % 7}", None if t is None else len(t)) for i, t in enumerate(texts)]
    labels = [(i, 1, int(i < 120 and i % 5 == 0)) for i in range(130)]
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, rows


def brute_pipeline(rows):
    """doc_id -> text after the four filtering stages."""
    docs = [(d, t) for d, t, *_ in rows if not {"vermin", "wretch"} & set((t or "").split())]
    row = type("Row", (), {})

    def as_row(d, t):
        x = row()
        x.doc_id, x.text = d, t
        return x

    lines = brute_lines([as_row(d, t) for d, t in docs], 10)
    docs = [(d, text if n else t or "") for (d, _, n, text), (_, t) in zip(lines, docs)]
    component = brute_components(docs, 80)
    docs = [(d, t) for d, t in docs if component[d] == d]
    return {d: t for d, t in docs if brute_best(toks(t), toks(ITEM)) < 13}


def test_pipeline_equals_brute_force(spark, corpus):
    at, rows = corpus
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near-duplicates", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, at)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = brute_pipeline(rows)
    assert {r.doc_id: r.text for r in docs.collect()} == want
    assert all(r.n_chars == len(r.text) for r in docs.collect() if r.n_chars is not None)
    out = corpus_pipeline.run(spark, at).cache()
    again = mixing.mix(docs.select(corpus_pipeline.COLUMNS))
    assert sorted(map(tuple, out.select("doc_id", "copy", "shuffle_key").collect())) == sorted(
        map(tuple, again.select("doc_id", "copy", "shuffle_key").collect()))
    assert {r.doc_id for r in out.collect()} <= set(want)
    assert all(want[r.doc_id] == r.text for r in out.collect())


def test_pipeline_takes_an_empty_table(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    empty(spark, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    empty(spark, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_mix_query_moves_whole_documents(spark, corpus):
    at, rows = corpus
    out = QUERIES["op10_poisson_mix"](spark, at)
    assert out.columns == ["doc_id", "source", "copy", "shuffle_key"]
    written = spark.read.parquet(os.path.dirname(out.inputFiles()[0]))
    assert set(corpus_pipeline.COLUMNS) < set(written.columns)
    texts = {d: t for d, t, *_ in rows}
    assert all(texts[r.doc_id] == r.text for r in written.select("doc_id", "text").collect())
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, written.select(*out.columns).collect()), key=str)


def test_toxic_stage_learns_the_planted_words(spark, corpus):
    at, _ = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{at}/labels.parquet"))
    assert np.all(model.scores(["a vermin b"]) > 0.5) and np.all(model.scores(["a b", None, ""]) < 0.5)
    assert docs.filter(F.col("text").contains("vermin")).count() > 0
