"""Phrases against brute-force counts, small shards, exact scores and the index by itself."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import collocations

from .fixtures import awkward_texts, empty, rows

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(table, longest=4, least=30, share=80, top=2000):
    f, total = Counter(), Counter()
    for lang, text in table:
        lang = lang if lang is not None else "und"
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[\x20\x09]", piece) if w]
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    out = []
    frequent = {k: n for k, n in f.items() if n >= least}
    inside = Counter()
    for (lang, p), n in frequent.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                inside[lang, p[i:i + size]] = max(n, inside[lang, p[i:i + size]])
    for (lang, p), a in frequent.items():
        if len(p) > 1 and 100 * inside[lang, p] < share * a or len(p) == longest:
            s, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], total[lang], s))
    ranked = []
    for lang in {o[0] for o in out}:
        mine = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        ranked += [(lang, i + 1, *o[1:]) for i, o in enumerate(mine[:top])]
    return sorted(ranked)


def table(n: int, seed: int = 1):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "ABC", "a\x00b", "x y"]
    def text():
        return "".join(r.choice(words[:r.choice([3, 16])]) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"])
                       for _ in range(r.randrange(60)))
    langs = ["en", "en", "en", "de", None, "und"]
    return [(r.choice(langs), text()) for _ in range(n)] + [("en", None), ("en", ""), (None, None), ("xx", "once only")]


def frame(spark, rows_):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows_)], "doc_id long, lang string, text string")
    for c in ("phrase", "f", "size", "rank", "a", "n", "part", "k"):
        df = df.withColumn(c, F.lit("mine"))
    return df.repartition(4, "doc_id")


@pytest.mark.parametrize("shard,held,counts", [(1 << 20, 3 << 20, 500_000), (500, 4000, 20), (7, 9000, 300)])
def test_collocations_equal_brute_force(spark, monkeypatch, shard, held, counts):
    monkeypatch.setattr(collocations, "SHARD_WORDS", shard)
    monkeypatch.setattr(collocations, "HELD_WORDS", held)
    monkeypatch.setattr(collocations, "HELD_COUNTS", counts)
    data = table(2500) + [(None, t) for t in awkward_texts()] + [("de", "same words here again. " * 40)] * 2
    got = sorted(tuple(r) for r in collocations.collocations(frame(spark, data)).collect())
    assert got == brute(data)
    assert len(got) > 100


@pytest.mark.parametrize("longest,least,share,top", [(2, 10, 80, 5), (3, 2, 50, 2000), (5, 6, 80, 30)])
def test_other_parameters(spark, longest, least, share, top):
    data = table(150, 3)
    got = sorted(tuple(r) for r in collocations.collocations(frame(spark, data), longest, least, share, top).collect())
    assert got == brute(data, longest, least, share, top)


def test_wrong_hits_of_the_bit_table_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations.Known, "has", lambda self, words: np.ones(len(words) - self.size + 1, bool))
    data = table(200, 4)
    got = sorted(tuple(r) for r in collocations.collocations(frame(spark, data)).collect())
    assert got == brute(data)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    counts = spark.createDataFrame([("en", "a", big, 1), ("en", "b", big - 1, 1), ("en", "a b", big - 7, 2)],
                                   "lang string, phrase string, f long, size int")
    (r,) = collocations.scored(counts).collect()
    assert r["score"] == 2000000 * (big - 7) // (big + big - 1)


def test_extensions_of_both_sides(spark):
    counts = spark.createDataFrame(
        [("en", "b c", 50, 2), ("en", "a b c", 41, 3), ("en", "x b c", 9, 3), ("en", "b c d", 30, 3), ("en", "b", 60, 1)],
        "lang string, phrase string, f long, size int")
    got = {r["phrase"]: (r["left"], r["right"]) for r in collocations.extensions(counts).collect()}
    assert got["b c"] == (41, 30) and got["a b"] == (None, 41) and got["c d"] == (30, None)


def test_both_directions_of_the_index_agree():
    r = np.random.default_rng(2)
    text = r.integers(0, 6, 400)
    text[0] = text[-1] = 0
    index = collocations.BiIndex(text, np.ones(400, np.int64), 4)

    def starts(p):
        return [i for i in range(400 - len(p) + 1) if tuple(text[i:i + len(p)]) == p]

    level = {(int(s),): (a, b, n) for s, a, b, n in zip(*index.symbols())}
    for step, right in ((2, True), (3, False), (4, True)):
        known = list(level)
        ahead, back, size = (np.array([level[p][j] for p in known]) for j in range(3))
        if right:
            phrase, symbol, b, a, n = index.extend(True, back, ahead, size)
        else:
            phrase, symbol, a, b, n = index.extend(False, ahead, back, size)
        level = {}
        for i in range(len(n)):
            p = known[phrase[i]] + (int(symbol[i]),) if right else (int(symbol[i]),) + known[phrase[i]]
            level[p] = a[i], b[i], n[i]
            assert n[i] == len(starts(p)) > 0
            order = collocations.rotation_order(text, 4)
            assert sorted(order[a[i]:a[i] + n[i]]) == starts(p)
        want = {tuple(map(int, text[i:i + step])) for i in range(400 - step + 1) if 0 not in text[i:i + step]}
        assert set(level) == want


def test_wide_symbols_sort():
    r = np.random.default_rng(3)
    text = r.integers(0, 200_000, 3000)
    order = collocations.rotation_order(text, 2)
    keys = [(text[i], text[(i + 1) % 3000]) for i in order]
    assert keys == sorted(keys)


def test_nothing(spark):
    assert rows(collocations.collocations(empty(spark))) == []
