"""Near-duplicates, repeated passages and benchmark leaks against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from newsflow.llm import decontaminate, fm_substring, setsketch
from newsflow.llm.components import components
from newsflow.llm.words import shingle_set, to_bytes, window_hashes, word_hashes
from newsflow.llm import words as W

from .fixtures import CLASH, awkward_texts, documents, edited, empty, prose, rows


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_components(docs, percent):
    """docs: (doc_id, text) -> doc_id -> smallest reachable doc_id."""
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: find(d) for d in parent}


def family(seed, copies, words=150):
    """A text and near copies with more and more edits, and copies of copies."""
    base = prose(seed, words)
    return [base] + [edited(base, every, seed + i) for i, every in enumerate(
        random.Random(seed).choices([200, 90, 75, 60, 45, 35, 28], k=copies))]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_brute_force(spark, percent):
    texts = awkward_texts() + [t for s in range(20, 26) for t in family(s, 25)]
    data = list(enumerate(texts))
    random.Random(1).shuffle(data)
    out = setsketch.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), percent)
    want = brute_components(data, percent)
    assert {r.doc_id: r.component_id for r in out.collect()} == want
    assert len(set(want.values())) < len(want) - 50
    for r in out.collect():
        assert r.n_shingles == len(shingles(texts[r.doc_id])) and r.kept == (r.doc_id == r.component_id)


def test_blocks_lose_no_link(spark):
    data = list(enumerate(family(40, 60)))
    block, setsketch.BLOCK = setsketch.BLOCK, 8
    try:
        out = setsketch.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 80).collect()
    finally:
        setsketch.BLOCK = block
    assert {r.doc_id: r.component_id for r in out} == brute_components(data, 80)


def variants(seed, n, words, own):
    """n texts that share a template of ``words`` words, each with ``own`` words of its own after it."""
    base = prose(seed, words)
    return [base + " " + " ".join(f"own{seed}x{i}x{k}" for k in range(own)) for i in range(n)]


def test_links_between_blocks_of_unlike_documents(spark, monkeypatch):
    # templates too unlike to be linked fill the buckets; each has one near copy, mostly in another block
    texts = variants(41, 30, 240, 50)
    data = list(enumerate(texts + [t + " tail" for t in texts]))
    monkeypatch.setattr(setsketch, "BLOCK", 3)
    out = setsketch.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 80).collect()
    want = brute_components(data, 80)
    assert len(set(want.values())) == 30
    assert {r.doc_id: r.component_id for r in out} == want


def test_rows_of_units_grow_with_the_documents(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 32)
    counts = []
    for n in (300, 600, 1200):
        seen, first, opened = [], setsketch._first_units, setsketch._open_units
        with monkeypatch.context() as m:
            m.setattr(setsketch, "_first_units", lambda member: seen.append(first(member)) or seen[-1])
            m.setattr(setsketch, "_open_units", lambda member, comp: seen.append(opened(member, comp)) or seen[-1])
            data = list(enumerate(variants(42, n, 60, 3)))
            out = setsketch.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), 80)
            assert {r.component_id for r in out.collect()} == {0}
        counts.append([u.count() for u in seen])
    for (a, x), (b, y) in zip(counts, counts[1:]):
        assert a < b < 2.2 * a and y < 2.2 * max(x, n)


def test_near_duplicate_edges(spark):
    out = setsketch.near_duplicates(documents(spark, clash=True), 80)
    assert out.count() == documents(spark).count()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.filter("doc_id is not null").collect()}
    assert got[0] == (0, 0, True) and got[1] == (0, 1, True) and got[4] == (1, 4, True)
    assert got[7][1:] == got[8][1:] == (6, False) and got[6][1:] == (6, True)
    assert {(r.component_id, r.kept) for r in out.filter("doc_id is null").collect()} == {(None, True)}
    assert setsketch.near_duplicates(empty(spark), 80).count() == 0
    # rows of one document link its texts
    a, b = prose(50, 40), prose(51, 40)
    data = [(5, a), (9, b), (3, b), (9, a)]
    assert {r.component_id for r in setsketch.near_duplicates(spark.createDataFrame(
        data, "doc_id long, text string"), 80).collect()} == {3}
    kept = setsketch.drop_near_duplicates(documents(spark, clash=True), 80)
    assert kept.columns == documents(spark, clash=True).columns
    assert {r.doc_id for r in kept.collect()} >= {0, 1, 4, 6, None} and kept.filter("doc_id in (7, 8, 9)").count() == 0


def test_registers_merge_and_estimate():
    a, b = (shingle_set(to_bytes(prose(s, 400)), 5) for s in (60, 61))
    m = 180
    union = np.union1d(a, b)
    assert (np.maximum(setsketch.registers(a, m), setsketch.registers(b, m)) == setsketch.registers(union, m)).all()
    rng = np.random.default_rng(3)
    for share, out in ((0.9, False), (0.4, True)):
        common = rng.integers(0, 2**63, int(2000 * share), dtype=np.uint64)
        x, y = (np.concatenate([common, rng.integers(0, 2**63, 2000 - len(common), dtype=np.uint64)]) for _ in "ab")
        r, s = setsketch.registers(x, m).astype(int), setsketch.registers(y, m).astype(int)
        n = np.array([2000.0])
        assert setsketch.ruled_out(np.array([(r > s).sum()]), np.array([(r < s).sum()]), m, n, n, 0.8)[0] == out


@pytest.mark.parametrize("percent", [80, 85])
def test_sets_contained_at_the_threshold_are_linked(spark, percent):
    data = []
    for i in range(1, 6):
        part, whole = 20 * i * percent // 100, 20 * i          # shingles
        for order in (1, -1):
            text = prose(1700 + len(data), whole + 4)
            pair = [text, " ".join(text.split()[:part + 4])][::order]
            data += [(1000 * percent + len(data) + k, t) for k, t in enumerate(pair)]
    want = brute_components(data, percent)
    assert len(set(want.values())) == len(data) // 2
    out = setsketch.near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), percent).collect()
    assert {r.doc_id: r.component_id for r in out} == want


def test_no_size_pair_at_the_threshold_is_ruled_out():
    m = 180
    for percent in (80, 85):
        large = np.arange(20, 4001, 20)
        small = large * percent // 100
        # a contained set exceeds the other in no register; the sets agree in about percent of them
        plus, minus = np.zeros(len(large), int), np.full(len(large), m - m * percent // 100)
        for n, k, more, less in ((small, large, plus, minus), (large, small, minus, plus)):
            assert not setsketch.ruled_out(more, less, m, n.astype(float), k.astype(float), percent / 100).any()
        assert setsketch.ruled_out(plus, minus, m, small - 1.0, large.astype(float), percent / 100).all()


def test_bands_reach_the_threshold():
    for t in (0.8, 0.85):
        assert (1 - t ** setsketch.ROWS) ** setsketch.bands_for(t) <= setsketch.MISS


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 3), (7, 6)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_word_hashes_do_not_depend_on_position_or_chunks(monkeypatch):
    text = prose(70, 3000).encode()
    whole = word_hashes(text)
    assert len(whole) == 3000 and len(set(whole.tolist())) == len(set(text.split()))
    assert (word_hashes(b" \n" + text)[:] == whole).all()
    monkeypatch.setattr(W, "CHUNK", 100)
    assert (word_hashes(text) == whole).all()
    assert len(word_hashes(b"x" * 1000)) == 1 and not len(word_hashes(b" \t ")) and not len(window_hashes(whole[:3], 5))


# ---------------------------------------------------------------- repeated passages

def brute_repeats(docs, size):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    where = {}
    for d, w in enumerate(words):
        for i in range(len(w) - size + 1):
            where.setdefault(tuple(w[i:i + size]), []).append((d, i))
    gone = [set() for _ in docs]
    for places in where.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + size))
    return [(docs[d][0], len(w), len(gone[d]), " ".join(x for i, x in enumerate(w) if i not in gone[d]))
            for d, w in enumerate(words)]


def passages():
    shared, other = prose(80, 60), prose(81, 90)
    texts = awkward_texts() + family(82, 12, 200) + [
        prose(90 + i, 30 + i) + "\n" + shared + " " + prose(120 + i, 5 + i) for i in range(12)]
    texts += [other + " " + other, " ".join(["loop"] * 50), " ".join(["loop"] * 34), " ".join("ab cd".split() * 40),
              shared[:200], prose(140, 35), prose(140, 35) + " tail", prose(141, 34), prose(141, 34)]
    return list(enumerate(texts))


def tuples(found):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in found), key=str)


@pytest.mark.parametrize("size", [35, 12])
def test_repeats_equal_brute_force(spark, size):
    data = passages()
    got = fm_substring.remove_repeats(spark.createDataFrame(data, "doc_id long, text string"), size).collect()
    assert tuples(got) == sorted(brute_repeats(data, size), key=str)


def test_repeats_with_hot_minimizers_small_blocks_and_parts(spark, monkeypatch):
    data = passages()
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = sorted(brute_repeats(data, 35), key=str)
    for name, value in (("HOT", 1), ("BLOCK_WORDS", 200), ("PART", 50)):
        with monkeypatch.context() as m:
            m.setattr(fm_substring, name, value)
            assert tuples(fm_substring.remove_repeats(df, 35).collect()) == want, name


def test_repeat_edges(spark):
    df = documents(spark, clash=True)
    got = tuples(fm_substring.remove_repeats(df, 35).collect())
    assert got == sorted(brute_repeats([(r.doc_id, r.text) for r in df.collect()], 35), key=str)
    assert fm_substring.remove_repeats(empty(spark), 35).count() == 0


def test_fm_index_counts_like_the_text():
    rng = np.random.default_rng(5)
    text = rng.integers(1, 4, 400)
    text[::37] = 0
    weight = rng.integers(1, 4, 400)
    index = fm_substring.FMIndex(text, weight, 8)
    for _ in range(200):
        at = int(rng.integers(0, 390))
        pattern = text[at:at + int(rng.integers(1, 8))]
        if (pattern == 0).any():
            continue
        lo, hi = np.array([0]), np.array([index.n])
        for s in pattern[::-1]:
            lo, hi = index.extend(np.array([s]), lo, hi)
        places = [i for i in range(401 - len(pattern)) if (text[i:i + len(pattern)] == pattern).all()]
        assert hi[0] - lo[0] == len(places) and index.count(lo, hi)[0] == weight[places].sum()


# ---------------------------------------------------------------- benchmark leaks

def brute_best(doc, item):
    """Best score over all diagonals: +1 equal, -MISMATCH substituted."""
    best = 0
    for d in range(-len(item) + 1, len(doc)):
        run = 0
        for i in range(max(0, -d), min(len(item), len(doc) - d)):
            run = max(0, run + (1 if doc[i + d] == item[i] else -decontaminate.MISMATCH))
            best = max(best, run)
    return best


def toks(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def test_leaks_equal_brute_force(spark):
    items = [(i, prose(300 + i, 15 + 6 * i)) for i in range(8)] + [(50, None), (51, ""), (52, "short item")]
    docs = list(enumerate(awkward_texts()[:12]))
    for i, t in items[:8]:
        docs += [(100 + i, prose(400 + i, 40) + ". " + t.upper() + "! " + prose(500 + i, 9)),
                 (200 + i, edited(t, 13, 5)), (300 + i, edited(t, 3, 1)), (400 + i, prose(600 + i, 80))]
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r.score for r in got.collect()}
    want = {}
    for d, t in docs:
        for i, x in items:
            if len(toks(x)) >= 12 and (s := brute_best(toks(t), toks(x))) >= decontaminate.MIN_SCORE:
                want[d, i] = s
    # every copied passage is found at its exact score; nothing is reported that brute force doesn't see
    assert {k: want.get(k) for k in got} == got
    assert {k for k in want if 100 <= k[0] < 200 or 200 <= k[0] < 300} <= set(got)
    assert {(100 + i, i) for i in range(8)} <= set(got)


def test_leak_edges(spark):
    item = prose(700, 40)
    items = spark.createDataFrame([(1, item), (None, item), (1, prose(701, 30))], "item_id long, text string")
    base = documents(spark, clash=True)
    leak = base.limit(1).selectExpr(*[f"'{item}' as text" if c == "text" else "77L as doc_id" if c == "doc_id" else c
                                      for c in base.columns])
    docs = base.unionByName(leak)
    out = decontaminate.verdicts(docs, items).collect()
    assert len(out) == docs.count() and [r.doc_id for r in out if not r.kept] == [77]
    assert [r.best_matched for r in out if r.doc_id == 77] == [40]
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == base.count()
    assert kept.filter(" or ".join(f"{c} <> 'mine'" for c in CLASH)).count() == 0
    assert decontaminate.verdicts(empty(spark), items).count() == 0
    assert all(r.kept for r in decontaminate.verdicts(docs, items.limit(0)).collect())
    few, decontaminate.BROADCAST_SEEDS = decontaminate.BROADCAST_SEEDS, 0
    try:
        assert [r.doc_id for r in decontaminate.verdicts(docs, items).collect() if not r.kept] == [77]
    finally:
        decontaminate.BROADCAST_SEEDS = few


def test_many_equal_rows_share_their_spans(spark):
    """Equal rows under one id (or none): spans don't multiply with the rows."""
    text = prose(990, 60)
    docs = spark.createDataFrame([(None, text)] * 3000 + [(1, text)] * 200, "doc_id long, text string")
    spans = {r.doc_id: r.n for r in fm_substring.repeated_spans(docs).selectExpr("doc_id", "size(spans) as n").collect()}
    assert set(spans) == {None, 1} and max(spans.values()) < 60
    out = fm_substring.remove_repeats(docs)
    assert out.count() == 3200 and out.filter("n_removed <> 60").count() == 0


def brute_leaks(docs, items):
    """Pairs that either rule accepts, over all diagonals."""
    out = set()
    for d, t in docs:
        words = toks(t)
        for i, x in items:
            item = toks(x)
            same = max((sum(words[k + j] == w for j, w in enumerate(item) if 0 <= k + j < len(words))
                        for k in range(-len(item) + 1, len(words))), default=0)
            if same >= 0.75 * len(item) or brute_best(words, item) >= min(13, len(item)):
                out.add((d, i))
    return out


@pytest.mark.parametrize("seed_set", [0, decontaminate.SEED_SET])
def test_short_items_with_substituted_tokens_are_leaks(spark, monkeypatch, seed_set):
    """Items of 12 to 64 tokens, up to a quarter (and more) substituted at random: full alignment, no exemption."""
    monkeypatch.setattr(decontaminate, "SEED_SET", seed_set)
    items, docs = [], []
    for n in (12, 13, 15, 16, 18, 20, 24, 40, 64):
        item = prose(800 + n, n).split()
        items.append((n, " ".join(item)))
        for k in sorted({1, 2, n // 5, n // 4, n // 4 + 1, n // 2}):
            for trial in range(3):
                at = random.Random(100 * n + 10 * k + trial).sample(range(n), k)
                words = ["changed" if i in at else w for i, w in enumerate(item)]
                d = len(docs)
                cut = words[trial:] if k == 1 else words              # an item that the document holds in part
                docs.append((d, " ".join([prose(5000 + d, 7 * trial), *cut, prose(6000 + d, 7 * (trial % 2))])))
    docs.append((len(docs), " ".join(prose(9000 + i, 9000 if i == 1 else 5) + " " + items[4][1] for i in range(3))))
    want = brute_leaks(docs[:-1], items) | {(len(docs) - 1, items[4][0])}
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string"), min_share=0.75).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) > 80


def test_items_too_short_to_judge(spark):
    items = spark.createDataFrame([(1, "the"), (2, "of the day"), (3, prose(3, 20)), (4, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "the end of the day"), (2, prose(3, 20))], "doc_id long, text string")
    kept = {r.doc_id for r in decontaminate.decontaminate(docs, items, min_tokens=4).collect()}
    assert kept == {1} and decontaminate.decontaminate(docs, items).count() == 0
    assert {(r.item_id, r.n_tokens) for r in decontaminate.too_short(items, 4).collect()} == {(1, 1), (2, 3), (4, 0)}


def test_items_shorter_than_a_mask_are_found_whole(spark):
    items = [(n, prose(950 + n, n)) for n in (1, 2, 5, 8, 11)] + [(50, None), (51, "")]
    docs = [(n, f"{prose(7000 + n, 30)}, {t.upper()}! {t} {prose(7100 + n, 9)}") for n, t in items[1:5]]
    docs += [(100 + n, edited(t, n, 2)) for n, t in items[1:5]] + [(200, items[3][1]), (201, None), (202, "x")]
    want = {(d, i) for d, t in docs for i, x in items if toks(x) and any(
        toks(t)[k:k + len(toks(x))] == toks(x) for k in range(len(toks(t))))}
    assert {(n, n) for n in (2, 5, 8, 11)} | {(200, 8)} <= want
    docs, items = (spark.createDataFrame(x, f"{c} long, text string") for x, c in ((docs, "doc_id"), (items, "item_id")))
    for few in (decontaminate.BROADCAST_SEEDS, 0):
        kept, decontaminate.BROADCAST_SEEDS = decontaminate.BROADCAST_SEEDS, few
        try:
            got = decontaminate.overlaps(docs, items).collect()
        finally:
            decontaminate.BROADCAST_SEEDS = kept
        assert {(r.doc_id, r.item_id) for r in got} == want and all(r.matched == r.score == r.item_id for r in got)


def test_leaks_are_native(spark):
    df = decontaminate.verdicts(documents(spark), spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_digest_of_nothing():
    assert fm_substring.kept_words([], None) == [] and hashlib.sha256(b"").hexdigest().startswith("e3b0")
