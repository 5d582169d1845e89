"""Repeated passages by FM-indexes over shards of the corpus.

Every window of ``size`` words is dealt out by its minimizer, the ``ANCHOR``-word
sequence in it with the smallest hash.  Consecutive windows with one minimizer are
a run; equal windows always have equal minimizers, so they meet in one shard, and
each window lies in exactly one run.

1. Runs are counted by (minimizer, text).  A run found twice is repeated whole; a
   minimizer with a single run repeats nothing.
2. One copy of each different run of the other minimizers goes, by minimizer, to a
   shard.  A task cuts its shards into blocks of bounded size; each gets an FM-index
   over word numbers (Burrows-Wheeler transform in a bit-packed wavelet matrix), and
   the runs stream against it: backward search yields how far a match reaches, a
   window is repeated if its interval holds two occurrences, and a failed search
   rules out all windows around it.
3. A minimizer with more than ``HOT`` different runs would make a large shard: its
   runs are cut into single windows, counted by window.

Repeated intervals meet their documents again by ``doc_id`` and text hash.  Words
are judged on the input.  A null text has no words; texts of fewer than ``size``
words repeat nothing.  Rows that are equal are repetitions of each other, as any two
rows are.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import text_key
from .words import BYTE_BASE, _powers, mix, to_bytes, window_hashes, word_hashes

ANCHOR = 10
HOT = 512                 # different runs of one minimizer that one shard takes
SALTS = 16                # tasks that the runs of one frequent window are spread over
PART = 1 << 19            # words of a document whose runs are found at once
BLOCK_WORDS = 1 << 19     # words of one FM-index


# ---------------------------------------------------------------- runs

def runs(w: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """start, number of windows, hash of the minimizer and of the text of each run of a word sequence."""
    found = []
    for at in range(0, max(1, len(w) - size + 1), PART):
        part = w[at:at + PART + size - 1]
        n = len(part) - size + 1
        if n <= 0:
            break
        g = window_hashes(part, ANCHOR)
        # hash above, position below: a minimum is the leftmost of the smallest
        key = (g & ~np.uint64((1 << 20) - 1)) | np.arange(len(g), dtype=np.uint64)
        width, want = 1, size - ANCHOR + 1
        while width < want:
            step = min(width, want - width)
            key = np.minimum(key[:-step], key[step:])
            width += step
        place = (key & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        count = np.diff(np.r_[first, n])
        up = _powers(BYTE_BASE, len(part))
        down = _powers(pow(BYTE_BASE, -1, 2**64), len(part))
        total = np.r_[np.zeros(1, np.uint64), np.cumsum(part * up, dtype=np.uint64)]
        text = mix((total[first + count + size - 1] - total[first]) * down[first] + count.astype(np.uint64))
        found.append((first + at, count, g[place[first]], text))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _run_rows(size: int) -> Callable:
    names = ["doc_id", "rk", "start", "n_windows", "anchor", "content"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [runs(word_hashes(to_bytes(t)), size) for t in b.column(2).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(each)), [len(e[0]) for e in each]))
            if len(row):
                start, n, anchor, content = (np.concatenate([e[k] for e in each]) for k in range(4))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(row), b.column(1).take(row), pa.array(start.astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(anchor.astype(np.int64)), pa.array(content.astype(np.int64))],
                    names=names)
    return run


# ---------------------------------------------------------------- FM-index

class WaveletMatrix:
    """Ranks of symbols in a sequence, in packed bits: one level for each bit of a symbol."""

    def __init__(self, seq: np.ndarray, top: int):
        self.levels, self.bits = [], max(1, int(top).bit_length())
        for level in reversed(range(self.bits)):
            bit = (seq >> level & 1).astype(bool)
            packed = np.zeros(len(seq) // 64 + 1, np.uint64)
            raw = np.packbits(bit, bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            before = np.zeros(len(packed), np.int64)
            np.cumsum(np.bitwise_count(packed[:-1]), out=before[1:], dtype=np.int64)
            zeros = len(seq) - int(bit.sum())
            self.levels.append((level, packed, before, zeros))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` of each symbol's subsequence ends up below the last level."""
        for level, packed, before, zeros in self.levels:
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[block] + np.bitwise_count(packed[block] & mask)
            at = np.where(symbol >> level & 1, zeros + ones, at - ones)
        return at


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by at least their first ``depth`` symbols, by prefix doubling."""
    n = len(text)
    rank, order, h = text.astype(np.int64), np.argsort(text, kind="stable"), 1
    while h < depth:
        later = np.zeros(n, np.int64)
        later[:-h] = rank[h:] + 1
        key = rank * (int(rank.max()) + 2) + later
        order = np.argsort(key, kind="stable")
        k = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[False, k[1:] != k[:-1]])
        if rank[order[-1]] == n - 1:
            break
        h *= 2
    return order


class FMIndex:
    """Backward search over runs of symbols; symbol 0 separates runs and is never searched.  ``weight``: how
    often each position counts.  Patterns up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, weight: np.ndarray, depth: int):
        order = suffix_order(text, depth)
        top = int(text.max(initial=0))
        self.wavelet = WaveletMatrix(text[order - 1].astype(np.int64), top)
        symbols = np.arange(top + 1)
        before = np.r_[0, np.cumsum(np.bincount(text, minlength=top + 1))[:-1]]
        self.offset = before - self.wavelet.walk(symbols, np.zeros(top + 1, np.int64))
        self.weights = np.r_[0, np.cumsum(weight[order])]
        self.n = len(text)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + pattern from those of the patterns."""
        both = self.wavelet.walk(np.r_[symbol, symbol], np.r_[lo, hi])
        shift = self.offset[symbol]
        return shift + both[: len(lo)], shift + both[len(lo):]

    def count(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self.weights[hi] - self.weights[lo]


def repeated_windows(text: np.ndarray, weight: np.ndarray, start: np.ndarray, windows: np.ndarray, size: int
                     ) -> tuple[np.ndarray, np.ndarray]:
    """For runs that start at ``start`` in ``text`` and have so many ``windows``: run number and start (within
    the run) of each window with two or more weighted occurrences."""
    index = FMIndex(text, weight, size)
    run = np.arange(len(start))
    first = np.zeros(len(start), np.int64)            # the window searched now
    reach = first + size                              # the match covers [reach, first + size)
    lo, hi = np.zeros(len(start), np.int64), np.full(len(start), index.n)
    rows, starts = [], []
    while len(run):
        reach = reach - 1
        symbol = text[start[run] + reach]
        lo, hi = index.extend(symbol, lo, hi)
        alone = (index.count(lo, hi) < 2) | (symbol == 0)
        found = ~alone & (reach == first)
        rows.append(run[found])
        starts.append(first[found])
        # a match that ends at `reach` rules out every window up to there; a found window leads to the next
        done = alone | found
        first = np.where(alone, reach, first) + done
        reach = np.where(done, first + size, reach)
        lo, hi = np.where(done, 0, lo), np.where(done, index.n, hi)
        go = first < windows[run]
        run, first, reach, lo, hi = run[go], first[go], reach[go], lo[go], hi[go]
    return np.concatenate(rows) if rows else run, np.concatenate(starts) if starts else run


def _search(size: int) -> Callable:
    """Batches sorted by minimizer -> doc_id, rk, a, b: repeated word intervals [a, b) of runs that occur once."""
    fixed = ["doc_id", "rk", "anchor", "start", "n_windows", "n"]

    def block(g: pa.Table) -> pa.RecordBatch:
        words = [word_hashes(t.encode("utf-8", "surrogatepass")) for t in g.column("words").to_pylist()]
        n, windows = g.column("n").to_numpy(), g.column("n_windows").to_numpy().astype(np.int64)
        length = np.array([len(w) for w in words])
        values, number, count = np.unique(np.concatenate(words), return_inverse=True, return_counts=True)
        # a word found once repeats nothing and ends every match, as the separator does
        heavy = np.bincount(number, np.repeat(n, length)) > 1
        symbol = np.where(heavy, np.cumsum(heavy), 0)[number]
        start = np.cumsum(length + 1) - length
        text = np.zeros(int((length + 1).sum()) + 1, np.int64)
        weight = np.zeros(len(text), np.int64)
        place = np.repeat(start, length) + np.arange(len(number)) - np.repeat(np.cumsum(length) - length, length)
        text[place], weight[place] = symbol, np.repeat(n, length)
        once = np.flatnonzero(n == 1)
        row, at = repeated_windows(text, weight, start[once], windows[once], size)
        order = np.lexsort((at, row))
        row, at = row[order], at[order]
        new = np.ones(len(row), bool)
        if len(row):
            new[1:] = (row[1:] != row[:-1]) | (at[1:] > at[:-1] + size)
        last = np.r_[np.flatnonzero(new)[1:] - 1, len(row) - 1] if len(row) else np.zeros(0, np.int64)
        own = once[row[new]]
        base = g.column("start").to_numpy().astype(np.int64)[own]
        take = pa.array(own)
        return pa.RecordBatch.from_arrays(
            [g.column("doc_id").take(take).combine_chunks(), g.column("rk").take(take).combine_chunks(),
             pa.array((base + at[new]).astype(np.int32)), pa.array((base + at[last] + size).astype(np.int32))],
            names=["doc_id", "rk", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size_held = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b.select(fixed + ["words"]))
            size_held += int(b.column("n_windows").to_numpy().sum()) + b.num_rows * size
            if size_held >= BLOCK_WORDS:
                g = pa.Table.from_batches(held)
                anchor = g.column("anchor").to_numpy()
                cut = int(np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])[-1])   # the last shard may go on
                if cut:
                    yield block(g.slice(0, cut))
                    held = g.slice(cut).to_batches()
                    size_held = int(g.column("n_windows").to_numpy()[cut:].sum()) + (g.num_rows - cut) * size
        if held:
            yield block(pa.Table.from_batches(held))

    return run


# ---------------------------------------------------------------- the operator

def _run_texts(size: int, hot: bool) -> Callable:
    """doc_id, rk, text, wanted runs -> the runs' words; hot ones: the hash of each of their windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, out = [], []
            for i, (text, wanted) in enumerate(zip(b.column("text").to_pylist(), b.column("wanted").to_pylist())):
                data = to_bytes(text)
                words = word_hashes(data) if hot else data.split()
                for r in wanted:
                    s, n = r["start"], r["n_windows"]
                    row.append(i)
                    if hot:
                        out.append((r["n"], s, window_hashes(words[s:s + n + size - 1], size).astype(np.int64)))
                    else:
                        out.append((r["anchor"], s, n, r["n"], b" ".join(words[s:s + n + size - 1])))
            if not row:
                continue
            take = pa.array(np.array(row))
            keys = [b.column("doc_id").take(take), b.column("rk").take(take)]
            if hot:
                yield pa.RecordBatch.from_arrays(
                    keys + [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                            pa.array([o[2] for o in out], pa.list_(pa.int64()))],
                    names=["doc_id", "rk", "n", "start", "hashes"])
            else:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    keys + [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                            pa.array(cols[3], pa.int64()),
                            pa.array([w.decode("utf-8", "surrogatepass") for w in cols[4]], pa.string())],
                    names=["doc_id", "rk", "anchor", "start", "n_windows", "n", "words"])
    return run


def _with_text(docs: DataFrame, lists: DataFrame, column: str) -> DataFrame:
    """doc_id, rk, text of every row of ``docs``, and its ``column`` of ``lists`` (or null)."""
    keyed = docs.select("doc_id", text_key().alias("rk"), "text")
    lists = lists.select(F.col("doc_id").alias("l_id"), F.col("rk").alias("l_rk"), column)
    return keyed.join(lists, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("rk") == F.col("l_rk")), "left").select(
        "doc_id", "rk", "text", column)


def repeated_spans(docs: DataFrame, size: int = 35) -> DataFrame:
    """doc_id, rk, spans: for each row with repeated words, the intervals [a, b) of word numbers that repeated
    windows cover (unordered, overlapping)."""
    base = docs.select("doc_id", text_key().alias("rk"), "text")
    found = materialize(base.select("doc_id", "rk", "text").mapInArrow(
        _run_rows(size), "doc_id long, rk long, start int, n_windows int, anchor long, content long"), "runs")
    kinds = found.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"))
    crowd = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")).filter("total > 1")
    flagged = kinds.join(crowd, "anchor").filter("n > 1 or kinds > 1").select(
        F.col("anchor").alias("f_anchor"), F.col("content").alias("f_content"), "n", "kinds")
    marked = materialize(found.join(flagged, (found["anchor"] == F.col("f_anchor")) & (
        found["content"] == F.col("f_content"))).drop("f_anchor", "f_content"), "marked-runs")
    whole = marked.filter("n > 1").select("doc_id", "rk", F.col("start").alias("a"),
                                          (F.col("start") + F.col("n_windows") + (size - 1)).alias("b"))
    # one copy of each different run of the minimizers that have several
    one = marked.filter("kinds > 1").groupBy("anchor", "content").agg(
        F.min(F.struct("doc_id", "rk", "start")).alias("at"), F.first("n_windows").alias("n_windows"),
        F.first("n").alias("n"), (F.first("kinds") > HOT).alias("hot"))
    wanted = materialize(one.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.rk").alias("rk"), "hot").agg(
        F.collect_list(F.struct(F.col("at.start").alias("start"), "n_windows", "n", "anchor")).alias("wanted")), "wanted-runs")

    def texts(hot: bool) -> DataFrame:
        # rows that are equal have one list of runs and need to be read once
        return _with_text(docs, wanted.filter(F.col("hot") == hot), "wanted").filter("wanted is not null").dropDuplicates(
            ["doc_id", "rk"])

    shards = texts(False).mapInArrow(
        _run_texts(size, False), "doc_id long, rk long, anchor long, start int, n_windows int, n long, words string")
    searched = shards.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _search(size), "doc_id long, rk long, a int, b int")
    windows = texts(True).mapInArrow(
        _run_texts(size, True), "doc_id long, rk long, n long, start int, hashes array<long>").select(
        "doc_id", "rk", "n", "start", F.posexplode("hashes").alias("j", "hash"))
    # a window of very many runs would meet its count in one task: counts are repeated for each salt
    often = windows.groupBy("hash").agg(F.sum("n").alias("total")).filter("total > 1").select(
        "hash", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])).alias("salt"))
    single = windows.filter("n = 1").withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(SALTS))).join(
        often, ["hash", "salt"], "left_semi").select(
        "doc_id", "rk", (F.col("start") + F.col("j")).alias("a"), (F.col("start") + F.col("j") + size).alias("b"))
    return whole.unionByName(searched).unionByName(single).groupBy("doc_id", "rk").agg(
        F.collect_set(F.struct("a", "b")).alias("spans"))     # rows that are equal share theirs


def kept_words(words: list, spans) -> list:
    """The words outside the spans."""
    gone = np.zeros(len(words) + 1, np.int64)
    for s in spans or ():
        gone[s["a"]] += 1
        gone[s["b"]] -= 1
    out = np.cumsum(gone[:-1]) > 0
    return [w for w, g in zip(words, out.tolist()) if not g] if out.any() else words


def remove_repeats(docs: DataFrame, size: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed and text (the words that stay, joined by blanks) of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, left, text = [], [], []
            for t, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                words = to_bytes(t).split()
                kept = kept_words(words, spans)
                n.append(len(words))
                left.append(len(words) - len(kept))
                text.append(b" ".join(kept).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(left, pa.int64()), pa.array(text, pa.string())],
                names=["doc_id", "n_words", "n_removed", "text"])

    return _with_text(docs, repeated_spans(docs, size), "spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, text string")


ORACLE = r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
win as (
  select doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) as h
  from (select *, unnest(range(1, len(words) - 33)) as i from w)),
rep as (select doc_id, i from (select *, count(*) over (partition by h) as n from win) where n > 1),
cov as (select distinct doc_id, i + j as p from (select *, unnest(range(0, 35)) as j from rep)),
word as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as p from w),
kept as (
  select word.doc_id, string_agg(word, ' ' order by p) as text, count(*) as n
  from word where not exists (select 1 from cov where cov.doc_id = word.doc_id and cov.p = word.p) group by word.doc_id)
select w.doc_id, len(words)::bigint as n_words, (len(words) - coalesce(kept.n, 0))::bigint as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept using (doc_id)
"""
