"""Collocated phrases by bidirectional FM-indexes over shards of the corpus.

A text is lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words
at blanks and tabs; everything is counted per language (null: ``und``).

1. Words are counted in tasks and summed.
2. A task cuts its texts, language by language, into shards of bounded size.  Each
   gets an index of its word numbers in both directions: the Burrows-Wheeler transform
   of the sequence and of its reverse, with the mapping to the position of the word
   before.  An interval of either side is extended by every word that occurs next to
   it, which also narrows the interval of the other side; so all phrases up to the
   wanted length are enumerated with their counts in the shard.
3. The counts of all shards are summed per language and phrase.

Shards are searched twice, for phrases of two words and then for longer ones.  As a
phrase is no more frequent than its parts, texts are cut before at words (then at word
pairs) that the corpus holds fewer than ``least`` times.  Tasks know the frequent ones
by a bit table of their hashes, of 2^20 to 2^28 bits: a frequent part is never missed;
a wrong hit costs time only, as counts below ``least`` go after the sum.

A phrase's left and right extensions are the phrases with one more word before or
after it; the most frequent of each side tell whether it is part of a longer one.

Defined results: a null or empty text has no words; equal rows count each; ties are
ordered by phrase (UTF-8 bytes); very long pieces are cut into shards that overlap, with
each phrase counted where it starts; other columns of the input, whatever their names,
are not read; an empty table gives an empty result.  Scores are exact decimals.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .words import WORD_BASE, mix, to_bytes

NO_LANG = "und"
SHARD_WORDS = 1 << 20     # words of one index
HELD_WORDS = 3 << 20      # words of all languages that a task holds before it cuts and indexes them
HELD_COUNTS = 500_000     # different words that a counting task holds
MIN_BITS, MAX_BITS = 20, 28
SALTS = 64                # parts of a language that are ranked by themselves first

# ends of pieces -> line break, tabs -> blanks
_CUT = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


def pieces(text: str | None) -> list[bytes]:
    """Words of a text in order, with an empty one at the end of each piece."""
    data = to_bytes(text, lower=True).translate(_CUT)
    return [w for line in data.split(b"\n") if line for w in (*filter(None, line.split(b" ")), b"")]


# ---------------------------------------------------------------- words

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = defaultdict(Counter)

    def out() -> Iterator[pa.RecordBatch]:
        for lang, count in held.items():
            count.pop(b"", None)
            if count:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(count), pa.string()), pa.array([w.decode("utf-8", "surrogatepass") for w in count], pa.string()),
                     pa.array(list(count.values()), pa.int64())], names=["lang", "phrase", "f"])
        held.clear()

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
            held[lang].update(pieces(text.as_py()))
            if sum(map(len, held.values())) > HELD_COUNTS:
                yield from out()
    yield from out()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text").filter("text <> ''")


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase (one word), f of all words."""
    return materialize(_summed(_texts(docs).mapInArrow(_count_words, "lang string, phrase string, f long")), "words")


# ---------------------------------------------------------------- bit tables of frequent parts

def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass") + b"\n" + word)


def chain_hash(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive word hashes."""
    out = np.zeros(len(words) - size + 1, np.uint64)
    for j in range(size):
        out = out * np.uint64(WORD_BASE) + words[j:j + len(out)]
    return mix(out)


def _buckets(bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [chain_hash(np.array([word_hash(lang, w) for w in words], np.uint64), len(words))[0]
                     for lang, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                     for words in [p.encode("utf-8", "surrogatepass").split(b" ")]]
            yield pa.RecordBatch.from_arrays(
                [pa.array((np.array(found, np.uint64) >> np.uint64(64 - bits)).astype(np.int64))], names=["bucket"])
    return run


class Known:
    """Which hashes of parts (of ``size`` words) may be frequent."""

    def __init__(self, frequent: DataFrame, size: int):
        n = frequent.count()
        self.size = size
        self.bits = min(MAX_BITS, max(MIN_BITS, (16 * n).bit_length()))
        # the table comes in rows of 4 KB, at most 2^28 bits of them
        rows = frequent.select("lang", "phrase").mapInArrow(_buckets(self.bits), "bucket long").groupBy(
            F.bitmap_bucket_number(F.col("bucket") + 1).alias("at")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bucket") + 1)).alias("part")).collect()
        self.table = np.zeros(max(1, (1 << self.bits) // 8), np.uint8)
        for r in rows:
            at = (r["at"] - 1) * 4096
            self.table[at:at + 4096] = np.frombuffer(bytes(r["part"]), np.uint8)

    def has(self, words: np.ndarray) -> np.ndarray:
        bucket = chain_hash(words, self.size) >> np.uint64(64 - self.bits)
        return (self.table[bucket >> np.uint64(3)] >> (bucket & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


# ---------------------------------------------------------------- the index

def rotation_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of a sequence ordered by their first ``depth`` symbols: stable sorts from the last symbol on."""
    n, wide = len(text), int(text.max(initial=0)) >> 16
    digits = [(text & 0xFFFF).astype(np.uint16)] + ([(text >> 16).astype(np.uint16)] if wide else [])
    order = np.arange(n)
    for j in reversed(range(depth)):
        for digit in digits:
            order = order[np.argsort(digit[(order + j) % n], kind="stable")]
    return order


class BiIndex:
    """Both directions of a sequence of symbols; 0 separates and is never part of a phrase.  An occurrence counts
    with the weight of its first symbol.  Phrases have up to ``depth`` symbols."""

    def __init__(self, text: np.ndarray, weight: np.ndarray, depth: int):
        n, self.top = len(text), int(text.max(initial=0)) + 1
        self.sides = []
        for t in (text, text[::-1]):
            order = rotation_order(t, depth)
            rank = np.empty(n, np.int64)
            rank[order] = np.arange(n)
            before = (order - 1) % n
            self.sides.append((t[before], rank[before]))   # the symbol before, and where the rotation from it stands
            if not len(self.sides) - 1:
                self.weights = np.r_[0, np.cumsum(weight[order])]
        self.starts = np.r_[0, np.cumsum(np.bincount(text, minlength=self.top))]

    def symbols(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each symbol, the start of its interval on both sides, and the interval's size."""
        symbol = np.arange(1, self.top)
        lo = self.starts[symbol]
        return symbol, lo, lo.copy(), self.starts[symbol + 1] - lo

    def extend(self, right: bool, lo: np.ndarray, other: np.ndarray, size: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All extensions of phrases by one symbol to the right (or left).  ``lo``: starts of their intervals on
        the side that is searched (the reverse one for right), ``other``: on the other side.  Number of the
        phrase, symbol, both starts and the size of each extension."""
        before, place_before = self.sides[right]
        total, first = int(size.sum()), np.cumsum(size) - size
        place = np.arange(total) + np.repeat(lo - first, size)
        key = np.repeat(np.arange(len(lo)), size) * self.top + before[place]
        by = np.argsort(key, kind="stable")
        key = key[by]
        at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if total else np.zeros(0, np.int64)
        phrase, symbol = np.divmod(key[at], self.top)
        # rotations that begin with the extension stand together; smaller symbols come before it on the other side
        new_lo = np.minimum.reduceat(place_before[place[by]], at) if total else at
        new_other = other[phrase] + at - first[phrase]
        new_size = np.diff(np.r_[at, total])
        some = symbol > 0
        return phrase[some], symbol[some], new_lo[some], new_other[some], new_size[some]

    def count(self, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
        return self.weights[lo + size] - self.weights[lo]


def phrases(text: np.ndarray, weight: np.ndarray, shortest: int, longest: int
            ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(symbols, one row a phrase; counts) for each length, of the phrases of a sequence."""
    index = BiIndex(text, weight, longest)
    symbol, ahead, back, size = index.symbols()       # starts in the sequence and in its reverse
    found = symbol[:, None]
    for length in range(2, longest + 1):
        # even lengths grow to the right, odd ones to the left
        if length % 2 == 0:
            phrase, symbol, back, ahead, size = index.extend(True, back, ahead, size)
            found = np.column_stack([found[phrase], symbol])
        else:
            phrase, symbol, ahead, back, size = index.extend(False, ahead, back, size)
            found = np.column_stack([symbol, found[phrase]])
        if length >= shortest:
            n = index.count(ahead, size)
            yield found[n > 0], n[n > 0]


# ---------------------------------------------------------------- shards of a task

def chains(ids: np.ndarray, hashes: np.ndarray, known: Known, least: int) -> np.ndarray:
    """The sequence cut where a part is surely rare, without runs of fewer than ``least`` words; 0 separates."""
    if known.size == 1:
        ok = np.r_[False, known.has(hashes[1:])] if len(hashes) > 1 else np.zeros(1, bool)
        ids = np.where(ok[ids], ids, 0)
    else:
        pair = (ids[:-1] > 0) & (ids[1:] > 0)
        at = np.flatnonzero(pair)
        rare = np.ones(len(pair), bool)
        rare[at] = ~known.has(hashes[ids])[at]
        ids = np.insert(ids, np.flatnonzero(rare & pair) + 1, 0)
    word = np.r_[False, ids > 0, False]
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    start, end = start[long], end[long]
    size = end - start + 1                             # with one separator
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - start, size)
    return np.r_[0, np.where(np.isin(place, end), 0, np.r_[ids, 0][place])] if len(start) else np.zeros(0, np.int64)


def _shards(known: Known, shortest: int, longest: int) -> Callable:
    names = ["lang", "phrase", "f"]

    def counted(lang: str, words: list[bytes], ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        hashes = np.array([word_hash(lang, w) for w in words], np.uint64)
        seq = chains(ids, hashes, known, shortest)
        text = pa.array([w.decode("utf-8", "surrogatepass") for w in words], pa.string())
        for at in range(0, len(seq), SHARD_WORDS):
            part = np.r_[0, seq[at:at + SHARD_WORDS + longest - 1], 0]
            weight = np.zeros(len(part), np.int64)
            weight[1:1 + SHARD_WORDS] = 1              # what follows is counted by the next shard
            used, part = np.unique(part, return_inverse=True)
            for found, n in phrases(part, weight, shortest, longest):
                if len(n):
                    columns = [text.take(pa.array(used[c])) for c in found.T]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]).take(pa.array(np.zeros(len(n), np.int64))),
                         pc.binary_join_element_wise(*columns, " "), pa.array(n)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, defaultdict] = {}
        held: dict[str, list[np.ndarray]] = defaultdict(list)
        n_held: Counter = Counter()

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            n_held.pop(lang)
            number = numbers.pop(lang)
            number.default_factory = None              # no cycle that would keep it
            yield from counted(lang, list(number), np.concatenate(held.pop(lang)))

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                if lang not in numbers:
                    numbers[lang] = number = defaultdict()
                    number.default_factory = number.__len__
                    number[b""]                        # 0: the end of a piece
                words = pieces(text.as_py())
                held[lang].append(np.fromiter(map(numbers[lang].__getitem__, words), np.int64, len(words)))
                n_held[lang] += len(words)
                while n_held.total() >= HELD_WORDS:
                    yield from flush(n_held.most_common(1)[0][0])
        for lang in list(held):
            yield from flush(lang)

    return run


def _frequent_phrases(docs: DataFrame, known: Known, shortest: int, longest: int, least: int, name: str) -> DataFrame:
    counts = _texts(docs).mapInArrow(_shards(known, shortest, longest), "lang string, phrase string, f long")
    return materialize(_summed(counts).filter(F.col("f") >= least), name)


# ---------------------------------------------------------------- the operator

def phrase_counts(docs: DataFrame, longest: int = 4, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, f, size of every phrase of up to ``longest`` words found at least ``least`` times; and
    lang, n, the number of words of each language."""
    words = word_counts(docs)
    out = words.filter(F.col("f") >= least)
    if longest >= 2:
        pairs = _frequent_phrases(docs, Known(out, 1), 2, 2, least, "pairs")
        out = out.unionByName(pairs)
    if longest >= 3:
        out = out.unionByName(_frequent_phrases(docs, Known(pairs, 2), 3, longest, least, "phrases"))
    return (out.withColumn("size", F.size(F.split("phrase", " "))),
            words.groupBy("lang").agg(F.sum("f").alias("n")))


def extensions(counts: DataFrame) -> DataFrame:
    """lang, phrase, left and right: counts of the most frequent phrase with one more word before, or after it."""
    words = F.split("phrase", " ")
    part = counts.filter("size > 2").select("lang", "f", F.explode(F.array(
        F.struct(F.array_join(F.slice(words, 2, F.col("size") - 1), " ").alias("phrase"), F.lit(True).alias("left")),
        F.struct(F.array_join(F.slice(words, 1, F.col("size") - 1), " ").alias("phrase"), F.lit(False).alias("left")),
    )).alias("part"))
    return part.groupBy("lang", F.col("part.phrase").alias("phrase")).agg(
        F.max(F.when(F.col("part.left"), F.col("f"))).alias("left"),
        F.max(F.when(~F.col("part.left"), F.col("f"))).alias("right"))


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of every phrase of two or more words at its lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = counts.filter("size > 1").select(
        "lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).select("lang", "phrase", "a", "k", F.array_join(F.slice(words, 1, F.col("k")), " ").alias("first"),
             F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"))
    first = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    exact = "cast(2000000 as decimal(8, 0)) * cast(a as decimal(19, 0)) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))"
    both = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).withColumn("score", F.expr(exact))
    return both.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, share: int = 80, top: int = 2000) -> DataFrame:
    """Each language's first ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score.  A phrase goes if a
    longer one that holds it is found ``share`` percent as often (an extension by one word is, then, too)."""
    counts, totals = phrase_counts(docs, longest, least)
    longer = extensions(counts).select("lang", "phrase", F.greatest("left", "right").alias("longer"))
    kept = scored(counts).join(longer, ["lang", "phrase"], "left").filter(
        f"longer is null or cast(100 as decimal(3, 0)) * longer < cast({share} as decimal(3, 0)) * a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of each part of a language, then of those the first of the language
    part = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(
        F.col("rank") <= top)
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
with piece as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
  from documents where text is not null),
w as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as ws from piece),
gram as (
  select lang, size, array_to_string(ws[i:i + size - 1], ' ') as phrase
  from (select lang, ws, size, unnest(range(1, len(ws) - size + 2)) as i
        from w, (select unnest([1, 2, 3, 4]) as size))),
f as (select lang, size, phrase, count(*) as f from gram group by all having count(*) >= 30),
total as (select lang, sum(len(ws))::bigint as n from w group by lang),
cand as (select lang, size, phrase, f as a, string_split(phrase, ' ') as ws from f where size > 1),
cut as (
  select lang, phrase, a, k, array_to_string(ws[1:k], ' ') as first, array_to_string(ws[k + 1:size], ' ') as rest
  from (select *, unnest(range(1, size)) as k from cand)),
rated as (
  select cut.lang, cut.phrase, cut.a, cut.k, x.f as l, y.f as r,
         (2000000::hugeint * cut.a // (x.f::hugeint + y.f))::bigint as score
  from cut join f as x on x.lang = cut.lang and x.phrase = cut.first
           join f as y on y.lang = cut.lang and y.phrase = cut.rest),
lowest as (
  select * from rated qualify row_number() over (partition by lang, phrase order by score, k) = 1),
part as (
  select lang, a, array_to_string(ws[i:i + n - 1], ' ') as phrase
  from (select lang, a, ws, n, unnest(range(1, size - n + 2)) as i
        from (select lang, a, ws, size, unnest(range(2, size)) as n from cand))),
longer as (select lang, phrase, max(a) as longer from part group by all),
kept as (
  select lowest.* from lowest left join longer using (lang, phrase)
  where longer is null or 100::hugeint * longer < 80::hugeint * a)
select lang, rank, phrase, a, l, r, n, score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
join total using (lang) where rank <= 2000
"""
