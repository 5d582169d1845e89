"""Near-duplicates by SetSketch registers.

A document's set of word shingles is sketched in ``m`` registers.  A register
holds the truncated logarithm (base ``BASE``) of the smallest of one exponential
variate per shingle, so registers of a union are maxima of registers, and two
sets agree in a register with a probability that grows with their similarity.

1. Documents with equal shingle sets form a class; only classes go on.
2. Registers are cut into bands; classes that agree in a whole band are
   candidates.  The number of bands follows the threshold: a pair at the threshold
   is missed with a probability below ``MISS``.
3. The similarity of candidates is estimated jointly from how many registers are
   larger, smaller and equal, by likelihood; candidates whose likelihood rules the
   threshold out are dropped (five standard deviations and more).
4. What is left is verified on full shingle sets, and links become components.

A bucket (classes that agree in one band) may be large: it is cut into blocks of
about ``BLOCK`` classes.  First each class meets its own block and the bucket's leader only
(rows in proportion to the classes), and each one's closest partners are verified.
Then components are known, and a bucket within one component is done.  In the others
the classes outside the bucket's largest component meet each other and that component,
a pair of blocks at a time: those with a candidate partner in another component
come once more with their full sets, every such pair is verified inside the task, and
each two components that it connects give one link.  So no link that matters is
lost, and a group of copies becomes rows neither for its pairs nor for pairs of its blocks.

Empty and null texts have an empty set and no links.  Rows without ``doc_id`` have
no links and a null component.  Rows that share ``doc_id`` are one document: its
classes are linked.  Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .tables import map_column, text_key
from .words import mix, shingle_set, to_bytes

BASE = 1.125
ROWS = 6                  # registers in a band
MISS = 1e-6               # largest chance of missing a pair at the threshold
TOP = 20.0                # largest exponential variate told apart; registers start there
BLOCK = 256               # classes of a bucket that one block takes
RULED_OUT = 28.0          # twice the log likelihood ratio: 5.3 standard deviations
PAIRS_AT_ONCE = 1 << 15


def bands_for(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log1p(-threshold ** ROWS))


def _factors(m: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (x >> np.uint64(32)).astype(np.uint32) | np.uint32(1), x.astype(np.uint32) | np.uint32(1)


def registers(shingles: np.ndarray, m: int) -> np.ndarray:
    """``m`` one-byte registers of a non-empty set of 64-bit hashes."""
    a, b = _factors(m)
    low, high = shingles.astype(np.uint32), (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(m, 2**32 - 1, np.uint32)
    for at in range(0, len(shingles), 2048):
        x = low[at:at + 2048, None] * a
        x += high[at:at + 2048, None] * b
        np.minimum(least, x.min(axis=0), out=least)
    variate = -np.log1p(-(least + 0.5) / 2.0**32)        # the smallest exponential variate
    return np.clip(np.floor(np.log(TOP / variate) / math.log(BASE)), 0, 255).astype(np.uint8)


def _more(x: np.ndarray) -> np.ndarray:
    """Probability that one register exceeds the other when the first set has the share x of new elements."""
    return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1) / BASE) / math.log(BASE)


def ruled_out(plus: np.ndarray, minus: np.ndarray, m: int, n1: np.ndarray, n2: np.ndarray, threshold: float) -> np.ndarray:
    """True where the joint likelihood of register comparisons and set sizes rules ``threshold`` out."""
    u, v = n1 / (n1 + n2), n2 / (n1 + n2)
    small, large = np.minimum(n1, n2), np.maximum(n1, n2)
    too_far = 100 * small < round(100 * threshold, 6) * large    # whole numbers: a set contained at the threshold stays
    most = np.where(too_far, small / large, np.maximum(small / large, threshold))

    def likelihood(j):
        more, less = _more(u[:, None] - v[:, None] * j), _more(v[:, None] - u[:, None] * j)
        return (plus[:, None] * np.log(np.maximum(more, 1e-9)) + minus[:, None] * np.log(np.maximum(less, 1e-9))
                + (m - plus - minus)[:, None] * np.log(np.maximum(1 - more - less, 1e-9)))

    grid = most[:, None] * np.linspace(0.0, 1.0, 33)[None, :]
    all_j = likelihood(grid)
    best = all_j.max(axis=1)
    # the best similarity of at least the threshold that the sizes allow
    at = np.maximum(np.where(grid >= threshold, all_j, -np.inf).max(axis=1),
                    likelihood(np.minimum(most, threshold)[:, None])[:, 0])
    return too_far | (2 * (best - at) > RULED_OUT)


def sketch(docs: DataFrame, size: int, m: int) -> DataFrame:
    """doc_id, rk, n_shingles, h1, h2 (two sums that identify the set), regs of every row."""
    def run(texts: list) -> dict:
        out: dict = {"n_shingles": [], "h1": [], "h2": [], "regs": []}
        for t in texts:
            s = shingle_set(to_bytes(t, lower=True), size)
            out["n_shingles"].append(len(s))
            out["h1"].append(int(s.sum(dtype=np.uint64).astype(np.int64)))
            out["h2"].append(int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)))
            out["regs"].append(registers(s, m).tobytes() if len(s) else b"")
        return out

    return map_column(docs.select("doc_id", "text", text_key().alias("rk")), ["doc_id", "rk"], "text", run,
                      {"n_shingles": "long", "h1": "long", "h2": "long", "regs": "binary"})


def _members(classes: DataFrame, bands: int) -> DataFrame:
    """node, cid, band, bkey of every class in every bucket of two classes and more, and the bucket's size and leader."""
    keys = F.array(*[F.xxhash64(F.lit(b), F.expr(f"substring(regs, {b * ROWS + 1}, {ROWS})")) for b in range(bands)])
    member = classes.select("node", "cid", F.posexplode(keys).alias("band", "bkey"))
    crowded = member.groupBy("bkey").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.xxhash64("node", "cid", "bkey")).alias("leader")).filter("size > 1")
    return member.join(crowded, "bkey").select("node", "cid", "band", "bkey", "size",
                                               (F.xxhash64("node", "cid", "bkey") == F.col("leader")).alias("leads"))


def _block(n_blocks: Column) -> Column:
    return F.pmod(F.xxhash64("node", "cid"), n_blocks).cast("int")


def _first_units(member: DataFrame) -> DataFrame:
    """node, cid, band, bkey, block, bi, bj: each class once, in its own block; a bucket's leader in all its blocks."""
    n = F.ceil(F.col("size") / BLOCK)
    blocks = F.when(F.col("leads"), F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array(_block(n)))
    return member.select("node", "cid", "band", "bkey", F.explode(blocks).alias("block")).select(
        "*", F.col("block").alias("bi"), F.col("block").alias("bj"))


def _open_units(member: DataFrame, comp: DataFrame) -> DataFrame:
    """node, cid, comp, band, bkey, block, bi, bj of the pairs of classes that are in one bucket and not in one component.

    The blocks of classes outside the bucket's largest component come first; each of them meets every block,
    and the largest component's blocks don't meet each other.
    """
    member = member.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component", "leads")
    largest = member.groupBy("bkey", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("bkey").agg(
        F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    small = F.col("size") <= BLOCK                       # such a bucket is one block
    apart = member.join(largest.select("bkey", "top"), "bkey").select(
        "node", "cid", "comp", "band", "bkey", (small | (F.col("comp") != F.col("top.comp"))).alias("outside"),
        F.when(small, 1).otherwise(F.ceil((F.col("size") - F.col("top.n")) / BLOCK)).cast("int").alias("n_out"),
        F.when(small, 0).otherwise(F.ceil(F.col("top.n") / BLOCK)).cast("int").alias("n_in"))
    block = F.when(F.col("outside"), _block(F.col("n_out"))).otherwise(F.col("n_out") + _block(F.greatest(F.col("n_in"), F.lit(1))))
    meets = F.when(F.col("outside"), F.col("n_out") + F.col("n_in")).otherwise(F.col("n_out"))
    return apart.withColumn("block", block).select(
        "node", "cid", "comp", "band", "bkey", "block", F.explode(F.sequence(F.lit(0), meets - 1)).alias("other")).select(
        "node", "cid", "comp", "band", "bkey", "block", F.least("block", "other").alias("bi"),
        F.greatest("block", "other").alias("bj"))


def _unit_pairs(g: dict, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of one unit: within its block, or between its two blocks."""
    if g["bi"][start] == g["bj"][start]:
        i, j = np.triu_indices(end - start, 1)
        return i + start, j + start
    block = g["block"][start:end]
    a, b = np.flatnonzero(block == g["bi"][start]), np.flatnonzero(block != g["bi"][start])
    return np.repeat(a, len(b)) + start, np.tile(b, len(a)) + start


def _sizes_of_overlap(sets: list, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sorted sets i and j, for pairs ordered by i."""
    out = np.zeros(len(i), np.int64)
    edges = np.flatnonzero(np.r_[True, i[1:] != i[:-1], True])
    for s, e in zip(edges[:-1], edges[1:]):
        own, others = sets[i[s]], [sets[k] for k in j[s:e]]
        flat = np.concatenate(others)
        at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        begin = np.cumsum([0] + [len(o) for o in others[:-1]])
        out[s:e] = np.add.reduceat((own[at] == flat).astype(np.int64), begin)
    return out


class _Units:
    """Walks batches sorted by unit and judges the pairs of each unit by their registers.

    ``find``: ``closest`` gives (u, v): each class's closest partner before it and after it in its unit;
    ``open`` gives the members with a partner in another component; ``links`` gives each two components (u, v)
    that a pair connects, verified on the members' full sets.
    """

    KEYS = ["bkey", "band", "bi", "bj", "block", "node", "cid"]
    OUT = {"closest": "u long, v long", "links": "u long, v long",
           "open": "bkey long, band int, bi int, bj int, block int, node long, cid long"}

    def __init__(self, find: str, bands: int, percent: int):
        self.find, self.bands, self.percent, self.m = find, bands, percent, bands * ROWS

    def judged(self, g: dict, i: np.ndarray, j: np.ndarray):
        """Pairs of different components that the likelihood doesn't rule out, each in its first common band."""
        regs = g["regs"]
        for at in range(0, len(i), PAIRS_AT_ONCE):
            p, q = i[at:at + PAIRS_AT_ONCE], j[at:at + PAIRS_AT_ONCE]
            fine = (g["comp"][p] != g["comp"][q]) & (g["node"][p] != g["node"][q])
            p, q = p[fine], q[fine]
            same = regs[p] == regs[q]
            first = same.reshape(len(p), self.bands, ROWS).all(axis=2).argmax(axis=1) == g["band"][p]
            p, q, equal = p[first], q[first], same[first].sum(axis=1)
            plus = (regs[p] > regs[q]).sum(axis=1)
            fine = ~ruled_out(plus, self.m - equal - plus, self.m, g["n_shingles"][p].astype(float),
                              g["n_shingles"][q].astype(float), self.percent / 100)
            yield p[fine], q[fine], equal[fine]

    def same_unit(self, g: dict, a, b) -> np.ndarray:
        return ((g["bkey"][a] == g["bkey"][b]) & (g["band"][a] == g["band"][b])
                & (g["bi"][a] == g["bi"][b]) & (g["bj"][a] == g["bj"][b]))

    def pairs(self, g: dict) -> Iterator[tuple]:
        """Row numbers of the pairs of whole units, some units at once."""
        n = len(g["node"])
        new = np.ones(n + 1, bool)
        new[1:n] = ~self.same_unit(g, slice(1, n), slice(0, n - 1))
        edges = np.flatnonzero(new)
        i, j, size = [], [], 0
        for s, e in zip(edges[:-1], edges[1:]):
            a, b = _unit_pairs(g, s, e)
            i.append(a)
            j.append(b)
            size += len(a)
            if size >= PAIRS_AT_ONCE:
                yield np.concatenate(i), np.concatenate(j)
                i, j, size = [], [], 0
        if i:
            yield np.concatenate(i), np.concatenate(j)

    def chosen(self, g: dict, p: np.ndarray, q: np.ndarray, equal: np.ndarray) -> np.ndarray:
        """Which of the pairs to give."""
        keep = np.zeros(len(p), bool)
        if self.find == "closest":
            for end in (p, q):                          # the best pair of each row, as first and as second end
                order = np.lexsort((-equal, end))
                keep[order[np.r_[True, end[order][1:] != end[order][:-1]]]] = True
        else:
            both = _sizes_of_overlap(g["set"], p, q)
            union = g["n_shingles"][p] + g["n_shingles"][q] - both
            linked = np.flatnonzero(100 * both >= self.percent * union)
            ends = np.sort(np.stack([g["comp"][p[linked]], g["comp"][q[linked]]]), axis=0)
            keep[linked[np.unique(ends, axis=1, return_index=True)[1]]] = True
        return keep

    def work(self, g: dict) -> pa.RecordBatch:
        g["regs"] = np.frombuffer(b"".join(g["regs"]), np.uint8).reshape(-1, self.m)
        us, vs, members = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in self.pairs(g):
            found = list(self.judged(g, i, j))
            if not found:
                continue
            p, q, equal = (np.concatenate([f[k] for f in found]) for k in range(3))
            if self.find == "open":
                members.append(np.unique(np.concatenate([p, q])))
            elif len(p):
                keep = self.chosen(g, p, q, equal)
                end = g["node" if self.find == "closest" else "comp"]
                us.append(np.maximum(end[p[keep]], end[q[keep]]))
                vs.append(np.minimum(end[p[keep]], end[q[keep]]))
        if self.find == "open":
            rows = np.concatenate(members)
            return pa.RecordBatch.from_arrays([pa.array(g[k][rows]) for k in self.KEYS], names=self.KEYS)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = ["regs", "set"] if self.find == "links" else ["regs"]
        rest: dict | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            g = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in self.KEYS + ["comp", "n_shingles"]}
            g["regs"] = batch.column("regs").to_pylist()
            if self.find == "links":
                g["set"] = list(batch.column("set").to_numpy(zero_copy_only=False))
            if rest is not None:
                g = {n: rest[n] + g[n] if n in lists else np.concatenate([rest[n], g[n]]) for n in g}
            last = len(g["bkey"]) - 1                    # the last unit may go on in the next batch
            before = np.flatnonzero(~self.same_unit(g, slice(0, last + 1), slice(last, last + 1)))
            cut = before[-1] + 1 if len(before) else 0
            rest = {n: x[cut:] for n, x in g.items()}
            if cut:
                yield self.work({n: x[:cut] for n, x in g.items()})
        if rest is not None:
            yield self.work(rest)


def _full_sets(docs: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """node, cid, set (sorted) of the classes ``needed`` (node, cid, s_rk)."""
    texts = docs.select("doc_id", "text", text_key().alias("rk"))
    texts = texts.join(needed, (texts["doc_id"] == needed["node"]) & (texts["rk"] == needed["s_rk"])).select(
        "node", "cid", "text").dropDuplicates(["node", "cid"])
    return map_column(texts, ["node", "cid"], "text", lambda all_texts: {
        "set": [np.sort(shingle_set(to_bytes(t, lower=True), size).astype(np.int64)) for t in all_texts]},
        {"set": "array<long>"})


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("u"), F.col("set").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("set").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    joined = pairs.join(a, "u").join(b, "v").select("u", "v", both.alias("both"), F.size("a").alias("na"),
                                                    F.size("b").alias("nb"))
    return joined.filter(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("u", "v")


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id) of every row.

    Documents are linked when 100 * |intersection| >= percent * |union| of their ``size``-word shingles.
    """
    bands = bands_for(percent / 100)
    sketches = materialize(sketch(docs, size, bands * ROWS), "sketches")
    same = ["n_shingles", "h1", "h2"]
    # classes of equal sets; the node of a class is its smallest doc_id (a document of several rows may
    # be the node of several classes: cid tells them apart)
    classes = materialize(sketches.filter("n_shingles > 0 and doc_id is not null").groupBy(*same).agg(
        F.min("doc_id").alias("node"), F.min_by("regs", "doc_id").alias("regs"), F.min_by("rk", "doc_id").alias("rk"))
        .withColumn("cid", F.col("h1")), "classes")
    member = materialize(_members(classes, bands), "members")
    judged = classes.select("node", "cid", "n_shingles", "regs")
    unit = ["bkey", "bi", "bj"]

    def walk(rows: DataFrame, find: str) -> DataFrame:
        return rows.repartition(*unit).sortWithinPartitions("bkey", "band", "bi", "bj", "block", "node").mapInArrow(
            _Units(find, bands, percent), _Units.OUT[find])

    first = materialize(walk(_first_units(member).withColumn("comp", F.col("node")).join(judged, ["node", "cid"]),
                             "closest").distinct(), "candidates")
    keyed = classes.select("node", "cid", F.col("rk").alias("s_rk"))
    # full sets of the classes that have a candidate partner
    sets = materialize(_full_sets(docs, first.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(
        keyed, "node"), size), "shingle-sets")
    links = materialize(_verified(first, sets, percent), "links")
    rows = materialize(sketches.drop("regs", "rk").join(classes.select(*same, "node"), same, "left"), "rows")
    # a document with several rows links its classes
    own = rows.select("doc_id", "node").distinct()
    split = own.groupBy("doc_id").agg(F.min("node").alias("v"), F.count("node").alias("n")).filter("n > 1")
    links = links.unionByName(own.join(split, "doc_id").select(F.col("node").alias("u"), "v"))
    comp = materialize(components(links), "components")
    # members that may still have a link to another component meet once more, with their sets
    of = classes.join(comp, "node", "left").select("node", "cid", F.coalesce("component", "node").alias("comp"),
                                                   "n_shingles", "regs")
    open_members = materialize(walk(_open_units(member, comp).join(judged, ["node", "cid"]), "open"), "open")
    more = materialize(_full_sets(docs, open_members.select("node", "cid").distinct().join(
        sets.select("node", "cid"), ["node", "cid"], "left_anti").join(keyed, ["node", "cid"]), size), "shingle-sets")
    left = open_members.join(of, ["node", "cid"]).join(sets.unionByName(more), ["node", "cid"])
    # components that such links join
    joined = components(walk(left, "links")).select(F.col("node").alias("comp"), F.col("component").alias("joined"))
    rows = rows.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component").join(
        joined, "comp", "left").withColumn("component", F.coalesce("joined", "comp"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id."""
    gone = near_duplicates(docs, percent, size).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


ORACLE = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
s as (
  select distinct doc_id, md5(array_to_string(words[i:i + 4], ' ')) as h
  from (select *, unnest(range(1, greatest(len(words) - 3, 2))) as i from w where len(words) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
pair as (select a.doc_id as u, b.doc_id as v, count(*) as shared from s a join s b on a.h = b.h and a.doc_id <> b.doc_id
         group by all),
link as (select u, v from pair join n a on a.doc_id = u join n b on b.doc_id = v
         where 100 * shared >= 85 * (a.n + b.n - shared)),
reach as (select doc_id, doc_id as other from w union select reach.doc_id, link.v from reach join link on link.u = other),
c as (select doc_id, min(other) as component_id from reach group by doc_id)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, component_id, w.doc_id = component_id as kept
from w join c using (doc_id) left join n using (doc_id)
"""
