"""Benchmark decontamination by spaced seeds.

Native.  A mask is a pattern of token positions that count; the others may
differ.  Every position of every document and benchmark item is hashed under
each mask; equal hashes are hits.  The hits of a document on one diagonal (its
position minus the item's) are one candidate, verified along the whole
diagonal: the best stretch scores +1 for an equal token and ``-MISMATCH`` for a
substituted one and must reach ``min_score`` (or the item's length, if less).
With ``min_share``, which verdicts and decontamination set, a diagonal on which
that share of the item's tokens is equal counts too, whatever its score: short
items can't reach the score with a few tokens substituted.

Masks can miss a short item with substituted tokens.  Items of at most
``SHORT_ITEM`` tokens are therefore also looked for by the shortest mask, ``RUN`` tokens
in a row, at each of their positions: where three quarters of an item are equal,
or a stretch scores 13 with at most ten tokens substituted, there is such a run, so
none is missed.  A document's hits with the runs of the benchmark are verified where they
are found, on the tokens around them.

Tokens are runs of letters and digits, lower-cased.  Items of fewer tokens than
the longest mask are hashed whole and found where a document has all their
tokens in a row; those of fewer than ``min_tokens`` are not looked for (``too_short``
reports them).  Null and empty texts match nothing.  Rows that share ``doc_id`` (null too) are one document: one
leaking row marks them all.  Items that share an ``item_id`` are all looked for.
Empty tables give no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import compute_once
from ..session import materialize
from .tables import text_key

MASKS = ("110110010111", "101001110111")   # eight of twelve positions each
MISMATCH = 2
MIN_SCORE = 13
MIN_SHARE = 0.75
MIN_TOKENS = 1            # items of fewer tokens are not looked for
SHORT_ITEM = 64           # tokens of an item that is also looked for by runs
RUN = 3                   # (n - n/4) equal tokens of n always hold so many in a row, from 12 tokens on
SEED_SET = 50_000         # different runs of the benchmark that documents are filtered by; beyond, they are joined
BROADCAST_SEEDS = 1_000_000    # benchmark seeds: at most so many rows (16 MB) are broadcast


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def token_hashes(text: Column) -> Column:
    return F.transform(tokens(text), lambda t: F.xxhash64(t))


def seeds(df: DataFrame, hashes: str, keep: list, masks=MASKS) -> DataFrame:
    """keep..., at, seed: one row per position and mask."""
    span = max(map(len, masks))

    def of(i: Column) -> Column:
        return F.array(*[F.xxhash64(F.lit(m), *[F.get(F.col(hashes), i + j) for j, c in enumerate(mask) if c == "1"])
                         for m, mask in enumerate(masks)])

    at = F.sequence(F.lit(0), F.size(hashes) - span)
    return (df.filter(F.size(hashes) >= span)
            .select(*keep, F.posexplode(F.transform(at, of)).alias("at", "both"))
            .select(*keep, "at", F.explode("both").alias("seed")))


def whole_seeds(df: DataFrame, hashes: str, keep: list, lengths: list) -> DataFrame:
    """keep..., length, at, seed: one row per length and place of so many tokens in a row."""
    def of(n: int) -> Column:
        def seed(i: Column) -> Column:
            return F.struct(F.lit(n).alias("length"), i.alias("at"),
                            F.xxhash64(F.lit(n), *[F.get(F.col(hashes), i + j) for j in range(n)]).alias("seed"))

        return F.when(F.size(hashes) >= n, F.transform(F.sequence(F.lit(0), F.size(hashes) - n), seed))

    return df.select(*keep, F.explode(F.array_compact(F.array(*map(of, lengths)))).alias("places")).select(
        *keep, F.inline("places"))


def _best_stretch(equal: Column) -> Column:
    """struct(score, matched) of the best stretch of an array of booleans."""
    zero = F.struct(F.lit(0).alias("run"), F.lit(0).alias("got"), F.lit(0).alias("score"), F.lit(0).alias("matched"))

    def step(s: Column, e: Column) -> Column:
        run = F.greatest(F.lit(0), s["run"] + F.when(e, 1).otherwise(-MISMATCH))
        got = F.when(run == 0, 0).otherwise(s["got"] + e.cast("int"))
        better = run > s["score"]
        return F.struct(run.alias("run"), got.alias("got"), F.when(better, run).otherwise(s["score"]).alias("score"),
                        F.when(better, got).otherwise(s["matched"]).alias("matched"))

    return F.aggregate(equal, zero, step)


def run_hash(hashes: Column, i: Column) -> Column:
    return F.xxhash64(F.lit("run"), *[F.get(hashes, i + j) for j in range(RUN)])


def _run_positions(hashes: str) -> Column:
    return F.when(F.size(hashes) >= RUN, F.sequence(F.lit(0), F.size(hashes) - RUN))


def _diagonal(h: Column, ih: Column, d: Column, base: Column | int = 0) -> Column:
    """Which tokens are equal on diagonal ``d``, of the item and of the document's tokens from ``base`` on."""
    first, item_first = F.greatest(d, F.lit(0)) - base, F.greatest(-d, F.lit(0))
    n = F.least(F.size(h) - first, F.size(ih) - item_first)
    return F.zip_with(F.slice(h, first + 1, n), F.slice(ih, item_first + 1, n), lambda x, y: x == y)


def _around_runs(docs: DataFrame, runs: DataFrame, known: list) -> DataFrame:
    """doc_id, item_id, ih, equal: the diagonals of hits with the runs of short items, from the tokens around them."""
    h = F.col("h")

    def near(i: Column) -> Column:
        base = F.greatest(i - SHORT_ITEM, F.lit(0))
        return F.struct(i.alias("at"), run_hash(h, i).alias("seed"), base.alias("base"),
                        F.slice(h, base + 1, F.lit(2 * SHORT_ITEM)).alias("near"))

    # computed once: a filter on either would be pushed below with the hashing inlined for each position
    base = compute_once(docs.select("doc_id", "text"), {"h": token_hashes(F.col("text"))})
    found = compute_once(base.select("doc_id", "h"), {"hits": F.transform(
        F.filter(_run_positions("h"), lambda i: run_hash(h, i).isin(known)), near)})
    hits = found.select("doc_id", F.inline("hits")).join(F.broadcast(runs), "seed")
    equal = _diagonal(F.col("near"), F.col("ih"), F.col("at") - F.col("item_at"), F.col("base"))
    return hits.select("doc_id", "item_id", "ih", equal.alias("equal"))


def too_short(items: DataFrame, min_tokens: int) -> DataFrame:
    """item_id, n_tokens of the items that are not looked for."""
    n = F.size(tokens(F.col("text")))
    return items.select("item_id", n.alias("n_tokens")).filter(F.col("n_tokens") < min_tokens)


def overlaps(docs: DataFrame, items: DataFrame, masks=MASKS, min_score: int = MIN_SCORE,
             min_share: float | None = None, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """doc_id, item_id, score, matched: the best verified overlap of each pair that has one.

    ``matched`` counts equal tokens: of the best stretch, or of the diagonal if only ``min_share`` is reached."""
    bench = materialize(items.select("item_id", text_key().alias("item_rk"), token_hashes(F.col("text")).alias("ih")).filter(
        F.size("ih") >= max(1, min_tokens)), "benchmark-tokens")
    bench_seeds = materialize(seeds(bench, "ih", ["item_id", "item_rk"], masks).select(
        "item_id", "item_rk", F.col("at").alias("item_at"), "seed").distinct(), "benchmark-seeds")
    few = bench_seeds.count() <= BROADCAST_SEEDS
    tokenised = docs.select("doc_id", text_key().alias("rk"), token_hashes(F.col("text")).alias("h"))
    found = seeds(tokenised, "h", ["doc_id", "rk"], masks)
    hits = found.join(F.broadcast(bench_seeds) if few else bench_seeds, "seed")
    # distinct combines on the map side: a document's hits on one diagonal are one row
    diagonals = hits.select("doc_id", "rk", "item_id", "item_rk", (F.col("at") - F.col("item_at")).alias("d")).distinct()
    # short items, whole: the lengths are at most the longest mask's
    span = max(map(len, masks))
    lengths = sorted(r[0] for r in bench.filter(F.size("ih") < span).select(F.size("ih")).distinct().collect())
    if lengths:
        short = materialize(whole_seeds(bench.filter(F.size("ih") < span), "ih", ["item_id", "item_rk", "ih"], lengths).filter(
            F.col("length") == F.size("ih")).select("item_id", "item_rk", "seed").distinct(), "short-item-seeds")
        places = whole_seeds(tokenised, "h", ["doc_id", "rk"], lengths)
        places = places.join(F.broadcast(short) if short.count() <= BROADCAST_SEEDS else short, "seed")
        # one place is enough: a document may have many of a very short item
        diagonals = diagonals.unionByName(places.groupBy("doc_id", "rk", "item_id", "item_rk").agg(F.min("at").alias("d")))
    # items of up to SHORT_ITEM tokens, by their runs
    runs = materialize(bench.filter(F.size("ih").between(span, SHORT_ITEM)).select(
        "item_id", "item_rk", "ih", F.explode(_run_positions("ih")).alias("item_at")).withColumn(
        "seed", run_hash(F.col("ih"), F.col("item_at"))).distinct(), "benchmark-runs")
    n_runs = runs.select("seed").distinct().count()
    if n_runs > SEED_SET:
        places = tokenised.select("doc_id", "rk", "h", F.explode(_run_positions("h")).alias("at")).select(
            "doc_id", "rk", "at", run_hash(F.col("h"), F.col("at")).alias("seed"))
        places = places.join(runs.drop("ih"), "seed")
        diagonals = diagonals.unionByName(places.select(
            "doc_id", "rk", "item_id", "item_rk", (F.col("at") - F.col("item_at")).alias("d"))).distinct()
    diagonals = materialize(diagonals, "diagonals")
    texts = docs.select(F.col("doc_id").alias("t_id"), text_key().alias("t_rk"), F.col("text").alias("t_text"))
    texts = texts.join(diagonals.select(F.col("doc_id").alias("s_id"), F.col("rk").alias("s_rk")).distinct(),
                       F.col("t_id").eqNullSafe(F.col("s_id")) & (F.col("t_rk") == F.col("s_rk")), "left_semi")
    both = diagonals.join(texts, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("rk") == F.col("t_rk"))).join(
        bench.select(F.col("item_id").alias("b_id"), F.col("item_rk").alias("b_rk"), "ih"),
        F.col("item_id").eqNullSafe(F.col("b_id")) & (F.col("item_rk") == F.col("b_rk")))
    both = both.select("doc_id", "item_id", "d", "ih", token_hashes(F.col("t_text")).alias("h"))
    judged = both.select("doc_id", "item_id", "ih", _diagonal(F.col("h"), F.col("ih"), F.col("d")).alias("equal"))
    if 0 < n_runs <= SEED_SET:
        # at most SEED_SET numbers reach the driver, for a filter without a join
        known = [r["seed"] for r in runs.select("seed").distinct().collect()]
        judged = judged.unionByName(_around_runs(docs, runs.drop("item_rk"), known))
    judged = judged.select("doc_id", "item_id", F.size("ih").alias("length"),
                           F.size(F.filter("equal", lambda e: e)).alias("same"), "equal")
    # a diagonal with fewer equal tokens than either rule asks needs no closer look
    least = F.least("length", F.lit(min_score))
    if min_share is not None:
        least = F.least(least, F.ceil(F.lit(float(min_share)) * F.col("length")).cast("int"))
    judged = judged.filter(F.col("same") >= least).withColumn("best", _best_stretch(F.col("equal")))
    scored = F.col("best.score") >= F.least("length", F.lit(min_score))
    shared = F.lit(False) if min_share is None else F.col("same") >= F.lit(float(min_share)) * F.col("length")
    best = judged.filter(scored | shared).withColumn("matched", F.when(scored, F.col("best.matched")).otherwise(F.col("same")))
    return best.groupBy("doc_id", "item_id").agg(F.max("best.score").cast("long").alias("score"),
                                                 F.max("matched").cast("long").alias("matched"))


def verdicts(docs: DataFrame, items: DataFrame, masks=MASKS, min_score: int = MIN_SCORE,
             min_share: float | None = MIN_SHARE, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_items, item_ids (sorted), best_matched, kept."""
    leaks = overlaps(docs, items, masks, min_score, min_share, min_tokens).groupBy(F.col("doc_id").alias("leak_id")).agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("item_id")).alias("ids"), F.max("matched").alias("m"))
    out = docs.select("doc_id").join(leaks, F.col("doc_id").eqNullSafe(F.col("leak_id")), "left")
    return out.select("doc_id", F.coalesce("n", F.lit(0)).alias("n_items"),
                      F.coalesce("ids", F.array().cast(leaks.schema["ids"].dataType)).alias("item_ids"),
                      F.coalesce("m", F.lit(0)).alias("best_matched"), F.col("n").isNull().alias("kept"))


def decontaminate(docs: DataFrame, items: DataFrame, masks=MASKS, min_score: int = MIN_SCORE,
                  min_share: float | None = MIN_SHARE, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``docs`` without the documents that overlap an item."""
    leaks = overlaps(docs, items, masks, min_score, min_share, min_tokens).select(F.col("doc_id").alias("leak_id")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["leak_id"]), "left_anti")
