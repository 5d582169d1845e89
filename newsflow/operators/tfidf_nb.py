"""M-R: exact-vocabulary TF-IDF + multinomial Naive Bayes as relational jobs.

This is the oracle-checkable twin of the five-stage ML model (tokenize,
stop words, term frequencies, IDF, Naive Bayes) with the hashing step
replaced by the exact term.  The formulas are Spark's:

* ``idf(t)   = ln((N + 1) / (df(t) + 1))``, and 0 when ``df(t) < minDocFreq``
* ``pi_c     = ln(n_c + l) - ln(N + 2 l)``
* ``theta_ct = ln(S_ct + l) - ln(S_c + l V)`` with ``S_ct = idf(t) * tf_c(t)``
* ``score_c(d) = pi_c + sum over tokens t of d: idf(t) * theta_ct``

``V`` is the training vocabulary size.  Labels are 0.0 (fake) and 1.0 (true).

Training is ONE scan of the training documents and ONE aggregation keyed by
term: each document emits its tokens (occurrence counts) and its distinct
tokens (document frequency) in a single ``explode``, and the partial
(map-side) aggregation collapses hot terms before the shuffle.  The per-term
table is written to the shared checkpoint folder.  Scoring deals the documents into
blocks, joins each block's distinct terms with the weight table without a hint
(AQE picks the join from real sizes) and sums per document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.text import compute_once, preprocessed_content, terms
from ..session import materialize

DOCS_PER_BLOCK = 1000     # documents that are scored together, about


def prepare(articles: DataFrame, min_content_chars: int | None = C.MIN_CONTENT_CHARS,
            keep=("article_id", "subject", "label")) -> DataFrame:
    """T3 + T4 + X1: preprocessed ``content`` plus the ``keep`` columns."""
    out = compute_once(articles.select(*[c for c in keep if c in articles.columns], "title", "text"),
                       {"content": preprocessed_content("title", "text")}).drop("title", "text")
    if min_content_chars is not None:
        out = out.filter(F.length("content") > min_content_chars)
    return out


@dataclass
class RelationalNB:
    term_stats: DataFrame      # term, df, tf0, tf1, idf, theta0, theta1 (written table)
    weights: DataFrame         # term, w0, w1 for idf > 0 (the scoring table)
    pi0: float
    pi1: float
    n_docs: int
    vocab_size: int

    def predict(self, docs: DataFrame, key=("article_id",), content: str = "content") -> DataFrame:
        return predict(self, docs, key=key, content=content)


def fit(train: DataFrame, content: str = "content", label: str = "label",
        min_doc_freq: int = C.MIN_DOC_FREQ, smoothing: float = C.SMOOTHING) -> RelationalNB:
    lam = float(smoothing)
    counts = train.agg(F.count(F.lit(1)).alias("n"),
                       F.sum(F.when(F.col(label) == 1.0, 1).otherwise(0)).alias("n1")).first()
    n_docs, n1 = int(counts["n"]), int(counts["n1"] or 0)
    n0 = n_docs - n1

    per_doc = train.select(F.col(label).alias("label"), terms(content).alias("t"))
    occurrences = F.transform("t", lambda x: F.struct(x.alias("term"), F.lit(1).alias("occ"), F.lit(0).alias("doc")))
    distinct = F.transform(F.array_distinct("t"),
                           lambda x: F.struct(x.alias("term"), F.lit(0).alias("occ"), F.lit(1).alias("doc")))
    e = per_doc.select("label", F.explode(F.concat(occurrences, distinct)).alias("e"))
    stats = e.groupBy(F.col("e.term").alias("term")).agg(
        F.sum("e.doc").alias("df"),
        F.sum(F.when(F.col("label") == 0.0, F.col("e.occ")).otherwise(0)).alias("tf0"),
        F.sum(F.when(F.col("label") == 1.0, F.col("e.occ")).otherwise(0)).alias("tf1"))
    idf = F.when(F.col("df") >= min_doc_freq,
                 F.log((F.lit(n_docs) + 1.0) / (F.col("df") + 1.0))).otherwise(F.lit(0.0))
    stats = materialize(stats.withColumn("idf", idf), "nb_term_stats")

    # One pass over the (written) term table gives every model constant.
    tot = stats.agg(F.sum(F.col("tf0") * F.col("idf")).alias("s0"), F.sum(F.col("tf1") * F.col("idf")).alias("s1"),
                    F.count(F.lit(1)).alias("v")).first()
    s0, s1, v = float(tot["s0"] or 0.0), float(tot["s1"] or 0.0), int(tot["v"])
    term_stats = stats.select(
        "term", "df", "tf0", "tf1", "idf",
        (F.log(F.col("tf0") * F.col("idf") + lam) - math.log(s0 + lam * v)).alias("theta0"),
        (F.log(F.col("tf1") * F.col("idf") + lam) - math.log(s1 + lam * v)).alias("theta1"))
    weights = term_stats.filter(F.col("idf") > 0).select(
        "term", (F.col("idf") * F.col("theta0")).alias("w0"), (F.col("idf") * F.col("theta1")).alias("w1"))
    pi0 = math.log(n0 + lam) - math.log(n_docs + 2 * lam)
    pi1 = math.log(n1 + lam) - math.log(n_docs + 2 * lam)
    return RelationalNB(term_stats, weights, pi0, pi1, n_docs, v)


def _weigh(content: str):
    """Sums the weights of each document's tokens, looked up among those of its block."""
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        weights = dict(zip(known["term"].to_pylist(), zip(known["w0"].to_pylist(), known["w1"].to_pylist())))
        sums: tuple[list, list] = ([], [])
        for text in docs[content]:
            found = [weights[t] for t in (text.as_py() or "").split(" ") if t in weights]
            for k in (0, 1):
                sums[k].append(sum(w[k] for w in found))
        out = docs.drop_columns(["_block", content])
        return out.append_column("s0", pa.array(sums[0], pa.float64())).append_column("s1", pa.array(sums[1], pa.float64()))
    return run


def predict(model: RelationalNB, docs: DataFrame, key=("article_id",), content: str = "content") -> DataFrame:
    """Scores ``docs``; returns ``key`` columns + score0/1, prediction, prob_fake/true.

    ``key`` must identify a document.  Documents with no known term get the priors.
    Documents are dealt into blocks of about ``DOCS_PER_BLOCK``; a block's distinct terms are joined
    with the weight table and come back to it, so what is shuffled by term are a block's terms
    and not the tokens of every document.
    """
    key = list(key)
    blocks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.count() // DOCS_PER_BLOCK + 1)
    block = F.pmod(F.xxhash64(*key), F.lit(blocks)).alias("_block")
    asked = docs.select(block, F.col(content)).repartition("_block").select(
        "_block", F.explode(F.array_distinct(terms(content))).alias("term")).groupBy("_block", "term").agg(F.count(F.lit(1)).alias("docs"))
    known = asked.join(model.weights, "term").select("_block", "term", "w0", "w1")
    narrow = docs.select(*key)
    sums = T.StructType(narrow.schema.fields + [T.StructField(c, T.DoubleType()) for c in ("s0", "s1")])
    weighed = docs.select(block, *key, content).groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(
        _weigh(content), sums)
    scored = weighed.groupBy(*key).agg((F.lit(model.pi0) + F.sum("s0")).alias("score0"),
                                       (F.lit(model.pi1) + F.sum("s1")).alias("score1"))
    return scored.select(
        *key, "score0", "score1",
        F.when(F.col("score1") > F.col("score0"), 1.0).otherwise(0.0).alias("prediction"),
        (1.0 / (1.0 + F.exp(F.col("score1") - F.col("score0")))).alias("prob_fake"),
        (1.0 / (1.0 + F.exp(F.col("score0") - F.col("score1")))).alias("prob_true"))
