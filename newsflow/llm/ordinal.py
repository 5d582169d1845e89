"""Quality by ordinal regression on graded ratings (cumulative links).

One weight vector over hashed text features is shared by all grades; ordered
thresholds cut its value: P(grade <= k) = logistic(threshold_k - w.x).  A
document gets its expected grade and the tail probability of the selected grade
or better; it is kept where the tail is at least one half.

Features of a whole text: shares of hashed words, of hashed word shapes (letters
by case, digits, other signs, runs shortened) and a few plain shares (repeated
words, words equal to the one before), so length alone has no weight.  Grades are
integers; the model is fitted on labelled rows outside the held-out fold, at most
``MAX_TRAIN`` of them in expectation, chosen by a hash.

Null and empty texts have no features but the intercepts: they get the base
rates.  Null labels are left out.  One grade only (or no label) gives that grade
(0) with tail 1.  Rows are scored one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import map_column
from .toxicity import held_out_rows
from .words import to_bytes, word_hashes

MAX_TRAIN = 6_000
BITS = 13                  # hashed features: 2 ** BITS words and as many shapes
PLAIN = 4                  # plain features, at the end
PIECE = 1 << 20

_SHAPE = bytes(88 if 65 <= c <= 90 else 120 if 97 <= c <= 122 or c >= 128 else 57 if 48 <= c <= 57 else c
               for c in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        to = at + PIECE
        if to < len(data):
            cut = max(data.rfind(b" ", at, to), data.rfind(b"\n", at, to))
            to = cut + 1 if cut > at else to
        yield data[at:to]
        at = to


def featurize(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the features of a whole text."""
    size = 1 << BITS
    words, shapes, parts = np.zeros(size), np.zeros(size), []
    for piece in _pieces(to_bytes(text)):
        parts.append(word_hashes(piece.lower()))
        words += np.bincount((parts[-1] >> np.uint64(64 - BITS)).astype(np.int64), minlength=size)
        h = word_hashes(_RUNS.sub(rb"\1", piece.translate(_SHAPE)))
        shapes += np.bincount((h >> np.uint64(64 - BITS)).astype(np.int64), minlength=size)
    w = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(w):
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    x = np.concatenate([np.sqrt(words / len(w)), np.sqrt(shapes / max(1.0, shapes.sum())), [
        1 - len(np.unique(w)) / len(w), (w[1:] == w[:-1]).mean() if len(w) > 1 else 0.0,
        1.0 if len(w) < 20 else 0.0, min(1.0, np.bincount(np.unique(w, return_inverse=True)[1]).max() / len(w))]])
    at = np.flatnonzero(x)
    return at.astype(np.int32), x[at].astype(np.float32)


class Model:
    """Sorted grades, shared weights and increasing thresholds (one fewer than grades)."""

    def __init__(self, grades, weights, thresholds):
        self.grades, self.weights, self.thresholds = list(grades), np.asarray(weights), np.asarray(thresholds)

    def tails(self, z: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k]) for k = 1.. in columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -30, 30)))

    def predict(self, texts, select: int) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and P(grade >= select)."""
        z = np.array([float(self.weights[i] @ v) for i, v in map(featurize, texts)])
        if len(self.grades) < 2 or not len(z):
            g = self.grades[0] if self.grades else 0
            return np.full(len(z), float(g)), np.full(len(z), float(g >= select or not self.grades))
        t = self.tails(z)
        expected = self.grades[0] + t @ np.diff(np.asarray(self.grades, float))
        below = sum(g < select for g in self.grades)      # grades under the selected one
        return expected, np.ones(len(z)) if below == 0 else t[:, below - 1] if below <= t.shape[1] else np.zeros(len(z))


def fit_rows(rows: list, y: np.ndarray, rounds: int = 300, rate: float = 0.5, ridge: float = 1e-5) -> Model:
    """Maximum likelihood by Adam on (indices, values) rows."""
    grades = sorted({int(v) for v in y})
    dim = 2 * (1 << BITS) + PLAIN
    if len(grades) < 2:
        return Model(grades, np.zeros(dim), [])
    k = np.searchsorted(grades, y)
    doc = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    at = np.concatenate([i for i, _ in rows]) if len(rows) else np.zeros(0, np.int32)
    val = np.concatenate([v for _, v in rows]).astype(float)
    share = np.cumsum(np.bincount(k, minlength=len(grades)))[:-1] / len(y)
    first = np.log(share / (1 - share))
    # thresholds: the first, then logs of the gaps, so that they stay ordered
    p = np.concatenate([np.zeros(dim), first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, rounds + 1):
        w, gaps = p[:dim], np.exp(p[dim + 1:])
        th = np.concatenate([p[dim:dim + 1], p[dim] + np.cumsum(gaps)])
        z = np.bincount(doc, val * w[at], minlength=len(rows))
        wide = np.concatenate([[-np.inf], th, [np.inf]])
        hi, lo = (1 / (1 + np.exp(-np.clip(wide[k + s] - z, -30, 30))) for s in (1, 0))
        hi, lo = np.where(k + 1 == len(wide) - 1, 1.0, hi), np.where(k == 0, 0.0, lo)
        like = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / like, lo * (1 - lo) / like
        dz = (dhi - dlo) / len(y)                          # of -log likelihood, with respect to z
        dth = np.zeros(len(th))
        np.add.at(dth, np.minimum(k, len(th) - 1), np.where(k < len(th), -dhi, 0.0) / len(y))
        np.add.at(dth, np.maximum(k - 1, 0), np.where(k > 0, dlo, 0.0) / len(y))
        g = np.concatenate([np.bincount(at, val * dz[doc], minlength=dim) + ridge * w, [dth.sum()],
                            [dth[j + 1:].sum() * gaps[j] for j in range(len(gaps))]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(grades, p[:dim], np.concatenate([p[dim:dim + 1], p[dim] + np.cumsum(np.exp(p[dim + 1:]))]))


def training_rows(docs: DataFrame, labels: DataFrame, grade: str = "quality", max_train: int = MAX_TRAIN) -> DataFrame:
    own = labels.filter(F.col(grade).isNotNull()).filter(~held_out_rows()).select(
        "doc_id", F.col(grade).cast("int").alias("grade")).distinct()
    n = own.count()
    if n > max_train:
        own = own.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(1 << 30)) < int((1 << 30) * max_train / n))
    # the sample is bounded, so it is broadcast and the texts of all other documents stay where they are
    return docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").select("text", "grade")


def _featurize_all(texts: list) -> dict:
    rows = [featurize(t) for t in texts]
    return {"at": [r[0] for r in rows], "val": [r[1] for r in rows]}


def fit(docs: DataFrame, labels: DataFrame, grade: str = "quality", max_train: int = MAX_TRAIN) -> Model:
    rows = map_column(training_rows(docs, labels, grade, max_train), ["grade"], "text", _featurize_all,
                      {"at": "array<int>", "val": "array<float>"}).toPandas()   # bounded by max_train
    return fit_rows([(np.asarray(i, np.int32), np.asarray(v, np.float32)) for i, v in zip(rows["at"], rows["val"])],
                    rows["grade"].to_numpy())


def score(docs: DataFrame, model: Model, select: int = 1) -> DataFrame:
    """doc_id, held_out, expected_grade, tail (probability of ``select`` or better), kept of every row."""
    def run(texts: list) -> dict:
        expected, tail = model.predict(texts, select)
        return {"expected_grade": expected, "tail": tail}

    out = map_column(docs, ["doc_id"], "text", run, {"expected_grade": "double", "tail": "double"})
    return out.select("doc_id", held_out_rows().alias("held_out"), "expected_grade", "tail",
                      (F.col("tail") >= 0.5).alias("kept"))
