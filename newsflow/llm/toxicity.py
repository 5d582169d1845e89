"""Toxicity by a weighted finite-state grammar over clauses.

Five transducers read the words of a clause in cascade: report, negation, target,
threat and insult.  Each has a small state (how many more words a mark stays in
force) and hands it to the next; their composition is one machine whose states and
arcs are tabulated as they are met.  It walks a text once, its state carried over the
parts that long texts are read in.  An insult word emits its weight on the arc of
the state it meets (plain, at a target, negated, reported); a threat word
emits on the threat arc near a target, before or after it, unless negated or
reported.  A document's score is a logistic function of what its clauses emit on
each arc.

Target, negation and report words and the stems of threat words are short fixed lists;
threat words may be inflected.  Insult words and word beginnings and their weights are
learned from labelled rows outside the held-out fold: at most ``MAX_TRAIN`` of them in
expectation, chosen by a hash, and at most ``MAX_TERMS`` lexicon entries, the most
telling.  Arc weights are fitted under the grammar's order: negated < reported <
plain < at a target, each by a least step, and threats by a prior where the labels
show none, so labels can't turn the meaning of a clause around.  Neither labels nor
``lang``, ``source`` or ``doc_id`` enter a score.

Null and empty texts emit nothing and get the score of a document without
matches.  Without labels (or without toxic ones) the lexicon is empty, and texts
without a threat get the base rate.  Rows are scored one by one, so repeated rows stay.  A
null ``doc_id`` is not held out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import map_column

MAX_TRAIN = 20_000
MAX_TERMS = 20_000
CHANCE = 1e-6             # a lexicon entry is seen in so many toxic documents that chance gives less than this
MIN_TOXIC_SHARE = 0.005   # and in this share of all toxic ones
MIN_PRECISION = 0.6       # share of toxic documents among those with the entry
REACHED = 4.0             # a document that emits so much is explained
ROUNDS = 6                # later rounds look only at toxic documents that the lexicon doesn't reach yet
PREFIXES = (4, 5, 6)
SCOPE = 4                 # words that a target, negation or report mark stays in force
FOLDS = 5
PIECE = 1 << 20           # characters of a text handled at once, cut at white space

# --- fixed values: function words of the grammar in four languages ----------
TARGETS = frozenset("you your yours he she they them him her these those people du dich dir ihr euch sie er tu toi vous "
                    "te il elle ils elles ustedes usted tú él ella ellos ellas".split())
NEGATIONS = frozenset("not no never don't isn't aren't wasn't nicht kein keine nie pas jamais aucun ne nunca jamás".split())
REPORTS = frozenset("said says reported according quoted wrote called alleged sagte laut zitierte schrieb selon "
                    "rapporté cité dijo según citó".split())
THREAT_STEMS = frozenset("kill murder strangl shoot stab burn hurt destroy behead slaughter poison drown töt erschieß ermord "
                         "erschlag erwürg erstech verbrenn vergift tuer étrangl égorg brûl assassin poignard empoisonn matar "
                         "asesin estrangul quemar degoll apuñal envenen".split())
THREAT_FORMS = frozenset("shot erschossen erstochen sterben mourir mourras morir morirás muere tue tuez tué mato mata "
                         "maten quemo quema".split())
THREAT_ENDINGS = frozenset("e s es d ed er ers ing ting bing bed ning t te ten st en et est é ée és ées ez ai as a ons ont "
                           "erai eras era ent ar o an aré arás ará é ás á emos án ado ada le les n".split()) | {""}

THREAT_STARTS = frozenset(s[:3] for s in THREAT_STEMS)

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]")
ENDS = frozenset(".!?;\n")
ARCS = ("plain", "target", "negated", "reported", "threat")
MEASURES = (*ARCS, "words")     # what each arc emits, and how many words the clauses have
KNOWN_WORDS = 200_000           # words whose symbol a task remembers

# Symbols that the machine reads.  A word has one mark at most (the first that fits), and may be an insult too.
INSULT, TARGET, NEGATION, REPORT, THREAT, END = 1, 2, 4, 8, 16, 32


def pieces(text: str | None) -> Iterator[str]:
    """A text in parts of bounded size, cut at line ends or blanks where there are any."""
    at, n = 0, len(text or "")
    while at < n:
        to = at + PIECE
        if to < n:
            cut = max(text.rfind("\n", at, to), text.rfind(" ", at, to))
            to = cut + 1 if cut > at else to
        yield text[at:to].lower()
        at = to


def weight_of(word: str, lexicon: dict) -> float:
    """The weight of a word: its own, else of its longest known beginning (key ends in ``*``)."""
    w = lexicon.get(word)
    if w is not None:
        return w
    for n in reversed(PREFIXES):
        if len(word) >= n:
            w = lexicon.get(word[:n] + "*")
            if w is not None:
                return w
    return 0.0


def is_threat(word: str) -> bool:
    """A threat word in one of its forms."""
    return word in THREAT_FORMS or word[:3] in THREAT_STARTS and any(
        word[:n] in THREAT_STEMS and word[n:] in THREAT_ENDINGS for n in range(3, len(word) + 1))


def mark_of(word: str) -> int:
    if word in ENDS:
        return END
    for words, mark in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)):
        if word in words:
            return mark
    return THREAT if is_threat(word) else 0


# The transducers: (state, symbol, what the earlier ones of the cascade say) -> (state, output).

def read_report(state: int, symbol: int, said: dict) -> tuple[int, int]:
    """In force until the clause ends."""
    state = 0 if symbol & END else 1 if symbol & REPORT else state
    return state, state


def read_negation(state: int, symbol: int, said: dict) -> tuple[int, int]:
    state = 0 if symbol & END else SCOPE if symbol & NEGATION else max(0, state - 1)
    return state, state


def read_target(state: tuple, symbol: int, said: dict) -> tuple[tuple, tuple]:
    """How long the target stays in force, and whether a negation before it holds with it."""
    left, denied = state
    state = (0, 0) if symbol & END else (SCOPE, int(said["negation"] > 0)) if symbol & TARGET else (max(0, left - 1), denied)
    return state, state


def read_threat(state: int, symbol: int, said: dict) -> tuple[int, bool]:
    """A threat word waits for a target; it counts when both are there, in either order."""
    if symbol & END:
        return 0, False
    state = max(0, state - 1)
    left, denied = said["target"]
    free = not said["negation"] and not said["report"]
    if symbol & TARGET and state and free:
        return 0, True
    if symbol & THREAT:
        return (0, True) if left and free and not denied else (SCOPE, False)
    return state, False


def read_insult(state: int, symbol: int, said: dict) -> tuple[int, int | None]:
    if not symbol & INSULT:
        return 0, None
    return 0, ARCS.index("reported" if said["report"] else "negated" if said["negation"] else
                         "target" if said["target"][0] else "plain")


CASCADE = (("report", read_report, 0), ("negation", read_negation, 0), ("target", read_target, (0, 0)),
           ("threat", read_threat, 0), ("insult", read_insult, 0))


class Machine:
    """The composition of the cascade: numbered states, arcs tabulated when they are first taken."""

    def __init__(self):
        self.states: list[tuple] = [tuple(start for _, _, start in CASCADE)]
        self.number = {self.states[0]: 0}
        self.arcs: dict[int, tuple[int, int | None, bool]] = {}

    def arc(self, state: int, symbol: int) -> tuple[int, int | None, bool]:
        """Next state, the arc that an insult emits on (or None), whether a threat is complete."""
        key = state << 6 | symbol
        found = self.arcs.get(key)
        if found is None:
            said: dict = {}
            after = []
            for (name, step, _), own in zip(CASCADE, self.states[state]):
                own, said[name] = step(own, symbol, said)
                after.append(own)
            to = self.number.setdefault(tuple(after), len(self.states))
            if to == len(self.states):
                self.states.append(tuple(after))
            found = self.arcs[key] = (to, said["insult"], said["threat"])
        return found


class Reader:
    """Walks texts with the machine and a lexicon."""

    def __init__(self, lexicon: dict):
        self.lexicon, self.machine = lexicon, Machine()
        self.symbols: dict[str, tuple[int, float] | None] = {}

    def learn(self, words: set[str]) -> None:
        """Symbol and weight of each word; None for those that the machine doesn't read."""
        if len(self.symbols) + len(words) > KNOWN_WORDS:
            self.symbols.clear()
        for word in [w for w in words if w not in self.symbols]:
            mark = mark_of(word)
            weight = 0.0 if mark & END else weight_of(word, self.lexicon)
            self.symbols[word] = (mark | (INSULT if weight else 0), weight) if mark or weight else None

    def measures(self, text: str | None) -> list[float]:
        """``MEASURES`` of a whole text: the weight its clauses emit on each arc, and its number of words."""
        out = [0.0] * len(MEASURES)
        arc, state = self.machine.arc, 0
        for piece in pieces(text):
            words = WORD.findall(piece)
            out[-1] += len(words)
            self.learn(set(words))
            at = -1
            for i, read in enumerate(map(self.symbols.__getitem__, words)):
                if read is None:
                    continue
                symbol, weight = read
                if state:                                  # words between: after ``SCOPE`` of them nothing changes
                    for _ in range(min(i - at - 1, SCOPE + 1)):
                        state = arc(state, 0)[0]
                at = i
                if not state and symbol == END:
                    continue
                state, insult, threat = arc(state, symbol)
                if insult is not None:
                    out[insult] += weight
                if threat:
                    out[4] += 1.0
            for _ in range(min(len(words) - at - 1, SCOPE + 1) if state else 0):
                state = arc(state, 0)[0]
        return out


def arcs(text: str | None, lexicon: dict) -> list[float]:
    return Reader(lexicon).measures(text)


def features(measured: np.ndarray) -> np.ndarray:
    """Logarithms: a second match adds less than the first, and chance matches grow with the number of words."""
    return np.log1p(np.asarray(measured, float))


def terms(text: str | None) -> set[str]:
    """Words of a text and their beginnings, as lexicon keys."""
    out: set[str] = set()
    for piece in pieces(text):
        for w in set(WORD.findall(piece)):
            if w not in ENDS:
                out.add(w)
                out.update(w[:n] + "*" for n in PREFIXES if len(w) >= n)
    return out


def held_out_rows():
    """crc32 of the id as text, modulo ``FOLDS``, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """text, toxic: labelled rows outside the held-out fold, about ``max_train`` of them at most."""
    own = labels.filter("toxic is not null").filter(~held_out_rows()).select("doc_id", "toxic").distinct()
    n = own.count()
    if n > max_train:
        own = own.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * max_train / n))
    # copies of one text would make its rare words look telling
    # the sample is bounded, so it is broadcast and the texts of all other documents stay where they are
    return docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").select(
        "text", F.col("toxic").cast("int").alias("toxic")).dropDuplicates()


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def rows():
        keys = list(counts[0].keys() | counts[1].keys())
        out = pd.DataFrame({"term": keys, "clean": [counts[0][k] for k in keys], "toxic": [counts[1][k] for k in keys]})
        counts[0].clear()
        counts[1].clear()
        return out.astype({"clean": "int64", "toxic": "int64"})

    for b in batches:
        for text, toxic in zip(b["text"], b["toxic"]):
            counts[1 if toxic else 0].update(terms(text))
            if len(counts[0]) + len(counts[1]) > 300_000:    # memory stays bounded; counts are added up later
                yield rows()
    yield rows()


def _reached(lexicon: dict):
    reader = Reader(lexicon)
    return F.pandas_udf(lambda texts: pd.Series([sum(reader.measures(t)[:-1]) >= REACHED for t in texts], dtype=bool),
                        "boolean")


def learn_lexicon(train: DataFrame, max_terms: int = MAX_TERMS) -> dict:
    """Lexicon key -> log-odds of toxic documents; the beginnings of words make unseen forms known.

    Sequential covering: each round counts words over the clean documents and those toxic ones that
    nothing in the lexicon reaches, so that bystanders of known insults don't enter.
    """
    sizes = {int(r["toxic"] != 0): r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not toxic or not clean:
        return {}
    lexicon: dict = {}
    left = toxic
    for _ in range(ROUNDS):
        rows = train
        if lexicon:
            rows = train.filter((F.col("toxic") == 0) | ~_reached(lexicon)(F.col("text")))
            left = rows.filter("toxic <> 0").count()
        counted = rows.mapInPandas(_count_terms, "term string, clean long, toxic long").groupBy("term").agg(
            F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
        share, both = max(left, 1) / (left + clean), F.col("toxic") + F.col("clean")
        precise = F.col("toxic") / both
        # Chernoff bound on the chance of so many toxic documents among those with the entry
        surprise = F.col("toxic") * F.log(precise / share) + F.when(
            F.col("clean") > 0, F.col("clean") * F.log((1 - precise) / (1 - share))).otherwise(0.0)
        best = (counted.filter((F.col("toxic") >= MIN_TOXIC_SHARE * toxic) & (precise >= MIN_PRECISION) &
                               (surprise >= -math.log(CHANCE)))
                .select("term", odds.alias("w")).filter("w > 0").orderBy(F.desc("w"), "term")
                .limit(max_terms - len(lexicon)).collect())
        if not best:
            break
        top = max(r["w"] for r in best)
        # of the first round's finds only the most frequent are sure; the rest may be their bystanders
        lexicon.update((r["term"], float(r["w"])) for r in best if r["w"] >= top - 2.0)
    return lexicon


def _emit(lexicon: dict) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(lexicon)
        for b in batches:
            out = pd.DataFrame([reader.measures(t) for t in b["text"]], columns=list(MEASURES), dtype=float)
            out["toxic"] = b["toxic"].to_numpy()
            yield out
    return run


# Steps between the arcs, in the order in which they are fitted: (least value, prior mean, prior strength).
STEPS = {"negated": (0.0, 0.0, 1e-2), "reported over negated": (0.25, 0.5, 1e-1), "plain over reported": (0.5, 1.0, 1e-1),
         "target over plain": (0.5, 1.0, 1e-1), "threat": (1.0, 6.0, 1.0), "words": (-0.7, 0.0, 1e-2),
         "intercept": (-12.0, 0.0, 1e-6)}
MOST_PER_WORD = 0.0       # long documents have more matches by chance; words never add to a score


def in_steps(x: np.ndarray) -> np.ndarray:
    """Columns whose weights are ``STEPS``: a step counts for every arc above it."""
    plain, target, negated, reported, threat, words = features(x).T
    return np.column_stack([negated + reported + plain + target, reported + plain + target, plain + target, target, threat,
                            words, np.ones(len(x))])


def fit_arcs(x: np.ndarray, y: np.ndarray, rounds: int = 500) -> np.ndarray:
    """Logistic regression under ``STEPS``, one step at a time by Newton; weights of ``MEASURES`` and the intercept."""
    a = in_steps(np.asarray(x, float))
    least, mean, strength = np.array(list(STEPS.values())).T
    most = np.full(len(least), np.inf)
    most[list(STEPS).index("words")] = MOST_PER_WORD
    u = np.clip(mean, least, most)
    z = a @ u
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(u)):
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            slope = a[:, j] @ (p - y) + strength[j] * (u[j] - mean[j])
            bend = (a[:, j] ** 2) @ (p * (1 - p)) + strength[j] + 1e-9
            new = float(np.clip(u[j] - np.clip(slope / bend, -2, 2), least[j], most[j]))
            z += a[:, j] * (new - u[j])
            moved, u[j] = max(moved, abs(new - u[j])), new
        if moved < 1e-5:
            break
    negated, reported, plain, target = np.cumsum(u[:4])
    return np.array([plain, target, negated, reported, *u[4:]])


class Model:
    """A lexicon and arc weights (the last is the intercept)."""

    def __init__(self, lexicon: dict, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, np.asarray(weights, float)
        self.reader = Reader(lexicon)

    def scores(self, texts) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        z = features(np.array([self.reader.measures(t) for t in texts])) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_terms: int = MAX_TERMS) -> Model:
    # written once: every round of the fit reads the sample and not all documents
    train = materialize(training_rows(docs, labels, max_train), "toxicity-sample")
    lexicon = learn_lexicon(train, max_terms)
    # the sample is bounded, so its few numbers per row fit the driver
    rows = train.mapInPandas(_emit(lexicon), ", ".join(f"{a} double" for a in MEASURES) + ", toxic int").toPandas()
    y = (rows["toxic"] != 0).to_numpy(float)
    if not lexicon:
        base = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 1e-6
        return Model({}, np.array([0.0] * 4 + [STEPS["threat"][1], 0.0, math.log(base / (1 - base))]))
    return Model(lexicon, fit_arcs(rows[list(MEASURES)].to_numpy(float), y))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    out = map_column(docs, ["doc_id"], "text", lambda texts: {"score": model.scores(texts)}, {"score": "double"})
    return out.select("doc_id", held_out_rows().alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, model: Model, at: float = 0.5) -> DataFrame:
    """``docs`` without the documents whose score is ``at`` or more.  One pass, no shuffle."""
    score_texts = F.pandas_udf(lambda texts: pd.Series(model.scores(texts)), "double")
    return docs.filter(score_texts(F.col("text")) < at)
