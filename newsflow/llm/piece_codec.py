"""SentencePiece BPE encoding and decoding with a table of last tokens.

Every prefix of a text has one BPE encoding and so one last token.  The table holds
it for each prefix: among the pieces that end there (found by one Aho-Corasick
automaton over the vocabulary) it is the only one that is compatible with the last
token of the prefix before it.  Two tokens are compatible if BPE leaves them as they
are when they stand alone together.  The ids are then read off backwards.  Work and
memory are linear in the text, whatever it looks like.

No piece of such a vocabulary has a blank after another character, so no merge ever
crosses there: the text is cut before each run of blanks and each different segment
of a task is encoded once while it is in a bounded memory.  A vocabulary that does
have such pieces is encoded without cuts, with the same ids.

Defined results: a null text is empty; an empty text has the end id only and decodes
to an empty text; characters outside the vocabulary become byte pieces; strings of
special tokens inside a text are plain text; a blank and U+2581 are encoded alike, so
both decode to a blank.  Equal rows give equal rows, ties between equal scores go to
the leftmost pair, an empty table gives an empty result, and other columns of the
input (whatever their names) are not read.

The model is read by the driver and travels with the task (about 1 MB), so executors
need no copy of the file.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from array import array
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame

from .tables import map_column

BLANK = "▁"
SEGMENTS = 400_000        # different segments a task remembers
PAIRS = 1_000_000         # different token pairs whose compatibility a task remembers
LONGEST = 64              # longer segments are not remembered


def load(path: str) -> dict:
    """Pieces, scores and kinds of a SentencePiece BPE model with byte pieces and no text normalization."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rules, trainer = model.normalizer_spec, model.trainer_spec
    if (trainer.model_type != pb.TrainerSpec.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix
            or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces):
        raise ValueError(f"{path}: not a BPE model with byte pieces and plain text")
    kind = pb.ModelProto.SentencePiece
    names = {kind.NORMAL: "piece", kind.BYTE: "byte", kind.CONTROL: "control", kind.UNKNOWN: "unknown"}
    if any(p.type not in names for p in model.pieces):
        raise ValueError(f"{path}: user-defined and unused pieces are not supported")
    model = {"pieces": [p.piece for p in model.pieces], "scores": [p.score for p in model.pieces],
             "kinds": [names[p.type] for p in model.pieces], "dummy_prefix": rules.add_dummy_prefix,
             "end": trainer.eos_id, "unknown": trainer.unk_surface}
    ids = {p: i for i, (p, k) in enumerate(zip(model["pieces"], model["kinds"])) if k == "piece"}
    # a piece that merging never builds is not the last token of anything
    model["built"] = [i for p, i in ids.items() if merges(p, ids, model["scores"])[-1][1:] == (p, p)]
    return model


def merges(text: str, ids: dict[str, int], scores: list[float]) -> list[tuple[float, str, str]]:
    """BPE by its definition, for the few characters of a piece: the pair of the best score is merged, the leftmost
    of equal ones, until none is in the vocabulary.  Score of each merge, and the first and last part after it; the
    first entry has the parts before all merges."""
    parts = list(text)
    out = [(0.0, parts[0], parts[-1])]
    while True:
        best, at = 0.0, -1
        for i in range(len(parts) - 1):
            j = ids.get(parts[i] + parts[i + 1])
            if j is not None and (at < 0 or scores[j] > best):
                best, at = scores[j], i
        if at < 0:
            return out
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        out.append((best, parts[0], parts[-1]))


def _one_mark(e: UnicodeDecodeError):
    """Every byte that is not UTF-8 becomes one replacement character."""
    return "�", e.start + 1


class Codec:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, model: dict):
        self.end, self.dummy_prefix = model["end"], model["dummy_prefix"]
        pieces, kinds = model["pieces"], model["kinds"]
        self.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == "piece"}
        self.scores = model["scores"]
        self.pieces = pieces
        self.length = [len(p) for p in pieces]
        built = [pieces[i] for i in model["built"]]
        self.automaton = ahocorasick.Automaton()
        for p in built:
            self.automaton.add_word(p, (self.ids[p], len(p)))
        if built:
            self.automaton.make_automaton()
        self.cut = None if any(BLANK in p.lstrip(BLANK) for p in built) else re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == "byte"}
        surface = {"piece": lambda p: p.replace(BLANK, " ").encode(), "byte": lambda p: bytes([int(p[3:5], 16)]),
                   "control": lambda p: b"", "unknown": lambda p: model["unknown"].encode()}
        self.surface = [surface[k](p) for p, k in zip(pieces, kinds)]
        self.kinds = kinds
        self.segments: dict[str, list[int]] = {}
        self.fits: list[dict[int, bool]] = [{} for _ in pieces]
        self.n_pairs = 0
        self.histories: dict[int, list] = {}
        self.controls = {i for i, k in enumerate(kinds) if k == "control"}
        self.decimal = [str(i) for i in range(len(pieces))]
        codecs.register_error("piece_codec", _one_mark)

    def history(self, token: int) -> list[tuple[float, str, str]]:
        out = self.histories.get(token)
        if out is None:
            out = self.histories[token] = merges(self.pieces[token], self.ids, self.scores)
        return out

    def stays(self, a: int, b: int) -> bool:
        """BPE of both pieces together leaves them apart: the merges of each go on in their own order, the better
        next one first, and at no time does the pair across the border come before both."""
        left, right, i, j = self.history(a), self.history(b), 1, 1
        while True:
            across = self.ids.get(left[i - 1][2] + right[j - 1][1])
            next_a = left[i][0] if i < len(left) else None
            next_b = right[j][0] if j < len(right) else None
            # of equal scores the leftmost pair comes first: in a, across, in b
            if across is not None and (next_a is None or self.scores[across] > next_a) and (
                    next_b is None or self.scores[across] >= next_b):
                return False
            if next_a is not None and (next_b is None or next_a >= next_b):
                i += 1
            elif next_b is not None:
                j += 1
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        if self.n_pairs >= PAIRS:
            for known in self.fits:
                known.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        fits = self.fits[a][b] = self.stays(a, b)
        return fits

    def last_tokens(self, text: str) -> list[int]:
        """The last token of the prefix that ends with each character; -1 where that character has no piece."""
        last, fits = [-1] * (len(text) + 1), self.fits        # one entry more: the empty prefix, at index -1
        for end, (token, length) in self.automaton.iter(text) if len(self.automaton) else ():
            if last[end] < 0:                                 # else this prefix has its token
                before = last[end - length]
                if before >= 0:
                    ok = fits[before].get(token)
                    if not (self.compatible(before, token) if ok is None else ok):
                        continue
                last[end] = token
        return last

    def segment_ids(self, text: str) -> list[int]:
        last, at, out, length = self.last_tokens(text), len(text) - 1, [], self.length
        while at >= 0:
            token = last[at]
            if token < 0:
                out.extend(self.bytes[b] for b in reversed(text[at].encode("utf-8", "surrogatepass")))
                at -= 1
            else:
                out.append(token)
                at -= length[token]
        out.reverse()
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text, without the end id."""
        if not text:
            return []
        text = (BLANK if self.dummy_prefix else "") + text.replace(" ", BLANK)
        if self.cut is None:
            return self.segment_ids(text)
        out: list[int] = []
        memory = self.segments
        for s in self.cut.findall(text):
            ids = memory.get(s)
            if ids is None:
                ids = self.segment_ids(s)
                if len(s) <= LONGEST:
                    if len(memory) >= SEGMENTS:
                        memory.clear()
                    memory[s] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: blanks for U+2581, one replacement character for each byte that is not UTF-8; the blank
        that encoding put before the text goes."""
        if self.dummy_prefix:
            first = next((i for i in ids if self.surface[i]), None)
            if first is not None and self.kinds[first] == "piece" and self.pieces[first][0] == BLANK:
                return self.plain(ids)[1:]
        return self.plain(ids)

    def plain(self, ids: list[int]) -> str:
        """Decoded parts between control tokens, as bytes on both sides of one don't join."""
        if not self.controls.isdisjoint(ids[:-1]):
            cuts = [-1, *(k for k, i in enumerate(ids) if i in self.controls), len(ids)]
            return "".join(self.plain(ids[a + 1:b]) for a, b in zip(cuts, cuts[1:]))
        data = b"".join(map(self.surface.__getitem__, ids))
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return data.decode("utf-8", "piece_codec")


def _task(model: dict, make: Callable) -> Callable:
    """A function of a list of values that builds the codec at its first call in a task."""
    held: list[Codec] = []

    def run(values: list) -> dict:
        if not held:
            held.append(Codec(model))
        return make(held[0], values)
    return run


def encode(docs: DataFrame, path: str, keep: list[str], column: str = "text") -> DataFrame:
    """Columns ``keep`` and ``ids``, the encoding of ``column`` with the end id."""
    def make(codec: Codec, texts: list) -> dict:
        return {"ids": [codec.encode(t) + [codec.end] for t in texts]}
    return map_column(docs, keep, column, _task(load(path), make), {"ids": "array<int>"})


def decode(encoded: DataFrame, path: str, keep: list[str], column: str = "ids") -> DataFrame:
    """Columns ``keep`` and ``decoded``, the text of the ids (null: empty)."""
    def make(codec: Codec, lists: list) -> dict:
        return {"decoded": [codec.decode(ids or []) for ids in lists]}
    return map_column(encoded, keep, column, _task(load(path), make), {"decoded": "string"})


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: encoded with the end id, then decoded."""
    def make(codec: Codec, texts: list) -> dict:
        out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for t in texts:
            ids = codec.encode(t) + [codec.end]
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(" ".join(map(codec.decimal.__getitem__, ids)).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(codec.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
        return out
    return map_column(docs, ["doc_id"], "text", _task(load(path), make),
                      {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"})
