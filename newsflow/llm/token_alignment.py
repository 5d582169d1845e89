"""Alignment of two tokenizers over exact, de-duplicated texts.

1. Rows are grouped by their full text (combined before the shuffle), so a text is
   tokenized and aligned once, however many rows hold it.
2. A task encodes each different text with a byte-level BPE vocabulary (A) and a
   SentencePiece model (B).  Where a token of A and one of B end at the same byte of
   blank + text, a group ends; its last two tokens are linked.
3. The links of a pair of ids are counted over the corpus, each text weighted by its
   number of rows.  The pair table is at most |A| x |B| rows; it is broadcast up to
   ``BROADCAST_ROWS`` rows and otherwise joined by shuffle, with salted pairs.
4. Measures of a text go back to its rows by the SHA-256 of the text.

Defined results: a text that is null or empty, or whose tokens don't spell blank +
text in both vocabularies (U+2581 reads as a blank), has no tokens: zeros and an empty
digest.  Strings of special tokens are plain text.  Of pairs with equal counts all are
best.  Equal rows count each.  Other columns of the input, whatever their names, are
not read; an empty table gives an empty result.  Groups and ids of a text are held by
one task: memory follows the longest text, not the corpus.

Vocabularies are read by the driver and travel with the task (under 3 MB).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import map_column

# How byte-level BPE of the vocabulary's family cuts a text before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BROADCAST_ROWS = 500_000
SALTS = 16


def _byte_of() -> dict[str, int]:
    """Byte of each character of byte-level entries: printable Latin-1 stands for itself, the others follow
    from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(other)}}


def load(byte_bpe_path: str, piece_path: str) -> dict:
    """Bytes of the tokens of A by id, and the model of B as bytes."""
    with open(byte_bpe_path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec["added_tokens"]}
    byte = _byte_of()
    tokens = {bytes(byte[c] for c in entry): i for entry, i in spec["model"]["vocab"].items() if entry not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    made = [tokens[bytes(byte[c] for c in a + b)] for a, b in merges]
    pre = spec["pre_tokenizer"]
    if (spec["normalizer"] or pre["type"] != "ByteLevel" or not pre.get("use_regex", True) or pre["add_prefix_space"]
            or made != sorted(made) or len(tokens) != 256 + len(made)):
        raise ValueError(f"{byte_bpe_path}: not a byte-level BPE vocabulary in merge order")
    with open(piece_path, "rb") as f:
        return {"tokens": tokens, "pieces": f.read()}


class Aligner:
    """Encodes a text with both vocabularies and cuts it where tokens of both end."""

    def __init__(self, model: dict):
        import sentencepiece
        import tiktoken
        tokens = model["tokens"]
        self.a = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=tokens, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model["pieces"])
        size_a, size_b = max(tokens.values()) + 1, self.b.get_piece_size()
        self.length_a = np.zeros(size_a, np.int64)
        for data, i in tokens.items():
            self.length_a[i] = len(data)
        self.piece = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(map(self.b.id_to_piece, range(size_b)))]
        self.length_b = np.array([len(p) for p in self.piece], np.int64)
        # an id in decimal and what follows it: within a group, or at the end of the A or B side of one
        self.shift_b = 2 * size_a
        self.size_a, self.size_b = size_a, size_b
        self.shown = [f"{i}{end}" for end in ",|" for i in range(size_a)] + [
            f"{i}{end}" for end in ",;" for i in range(size_b)]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both vocabularies; none if they don't spell blank + text."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        data = b" " + text.encode("utf-8", "surrogatepass")
        b = self.b.encode(text)
        if b"".join(map(self.piece.__getitem__, b)) != data:
            return none, none
        a = self.a.encode_ordinary(" " + text)
        if self.a.decode_bytes(a) != data:
            return none, none
        return np.array(a, np.int64), np.array(b, np.int64)

    def group_ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the tokens of each side: whether a group ends with it."""
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        seen_a, seen_b = (np.zeros(int(end_a[-1]) + 1 if len(a) else 1, bool) for _ in range(2))
        seen_a[end_a] = True
        seen_b[end_b] = True
        return seen_b[end_a], seen_a[end_b]

    def show(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        if not len(a):
            return ""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b       # group of each token
        upto_a, upto_b = np.cumsum(np.bincount(group_a)), np.cumsum(np.bincount(group_b))
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.r_[0, upto_b][group_a]] = a + last_a * self.size_a
        code[np.arange(len(b)) + upto_a[group_b]] = b + last_b * self.size_b + self.shift_b
        return "".join(map(self.shown.__getitem__, code.tolist()))[:-1]


def _aligner(model: dict, make: Callable) -> Callable:
    held: list[Aligner] = []

    def run(values: list) -> dict:
        if not held:
            held.append(Aligner(model))
        return make(held[0], values)
    return run


def _digests(x: Aligner, texts: list) -> dict:
    out = {n: [] for n in ("n_a", "n_b", "n_groups", "groups_sha256", "link_a", "link_b", "link_n")}
    for t in texts:
        a, b = x.encode(t)
        last_a, last_b = x.group_ends(a, b)
        pair, n = np.unique(a[last_a] << 32 | b[last_b], return_counts=True)
        shown = x.show(a, b, last_a, last_b)
        out["n_a"].append(len(a))
        out["n_b"].append(len(b))
        out["n_groups"].append(int(last_a.sum()))
        out["groups_sha256"].append(hashlib.sha256(shown.encode()).hexdigest() if shown else "")
        out["link_a"].append((pair >> 32).astype(np.int32))
        out["link_b"].append((pair & 0xFFFFFFFF).astype(np.int32))
        out["link_n"].append(n.astype(np.int32))
    return out


def groups(texts: DataFrame, byte_bpe_path: str, piece_path: str, keep: list[str], column: str = "text") -> DataFrame:
    """Columns ``keep`` and ``groups``: the ids of the groups of ``column``, as text."""
    def make(x: Aligner, values: list) -> dict:
        out = []
        for t in values:
            a, b = x.encode(t)
            out.append(x.show(a, b, *x.group_ends(a, b)))
        return {"groups": out}
    return map_column(texts, keep, column, _aligner(load(byte_bpe_path, piece_path), make), {"groups": "string"})


def text_digest(text: str | Column = "text") -> Column:
    return F.unhex(F.sha2(F.col(text) if isinstance(text, str) else text, 256))


def distinct_alignments(docs: DataFrame, byte_bpe_path: str, piece_path: str) -> DataFrame:
    """For each different text: key (its SHA-256), n_rows, n_a, n_b, n_groups, groups_sha256 and its links:
    ids link_a and link_b and how often the pair occurs, link_n."""
    distinct = docs.select("text").filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("n_rows"))
    return materialize(map_column(
        distinct.withColumn("key", text_digest()), ["key", "n_rows"], "text",
        _aligner(load(byte_bpe_path, piece_path), _digests),
        {"n_a": "long", "n_b": "long", "n_groups": "long", "groups_sha256": "string", "link_a": "array<int>",
         "link_b": "array<int>", "link_n": "array<int>"}), "alignments")


def _links(aligned: DataFrame, *keep: str) -> DataFrame:
    """a, b, n of each pair of a text, one row each."""
    return aligned.select(*keep, F.explode(F.arrays_zip("link_a", "link_b", "link_n")).alias("link")).select(
        *keep, F.col("link.link_a").alias("a"), F.col("link.link_b").alias("b"), F.col("link.link_n").alias("n"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, count over the corpus, and whether no pair of that b has a higher one."""
    pairs = materialize(_links(aligned, "n_rows").groupBy("a", "b").agg(
        F.sum(F.col("n") * F.col("n_rows")).alias("count")), "pair-counts")
    best = pairs.groupBy("b").agg(F.max("count").alias("best"))
    return pairs.join(best, "b").select("a", "b", "count", (F.col("count") == F.col("best")).alias("is_best"))


def link_measures(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """key, n_best, count_sum of each text that has links."""
    rows = _links(aligned, "key")
    if pairs.count() <= BROADCAST_ROWS:
        rated = rows.join(F.broadcast(pairs), ["a", "b"])
    else:
        # a pair of most texts is spread over salts
        salts = pairs.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        rated = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(
            salts, ["a", "b", "salt"])
    return rated.groupBy("key").agg(
        F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"))


def align(docs: DataFrame, byte_bpe_path: str, piece_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``."""
    aligned = distinct_alignments(docs, byte_bpe_path, piece_path)
    pairs = materialize(pair_counts(aligned), "rated-pairs")
    measures = aligned.drop("link_a", "link_b", "link_n", "n_rows").join(
        link_measures(aligned, pairs), "key", "left")
    number = ["n_a", "n_b", "n_groups", "n_best", "count_sum"]
    out = docs.select("doc_id", text_digest().alias("key")).join(measures, "key", "left").select(
        "doc_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in number],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum",
                      "groups_sha256")
