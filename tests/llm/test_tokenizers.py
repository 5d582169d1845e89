"""Tokenizer operators against the public libraries and a brute-force alignment."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsflow.llm import piece_codec, token_alignment
from newsflow.llm.queries import tokenizer_path

from ..conftest import SF_SMALL
from .fixtures import awkward_texts, documents, empty, rows

P = tokenizer_path("piece_bpe_32k.model")
A = tokenizer_path("byte_bpe_50k.json")
STRANGE = ["", " ", "  a", "a  b ", "\x00a", "a\nb", "▁x", "aa▁ ▁b", "</s>hi<s><unk>", "<0x41>", "é", "é",
           "ﬁ", "﻿x", "　a", "x\ty", "\U0001f600", " " * 37, "a" * 3000, "\U0010ffffx ", "<|endoftext|> b",
           "I'll don't", "12345 6", "\r\n\r\n ", "end "]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=P)


@pytest.fixture(scope="module")
def codec():
    return piece_codec.Codec(piece_codec.load(P))


def random_texts(n: int, seed: int = 5):
    r = random.Random(seed)
    parts = ["a", "b", " ", "  ", "the", "ing", "\n", "é", "▁", "1", "你", "\U0001f600", "​", "ß", "\x00", "er", "ЖЖ", "-", "=="]
    return ["".join(r.choice(parts) if r.random() < .8 else chr(r.choice([r.randrange(1, 0x3000), r.randrange(0x20, 0x7F)]))
                    for _ in range(r.randrange(25))) for _ in range(n)]


def test_ids_are_those_of_the_library(pieces, codec):
    for t in STRANGE + random_texts(4000):
        ids = codec.encode(t)
        assert ids == pieces.encode(t), repr(t)
        assert codec.decode(ids) == pieces.decode(ids), repr(t)


def test_uncut_texts_and_small_memories_give_the_same_ids(pieces, codec, monkeypatch):
    monkeypatch.setattr(piece_codec, "SEGMENTS", 3)
    monkeypatch.setattr(piece_codec, "PAIRS", 5)
    small = piece_codec.Codec(piece_codec.load(P))
    whole = piece_codec.Codec(piece_codec.load(P))
    whole.cut = None
    for t in random_texts(800, 6):
        assert small.encode(t) == whole.encode(t) == pieces.encode(t)
    assert len(small.segments) <= 3 and sum(map(len, small.fits)) <= 5


def test_every_prefix_has_one_last_token(codec, pieces):
    text = "▁unbelievablyinternationalization"
    last = codec.last_tokens(text)
    for n in range(1, len(text) + 1):
        assert last[n - 1] == pieces.encode(text[1:n])[-1] if n > 1 else last[0] == pieces.piece_to_id("▁")


def test_any_ids_decode_as_in_the_library(pieces, codec):
    r = random.Random(3)
    for _ in range(6000):
        ids = [r.choice([r.randrange(32000), r.randrange(262), r.randrange(3, 259)]) for _ in range(r.randrange(9))]
        assert codec.decode(ids) == pieces.decode(ids), ids


def test_long_texts_take_linear_time(codec, pieces):
    for t in ("ab" * 200_000, " " * 200_000, "\U0001f9ff́" * 50_000):
        assert codec.encode(t) == pieces.encode(t)


def test_a_vocabulary_with_other_rules_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    model.ParseFromString(open(P, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        piece_codec.load(str(tmp_path / "m.model"))


def test_round_trip_rows(spark, pieces):
    got = rows(piece_codec.round_trip(documents(spark, clash=True), P))
    want = []
    for i, t in rows(documents(spark), "doc_id", "text"):
        ids = pieces.encode(t or "", add_eos=True)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(pieces.decode(ids))))
    key = lambda t: (t[0] is not None, t[0] or 0, t[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert piece_codec.round_trip(empty(spark), P).count() == 0


def test_encode_and_decode_tables(spark, pieces):
    docs = spark.createDataFrame(list(enumerate(STRANGE)), "doc_id long, text string")
    ids = piece_codec.encode(docs, P, ["doc_id"])
    assert dict(rows(ids)) == {i: pieces.encode(t, add_eos=True) for i, t in enumerate(STRANGE)}
    back = dict(rows(piece_codec.decode(ids, P, ["doc_id"])))
    assert back == {i: t.replace("▁", " ") for i, t in enumerate(STRANGE)}


# ---------------------------------------------------------------- alignment

def brute_groups(text, byte_bpe, pieces):
    """Groups as [(A ids, B ids)] by walking both token lists byte by byte."""
    if not text:
        return []
    plain = {v: k for k, v in token_alignment._byte_of().items()}
    back = {c: b for b, c in plain.items()}
    a = byte_bpe.encode(" " + text, add_special_tokens=False).ids
    data = (" " + text).encode()
    size_a = [len(bytes(back[c] for c in byte_bpe.id_to_token(i))) for i in a]
    b = pieces.encode(text)
    bytes_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else
               pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(bytes_b) != data or sum(size_a) != len(data):
        return []
    out, i, j, at_a, at_b = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            out[-1][0].append(a[i])
            at_a += size_a[i]
            i += 1
        else:
            out[-1][1].append(b[j])
            at_b += len(bytes_b[j])
            j += 1
        if at_a == at_b:
            out.append(([], []))
    return out[:-1]


def brute_align(table, pieces):
    from tokenizers import Tokenizer
    byte_bpe = Tokenizer.from_file(A)
    byte_bpe.encode_special_tokens = True
    each = [(i, brute_groups(t, byte_bpe, pieces)) for i, t in table]
    count = Counter((a[-1], b[-1]) for _, g in each for a, b in g)
    best = {}
    for (a, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, g in each:
        links = [(a[-1], b[-1]) for a, b in g]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(g),
                    sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), sha(shown) if g else ""))
    return sorted(out, key=lambda t: (t[0] is not None, t))


@pytest.mark.parametrize("limit", [0, token_alignment.BROADCAST_ROWS])
def test_alignment_equals_brute_force(spark, pieces, monkeypatch, limit):
    monkeypatch.setattr(token_alignment, "BROADCAST_ROWS", limit)
    texts = STRANGE + random_texts(300) + awkward_texts() + random_texts(40) * 3
    table = list(enumerate(texts)) + [(None, "a null id"), (7, "repeated id")]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    for c in ("key", "a", "b", "n", "salt", "n_rows"):
        docs = docs.withColumn(c, F.lit("mine"))
    got = [tuple(r) for r in token_alignment.align(docs, A, P).collect()]
    assert sorted(got, key=lambda t: (t[0] is not None, t)) == brute_align(table, pieces)


def test_alignment_of_given_documents(spark, pieces):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted(tuple(r) for r in token_alignment.align(docs, A, P).collect())
    assert got == brute_align([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], pieces)


def test_alignment_groups_are_shown(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "▁")], "doc_id long, text string")
    got = dict(rows(token_alignment.groups(docs, A, P, ["doc_id"])))
    assert got == {1: "257|264;275|287", 2: "", 3: ""}


def test_alignment_of_nothing(spark):
    assert token_alignment.align(empty(spark), A, P).count() == 0
    only_null = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert rows(token_alignment.align(only_null, A, P)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_another_byte_vocabulary_is_refused(tmp_path):
    import json
    spec = json.load(open(A, encoding="utf-8"))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        token_alignment.load(str(tmp_path / "v.json"), P)
