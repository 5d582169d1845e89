"""Registered queries of the training-data operators, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import (collocations, decontaminate, fm_substring, html_extract, line_dedup, mixing, ordinal, piece_codec,
               quality_rules, setsketch, token_alignment, toxicity, url_filter)
from .tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_quality_rules(spark, sf_dir):
    return quality_rules.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "host", *quality_rules.METRICS, "base_failed", "host_docs", "host_failed", "host_blocked", "kept")


@register
def op2_setsketch_dedup(spark, sf_dir):
    return setsketch.near_duplicates(read(spark, sf_dir, "documents"), percent=85, size=5)


@register
def op3_url_filter(spark, sf_dir):
    return url_filter.judge(read(spark, sf_dir, "pages").select("page_id", "url"), url_filter.rule_table(spark)).select(
        "page_id", "host", "path", "rule", "verdict")


@register
def op4_line_dedup(spark, sf_dir):
    return line_dedup.line_digest(read(spark, sf_dir, "documents"))


@register
def op5_ordinal_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return ordinal.score(docs, ordinal.fit(docs, read(spark, sf_dir, "labels")))


@register
def op6_fm_substring(spark, sf_dir):
    out = fm_substring.remove_repeats(read(spark, sf_dir, "documents"), size=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@register
def op7_html_extract(spark, sf_dir):
    return html_extract.extract(read(spark, sf_dir, "pages"))


@register
def op8_decontaminate(spark, sf_dir):
    return decontaminate.verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@register
def op9_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


@register
def op10_poisson_mix(spark, sf_dir):
    # whole documents are mixed and written; the result names them in the mix
    mixed = materialize(mixing.mix(read(spark, sf_dir, "documents")), "mix")
    return mixed.select("doc_id", "source", "copy", "shuffle_key")


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


@register
def op11_collocations(spark, sf_dir):
    return collocations.collocations(read(spark, sf_dir, "documents"), longest=4, least=30, share=80, top=2000)


@register
def op12_token_alignment(spark, sf_dir):
    return token_alignment.align(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                                 tokenizer_path("piece_bpe_32k.model"))


@register
def op13_piece_codec(spark, sf_dir):
    return piece_codec.round_trip(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


ORACLE: dict[str, str] = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op2_setsketch_dedup": setsketch.ORACLE,
    "op3_url_filter": url_filter.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op6_fm_substring": fm_substring.ORACLE,
    "op10_poisson_mix": mixing.ORACLE,
    "op11_collocations": collocations.ORACLE,
}
