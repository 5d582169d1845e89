"""Visible text of an HTML fragment, as a chain of JVM regex expressions.

Semantics (defined here, mirrored by the SQL oracle):

1. ``script``, ``style`` and ``template`` elements are dropped with their
   bodies, and so are comments (their text is not visible text) -- in one
   left-to-right pass, so whichever construct starts first wins (a comment
   around a script removes both, as in an HTML tokenizer);
2. every remaining markup token (tag, doctype, declaration, processing
   instruction) becomes a node boundary; a ``<`` not followed by a letter,
   ``/``, ``!`` or ``?`` is text, as in an HTML tokenizer;
3. numeric and named character references are decoded, each once, as in an HTML tokenizer: old names
   also without ``;``, the longest that fits (references to no character stay);
4. each text node is stripped of Unicode whitespace, empty nodes are dropped
   and the rest are joined with one blank.

Whitespace inside a node is kept.  NULL or empty input gives ''.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_, let, unicode_strip

# --- fixed values: element and markup patterns, entity table ---------------
HIDDEN_ELEMENTS = [
    r"<script\b[^>]*>.*?</script\s*>",
    r"<style\b[^>]*>.*?</style\s*>",
    r"<template\b[^>]*>.*?</template\s*>",
    r"<!--.*?-->",
]
HIDDEN = "(?is)" + "|".join(HIDDEN_ELEMENTS)      # one pass, leftmost construct first
MARKUP = r"</?[A-Za-z][^>]*>|<[!?][^>]*>"
NODE_BREAK = "\u0001"
# Named references come from the standard library's table of HTML: names with ``;``, and old ones that may lack it.
NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
OLD_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n))
NUMBER = r"^#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});?"
NAME = r"^([A-Za-z][A-Za-z0-9]{1,31});"
OLD_NAME = f"^({'|'.join(OLD_NAMES)})"            # the longest that fits
# numbers of the C1 range mean characters of this code page, but for five of them
C1_UNDEFINED = (0x81, 0x8D, 0x8F, 0x90, 0x9D)
C1 = {c: ord(bytes([c]).decode("cp1252")) for c in range(0x80, 0xA0) if c not in C1_UNDEFINED}


def _named_texts() -> Column:
    """Texts of the names, in a map for each first letter."""
    by_first: dict[str, list] = {}
    for name, text in NAMED.items():
        by_first.setdefault(name[0], []).extend((F.lit(name), F.lit(text)))
    return F.create_map(*[x for first, pairs in by_first.items() for x in (F.lit(first), F.create_map(*pairs))])


def _number_text(number: Column) -> Column:
    """Character of a decimal or (after x) hexadecimal number; NULL for nothing, surrogates and beyond Unicode."""
    code = F.when(number.startswith("x") | number.startswith("X"), F.conv(F.substring(number, 2, 8), 16, 10)).otherwise(
        number).cast("int")
    def char(code: Column) -> Column:
        legal = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(legal, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    remapped = F.create_map(*[F.lit(x) for pair in C1.items() for x in pair])
    return let(code, lambda c: char(F.when(c.between(0x80, 0x9F), F.coalesce(F.element_at(remapped, c), c)).otherwise(c)))


def _decoded(part: Column) -> Column:
    """Text that follows a ``&`` of the source, with the reference at its start decoded (or ``&`` put back)."""
    def with_length(pattern: str, text) -> Column:
        """(text, length of the reference) of a pattern; NULL text if it isn't one."""
        return let(F.regexp_extract(part, pattern, 0), lambda whole: F.struct(
            F.when(whole != "", text(F.regexp_extract(whole, pattern, 1))).alias("text"), F.length(whole).alias("n")))

    def named(name: Column) -> Column:
        return F.element_at(F.element_at(_named_texts(), F.substring(name, 1, 1)), name)

    found = F.when(part.startswith("#"), with_length(NUMBER, _number_text)).otherwise(
        let(with_length(NAME, named), lambda f: F.when(f["text"].isNotNull(), f).otherwise(with_length(OLD_NAME, named))))
    return let(found, lambda f: F.when(f["text"].isNotNull(), F.concat(
        f["text"], F.substring(part, f["n"] + 1, F.length(part)))).otherwise(F.concat(F.lit("&"), part)))


def decode_references(s: Column) -> Column:
    """Character references decoded in one left-to-right pass (``&amp;lt;`` becomes ``&lt;``)."""
    parts = F.split(s, "&", -1)
    decoded = F.concat(F.element_at(parts, 1), F.array_join(
        F.transform(F.slice(parts, 2, F.size(parts)), _decoded), ""))
    return F.when(s.contains("&"), decoded).otherwise(s)


def clean_html(c) -> Column:
    s = F.coalesce(col_(c), F.lit(""))
    s = F.regexp_replace(s, HIDDEN, "")
    s = F.regexp_replace(s, MARKUP, NODE_BREAK)
    nodes = F.transform(F.split(s, NODE_BREAK), lambda x: unicode_strip(decode_references(x)))
    return F.array_join(F.filter(nodes, lambda x: x != F.lit("")), " ")
