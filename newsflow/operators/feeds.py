"""Feed extraction as Spark jobs.

The order of the filters is the original one: cut each feed to its first
entries (W1), drop blank titles (X3), keep the first copy of each title (D1)
-- a title counts as seen *before* the text-length test -- then drop short
texts (X4).  The summary's visible text (T2) is row-local, so it is computed
before D1 without changing which rows survive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.html import clean_html
from ..functions.text import article_date_of_time, compute_once, iso_timestamp, let, parse_published, unicode_strip
from ..schema import CORRUPT_XML, ENTRY_XML_SCHEMA, FEED_XML_SCHEMA

FEED_ORDER = ("feed_pos", "url", "pos", "fetched_at")
FEED_COLUMNS = ("subject", "feed_pos", "url", "fetched_at")
# Namespaces are ignored on no account: names keep their prefix.
XML_OPTIONS = {"columnNameOfCorruptRecord": CORRUPT_XML, "ignoreNamespace": "false", "mode": "PERMISSIVE"}

# --- fixed values: namespaces whose elements are read, and the prefix that the schemas use for them ------------
DEFAULT_NAMESPACES = ["http://www.w3.org/2005/Atom", "http://purl.org/atom/ns#", "http://purl.org/rss/1.0/"]
PREFIXED_NAMESPACES = {"dc": "http://purl.org/dc/elements/1.1/", "content": "http://purl.org/rss/1.0/modules/content/",
                       "itunes": "http://www.itunes.com/dtds/podcast-1.0.dtd"}
# A prefix of the feed's own elements: that of the root (or of the channel below an RDF root).
ROOT_PREFIX = r"<([A-Za-z_][\w.-]*):(?:feed|channel)[\s>]"
ENTRY = r"(?s)<(?:item|entry)(?:\s[^>]*)?>.*?</(?:item|entry)\s*>"
ENTRIES_END = r"(?s)^.*</(?:item|entry)\s*>"
LAST_START = r"(?s)^.*(?=<(?:item|entry)[\s>])"
BARE_AMPERSAND = "&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#[xX][0-9a-fA-F]+);)"
NOT_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]"


def _declared(xml: Column, uri: str) -> Column:
    """The prefix that a document declares for a namespace ('' if none)."""
    return F.regexp_extract(xml, r"""xmlns:([A-Za-z_][\w.-]*)\s*=\s*["']""" + uri.replace(".", r"\.") + """["']""", 1)


def _renamed(xml: Column, prefix: Column, to: str) -> Column:
    """Tags with ``prefix`` under another one ('' for none)."""
    return F.when(prefix.isin("", to.rstrip(":")), xml).otherwise(
        F.regexp_replace(xml, F.concat(F.lit("(</?)"), F.replace(prefix, F.lit("."), F.lit("[.]")), F.lit(":")), F.lit(f"$1{to}")))


def canonical_prefixes(xml: Column) -> Column:
    """The document with the prefixes that the schemas use, whatever prefixes it declares.

    Only elements of the namespaces that are read change, and the feed's own lose their prefix
    only where its root (or channel) has it: ``atom:link`` inside an RSS channel is another element.
    """
    def without_own(xml: Column) -> Column:
        own = F.regexp_extract(xml, ROOT_PREFIX, 1)
        uris = [_declared(xml, uri) for uri in DEFAULT_NAMESPACES]
        return F.when(own.isin(*uris), _renamed(xml, own, "")).otherwise(xml)

    xml = let(xml, lambda x: F.when(x.rlike(ROOT_PREFIX), without_own(x)).otherwise(x))
    for prefix, uri in PREFIXED_NAMESPACES.items():
        xml = let(xml, lambda x: F.when(x.contains(uri), _renamed(x, _declared(x, uri), f"{prefix}:")).otherwise(x))
    return xml


def parsed_feed(xml="xml") -> Column:
    """The document parsed once: RSS 2.0, RSS 1.0 (RDF) and Atom fields side by side."""
    return F.from_xml(canonical_prefixes(F.col(xml) if isinstance(xml, str) else xml), FEED_XML_SCHEMA, XML_OPTIONS)


def _first_text(*cs: Column) -> Column:
    """The first that is not blank, else the first."""
    return F.coalesce(*[F.when(unicode_strip(c) != "", c) for c in cs], *cs)


def entry_fields(e: Column) -> Column:
    """``(title, description, published)`` of a parsed item or entry.

    The summary is the RSS description or the Atom summary; an entry without one has its full
    text there (``content:encoded``, Atom ``content``) or its ``itunes:summary``.  It was published at
    ``pubDate``, ``dc:date`` or Atom's published (0.3: issued), or else updated (0.3: modified).
    """
    return F.struct(
        e["title"].alias("title"),
        _first_text(e["description"], e["summary"], e["content:encoded"], e["content"], e["itunes:summary"]).alias("description"),
        F.coalesce(*[e[c] for c in ("pubDate", "dc:date", "published", "issued", "updated", "modified")]).alias("published"))


def feed_items(doc: Column) -> Column:
    """Array of the ``entry_fields`` of a parsed document."""
    return F.transform(F.coalesce(doc["channel"]["item"], doc["item"], doc["entry"]), entry_fields)


def plain_markup(xml: Column) -> Column:
    """The document without CDATA sections (their text escaped), comments and characters that XML forbids.

    A section that never ends stays as it is.
    """
    def section(part: Column) -> Column:
        text = F.substring_index(part, "]]>", 1)
        for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(char), F.lit(ref))
        rest = F.substring(part, F.instr(part, F.lit("]]>")) + 3, F.length(part))
        return F.when(part.contains("]]>"), F.concat(text, rest)).otherwise(F.concat(F.lit("<![CDATA["), part))

    sections = let(F.split(F.regexp_replace(xml, NOT_XML, ""), r"<!\[CDATA\[", -1), lambda parts: F.concat(
        F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), section), "")))
    return F.regexp_replace(sections, r"(?s)<!--.*?-->", "")


def recovered(xml: Column) -> Column:
    """``(items, rest)`` of a document that doesn't parse: its complete entries, each parsed by itself with stray
    ampersands and unknown references escaped, and what none of them holds."""
    def entry(found: Column) -> Column:
        # from the last start tag on: an entry that never ends must not take the next one with it
        return let(F.regexp_replace(found, LAST_START, ""), lambda e: F.struct(
            F.left(found, F.length(found) - F.length(e)).alias("before"), e.alias("xml"),
            F.from_xml(F.regexp_replace(e, BARE_AMPERSAND, "&amp;"), ENTRY_XML_SCHEMA, XML_OPTIONS).alias("entry")))

    def cut(text: Column) -> Column:
        # behind the last end tag there is no complete entry to look for
        return let(F.regexp_extract(text, ENTRIES_END, 0), lambda body: F.struct(
            F.transform(F.regexp_extract_all(body, F.lit(ENTRY), F.lit(0)), entry).alias("each"),
            F.concat(F.regexp_replace(body, ENTRY, ""), F.substring(text, F.length(body) + 1, F.length(text))).alias("rest")))

    return let(plain_markup(canonical_prefixes(xml)), cut)


def parse_feeds(feeds: DataFrame) -> DataFrame:
    """F1 + F2: each document parsed once.  The columns of the feed that are there, ``items`` (``entry_fields``),
    ``error`` (null, ``missing``, ``broken`` or ``no feed``) and ``rest``, the text that gave no entry.

    A broken document keeps its complete entries; a feed without entries is no error.
    """
    keep = [c for c in FEED_COLUMNS if c in feeds.columns]
    parsed = compute_once(feeds.select(*keep, "xml"), {"doc": parsed_feed()})
    doc, broken = F.col("doc"), F.col("doc")[CORRUPT_XML].isNotNull()
    no_feed = doc["channel"].isNull() & doc["item"].isNull() & doc["entry"].isNull() & doc["title"].isNull()
    cut = compute_once(parsed, {"cut": F.when(broken, recovered(F.col("xml")))})
    whole = F.filter(F.col("cut.each"), lambda e: e["entry"][CORRUPT_XML].isNull())
    lost = F.filter(F.col("cut.each"), lambda e: e["entry"][CORRUPT_XML].isNotNull())
    return cut.select(
        *keep, F.when(broken, F.transform(whole, lambda e: entry_fields(e["entry"]))).otherwise(feed_items(doc)).alias("items"),
        F.when(F.col("xml").isNull(), "missing").when(broken, "broken").when(no_feed, "no feed").alias("error"),
        F.when(broken, F.concat(F.array_join(F.transform(F.col("cut.each"), lambda e: e["before"]), ""),
                                F.array_join(F.transform(lost, lambda e: e["xml"]), ""), F.col("cut.rest"))).otherwise(
            F.when(no_feed, F.col("xml"))).alias("rest"))


def entries_of(parsed: DataFrame) -> DataFrame:
    """one row per entry of ``parse_feeds``, ``pos`` = position inside its feed (0-based)."""
    keep = [c for c in FEED_COLUMNS if c in parsed.columns]
    return parsed.select(*keep, F.posexplode("items").alias("pos", "item")).select(
        *keep, "pos", F.col("item.title").alias("title"), F.col("item.description").alias("summary"),
        F.col("item.published").alias("published"))


def errors_of(parsed: DataFrame) -> DataFrame:
    """documents of ``parse_feeds`` that are missing, don't parse as a whole or are no feed (the dead letter):
    the columns of the feed, ``error``, ``recovered`` (entries kept all the same) and ``rest``."""
    keep = [c for c in FEED_COLUMNS if c in parsed.columns]
    return parsed.filter("error is not null").select(
        *keep, "error", F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).alias("recovered"), "rest")


def feed_entries(feeds: DataFrame) -> DataFrame:
    """F1 from documents."""
    return entries_of(parse_feeds(feeds))


def feed_errors(feeds: DataFrame) -> DataFrame:
    """F2 from documents."""
    return errors_of(parse_feeds(feeds))


def first_entries(entries: DataFrame, n: int = C.ENTRIES_PER_FEED) -> DataFrame:
    """The first ``n`` entries of each feed (positions come from posexplode)."""
    return entries.filter(F.col("pos") < n)


def nonempty_titles(entries: DataFrame) -> DataFrame:
    """Titles stripped of Unicode whitespace; blank or missing titles dropped."""
    stripped = compute_once(entries, {"title": unicode_strip(F.coalesce(F.col("title"), F.lit("")))})
    return stripped.filter(F.col("title") != "")


def first_by_title(entries: DataFrame, order=FEED_ORDER) -> DataFrame:
    """Keep the first copy of each exact title in (feed, url, entry, fetch time) order.

    One aggregation: the copies of a hot title are combined on the map side, so no
    task ever receives all of them.  NULL feed positions and urls come first, and
    of copies that are equal in all of the order one stays.
    """
    order = [c for c in order if c in entries.columns]
    first = entries.groupBy("title").agg(F.min_by(F.struct(*entries.columns), F.struct(*order)).alias("first"))
    return first.select("first.*")


def with_clean_text(entries: DataFrame) -> DataFrame:
    """Visible text of the summary ('' when missing)."""
    return entries.withColumn("text", clean_html("summary"))


def long_enough(entries: DataFrame, n: int = C.MIN_FEED_TEXT_CHARS) -> DataFrame:
    """Keep texts of at least ``n`` characters."""
    return entries.filter(F.length(F.coalesce(F.col("text"), F.lit(""))) >= n)


def extract_feeds(feeds: DataFrame, n_entries: int = C.ENTRIES_PER_FEED,
                  min_text: int = C.MIN_FEED_TEXT_CHARS, now: Column | None = None) -> DataFrame:
    """Feed documents -> article messages ``title, text, subject, date, timestamp, date_guessed``
    (plus ``feed_pos, url, pos`` for lineage), in one plan with one shuffle.

    Messages are dated by the time of the poll: an entry without a date that parses
    gets ``now`` (default: the document's ``fetched_at``, else the clock) and is
    flagged in ``date_guessed``, so a replayed poll gives the same messages.
    """
    return extract_entries(feed_entries(feeds), n_entries, min_text, now)


def extract_entries(e: DataFrame, n_entries: int = C.ENTRIES_PER_FEED, min_text: int = C.MIN_FEED_TEXT_CHARS,
                    now: Column | None = None) -> DataFrame:
    """``extract_feeds`` from the entries on."""
    e = first_entries(e, n_entries)
    e = nonempty_titles(e)
    e = first_by_title(with_clean_text(e).drop("summary"))
    e = long_enough(e, min_text)
    if now is None:
        now = F.coalesce("fetched_at", F.current_timestamp()) if "fetched_at" in e.columns else F.current_timestamp()
    dated = compute_once(e.withColumn("now", now), {"published": parse_published("published")})
    return dated.select("title", "text", "subject", article_date_of_time(F.coalesce("published", "now")).alias("date"),
                        iso_timestamp("now").alias("timestamp"), F.col("published").isNull().alias("date_guessed"),
                        "feed_pos", "url", "pos")
