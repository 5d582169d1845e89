"""Column-level text functions shared by training, serving and ingest.

All are built-in expressions (JVM side, inside whole-stage codegen); the
same function is used on a batch and on a streaming DataFrame, so training
and serving cannot drift apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .stopwords import MATCHABLE_STOP_WORDS

# --- fixed values: patterns -------------------------------------------------
WS_RUN = r"\s+"                     # any whitespace run (Java \s)
# Preprocessing keeps ASCII letters (lower-cased before) and whitespace.  Spelled out and by runs: Java matches
# ``[^a-zA-Z\s]`` many times slower.
NON_LETTERS = r"[^a-z \t\n\x0B\f\r]+"
ANY_TAG = r"<[^>]+>"                # the ingest cleaner's tag pattern
# Python's str.strip() removes every Unicode whitespace character; Spark's
# one-argument trim removes only blanks.  These are the characters str.strip()
# removes, in code point order: TAB LF VT FF CR, FS GS RS US, SPACE, NEL,
# NBSP, OGHAM SPACE MARK, EN QUAD .. HAIR SPACE, LINE SEP, PARAGRAPH SEP,
# NARROW NBSP, MEDIUM MATH SPACE, IDEOGRAPHIC SPACE.
UNICODE_WS_CHARS = "".join(chr(c) for c in (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B)) + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# Feed dates: RFC 822 after the weekday; seconds may be missing, the day may have one digit and the
# year two, the zone is a name or an offset.
PUBDATE_FORMATS = [f"d MMM {year} {time} {zone}" for year in ("yyyy", "yy") for time in ("H:mm:ss", "H:mm")
                   for zone in ("z", "Z")]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compute_once(df: DataFrame, cols: dict) -> DataFrame:
    """``df`` with the named columns added or replaced, each evaluated once per row.

    A filter on a derived column is normally pushed below the projection with
    the expression inlined, so an expensive expression (a regex chain over a
    whole text) runs twice -- once in the filter, before any repartition, and
    once in the projection.  Emitting the derived columns from a one-row
    generator (``inline`` of a one-element array) keeps predicates on them
    above it: each expression runs once, after the rows are spread.
    """
    rest = [c for c in df.columns if c not in cols]
    row = F.struct(*[col_(e).alias(n) for n, e in cols.items()])
    out = df.select(*rest, F.inline(F.array(row)))
    return out.select(*df.columns, *[n for n in cols if n not in df.columns])


def let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), 0)


def collapse_whitespace(c) -> Column:
    return F.regexp_replace(col_(c), WS_RUN, " ")


def clean_text(df: DataFrame, min_text_chars: int | None = C.MIN_TEXT_CHARS) -> DataFrame:
    """The ingest cleaner, in its original order.

    title/text: whitespace runs to one blank, then trim; text: tags removed
    after that (so blanks around tags survive); subject: trim + lower; then
    keep rows whose cleaned text is longer than ``min_text_chars``.
    """
    out = compute_once(df, {
        "title": F.trim(collapse_whitespace("title")),
        "text": F.regexp_replace(F.trim(collapse_whitespace("text")), ANY_TAG, ""),
        "subject": F.lower(F.trim(F.col("subject"))),
    })
    if min_text_chars is not None:
        out = out.filter(F.length("text") > min_text_chars)
    return out


def content(title="title", text="text") -> Column:
    """Title + blank + text; NULL when either side is NULL."""
    return F.concat(col_(title), F.lit(" "), col_(text))


def preprocess(c) -> Column:
    """T4: lower case, keep ASCII letters and whitespace, collapse whitespace (no trim)."""
    return F.regexp_replace(F.regexp_replace(F.lower(col_(c)), NON_LETTERS, ""), WS_RUN, " ")


def preprocessed_content(title="title", text="text") -> Column:
    return preprocess(content(title, text))


def unicode_strip(c) -> Column:
    """X3 helper: strip Unicode whitespace at both ends, like Python's strip().

    ``trim`` with a character set is linear; an anchored regex such as
    ``[ws]+$`` backtracks quadratically over a long inner whitespace run.
    """
    return F.trim(col_(c), F.lit(UNICODE_WS_CHARS))


def title_key(c="title", n: int = C.KEY_PREFIX_CHARS) -> Column:
    """Message key, the first ``n`` characters of the title."""
    return F.substring(col_(c), 1, n)


def parse_published(c) -> Column:
    """Timestamp of an RSS/Atom date string, NULL when no format fits."""
    s = F.regexp_replace(F.regexp_replace(F.trim(col_(c)), r"^[A-Za-z]+,\s*", ""), r"\s+", " ")
    s = F.regexp_replace(s, r" UT$", " UTC")
    tries = [F.try_to_timestamp(s, F.lit(f)) for f in PUBDATE_FORMATS]
    tries.append(F.try_to_timestamp(F.trim(col_(c))))      # ISO-8601 (Atom, RSS 1.0)
    return F.coalesce(*tries)


def article_date(published, now: Column | None = None) -> Column:
    """Published date (else the processing time) as 'Month dd, yyyy'.

    Rendered as the UTC calendar date whatever the session time zone (feed
    dates are parsed into UTC before formatting).
    """
    return article_date_of_time(F.coalesce(parse_published(published), now if now is not None else F.current_timestamp()))


def article_date_of_time(ts: Column) -> Column:
    """T7 from a timestamp."""
    return F.date_format(F.convert_timezone(None, F.lit("UTC"), ts), C.ARTICLE_DATE_FORMAT)


def iso_timestamp(ts) -> Column:
    """ISO-8601 text with microseconds, like datetime.isoformat()."""
    return F.date_format(col_(ts), C.ISO_TS_FORMAT)


def tokens(c) -> Column:
    """Relational tokenizer over preprocessed content: split on blanks, drop ''."""
    return F.filter(F.split(col_(c), " "), lambda t: t != F.lit(""))


def is_stop_word(t) -> Column:
    """Membership test; the optimizer turns the IN list into a hash set (InSet)."""
    return col_(t).isin(*MATCHABLE_STOP_WORDS)


def remove_stop_words(arr) -> Column:
    """A2 as an array expression: keeps duplicates and order (not array_except)."""
    return F.filter(col_(arr), lambda t: ~is_stop_word(t))


def terms(c) -> Column:
    """Tokens of preprocessed content without stop words."""
    return remove_stop_words(tokens(c))
