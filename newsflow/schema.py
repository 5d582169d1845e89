"""Schemas of every table the jobs read or write (all columns nullable)."""

from pyspark.sql import types as T

_S = T.StringType()

# One superset message schema: the producer's fields plus the ingest job's
# extra metadata fields.  Absent fields parse as NULL.
ARTICLE_FIELDS = ["title", "text", "subject", "date", "timestamp", "source", "article_id", "scraped_at"]
ARTICLE_SCHEMA = T.StructType([T.StructField(n, _S, True) for n in ARTICLE_FIELDS])

# Field of a PERMISSIVE parse that holds the raw text of what is not a JSON object.
CORRUPT_COLUMN = "_corrupt"

# Labelled CSV files: four string columns by header.
TRAINING_CSV_SCHEMA = T.StructType([T.StructField(n, _S, True) for n in ["title", "text", "subject", "date"]])

# A landed message: the Kafka ``value`` (text in the file double).
MESSAGE_SCHEMA = T.StructType([T.StructField("key", _S, True), T.StructField("value", _S, True)])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("title", _S, True),
    T.StructField("text", _S, True),
    T.StructField("subject", _S, True),
    T.StructField("date", _S, True),
    T.StructField("prob_fake", T.DoubleType(), True),
    T.StructField("prob_true", T.DoubleType(), True),
    T.StructField("processed_at", T.TimestampType(), True),
    T.StructField("prediction_label", _S, True),
])

INGESTED_SCHEMA = T.StructType([
    T.StructField("title", _S, True),
    T.StructField("text", _S, True),
    T.StructField("source", _S, True),
    T.StructField("article_id", _S, True),
    T.StructField("processed_at", T.TimestampType(), True),
    T.StructField("subject", _S, True),
    T.StructField("date", _S, True),
])

FEED_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("subject", _S, True),
    T.StructField("feed_pos", T.IntegerType(), True),
    T.StructField("url", _S, True),
    T.StructField("xml", _S, True),
    T.StructField("fetched_at", T.TimestampType(), True),
])

# RSS 2.0, RSS 1.0 (RDF) and Atom shapes, read by one ``from_xml`` (the root element is the row).
# Names are qualified: ``description`` is the feed's own, ``media:description`` another one that is not read.
# A document that doesn't parse has its text in the corrupt-record column.
CORRUPT_XML = "corrupt"
ENTRY_FIELDS = ["title", "description", "content:encoded", "itunes:summary", "summary", "content", "pubDate", "dc:date",
                "published", "issued", "updated", "modified"]
ENTRY_XML = ", ".join(f"`{n}` string" for n in ENTRY_FIELDS)
ENTRY_XML_SCHEMA = f"{ENTRY_XML}, {CORRUPT_XML} string"
_ENTRIES = f"array<struct<{', '.join(f'`{n}`: string' for n in ENTRY_FIELDS)}>>"
FEED_XML_SCHEMA = (f"channel struct<title: string, item: {_ENTRIES}>, item {_ENTRIES}, title string, entry {_ENTRIES}, "
                   f"{CORRUPT_XML} string")
