"""ST5b: the feed poller as a stream.

Each micro-batch of landed feed documents is one poll.  Its documents are parsed
once; their entries become messages with batch semantics (first copy of a title
*within the poll*, D1), documents that are broken, missing or no feed go to the dead
letter with the text that gave no entry (F2), and the poll's totals to a table.  All
three are committed as whole batches, so a replayed poll replaces its output, and the
totals survive a restart.  Run with ``trigger(processingTime="2 minutes")`` for the
continuous mode or ``availableNow`` for one pass.  Cross-poll de-duplication is the
consumer's D2 (watermark-bounded), as in the ingest stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.messages import to_message
from ..operators.feeds import entries_of, errors_of, extract_entries, parse_feeds
from ..session import materialize, scratch_scope
from ..sinks.batches import clear_batch, replace_batch
from ..sinks.files import path_exists, publish
from .control import start

MESSAGE_FIELDS = ["title", "text", "subject", "date", "timestamp"]
TOTALS_SCHEMA = "documents long, broken long, entries long, messages long, guessed_dates long, batch_id int"


def poll_writer(out: str | None, fmt: str = "json", options: dict | None = None, dead_letter: str | None = None,
                totals: str | None = None):
    """``foreachBatch`` function of one poll.

    Files (``fmt`` json, parquet...) go under ``out``/batch_id=N; Kafka gets the messages with
    ``options``.  The dead letter (Parquet: the feed's columns, ``error``, ``recovered``, ``rest``) goes to
    ``dead_letter``, one row of counts to ``totals``: ``out`` + ``_dead_letter`` and ``_totals`` unless named;
    Kafka needs both names.  A poll without documents writes nothing and clears earlier attempts.
    """
    if out is None and not (dead_letter and totals):
        raise ValueError("name the folders of the dead letter and of the totals")
    dead_letter, totals = dead_letter or f"{out}_dead_letter", totals or f"{out}_totals"

    def write_poll(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if batch_df.isEmpty():
            for path in [dead_letter, totals] + ([out] if out else []):
                clear_batch(spark, path, batch_id)
            return
        with scratch_scope(spark):
            parsed = materialize(parse_feeds(batch_df), "poll")
            replace_batch(errors_of(parsed), dead_letter, batch_id)
            articles = materialize(extract_entries(entries_of(parsed)), "poll-articles")
            messages = to_message(articles, MESSAGE_FIELDS)
            if fmt == "kafka":
                publish(messages, fmt, None, options)
            else:
                replace_batch(messages, out, batch_id, fmt, options=options)
            documents = parsed.agg(F.count(F.lit(1)).alias("documents"), F.count("error").alias("broken"),
                                   F.coalesce(F.sum(F.when(F.col("items").isNotNull(), F.size("items"))), F.lit(0)).alias("entries"))
            sent = articles.agg(F.count(F.lit(1)).alias("messages"), F.count_if("date_guessed").alias("guessed_dates"))
            replace_batch(documents.crossJoin(sent), totals, batch_id)                         # one row each

    return write_poll


def running_totals(spark: SparkSession, totals: str) -> dict:
    """Sums over all polls so far, those before a restart too."""
    names = ["documents", "broken", "entries", "messages", "guessed_dates"]
    if not path_exists(spark, totals):
        return {"polls": 0, **dict.fromkeys(names, 0)}
    row = spark.read.schema(TOTALS_SCHEMA).parquet(totals).agg(
        F.count(F.lit(1)).alias("polls"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    return row.asDict()


def start_feed_stream(feed_docs: DataFrame, out: str | None, checkpoint: str, trigger: str = C.FEED_POLL_TRIGGER,
                      available_now: bool = False, fmt: str = "json", options: dict | None = None,
                      dead_letter: str | None = None, totals: str | None = None):
    """The poller (see ``poll_writer``)."""
    writer = poll_writer(out, fmt, options, dead_letter, totals)
    return start(feed_docs.writeStream.foreachBatch(writer), checkpoint, trigger, available_now)
