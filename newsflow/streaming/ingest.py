"""ST1 ingest stream: messages -> parse -> (dead letter) -> clean -> Parquet
partitioned by ``subject, date`` (K1) and CSV (K2); D2 streaming de-duplication;
ST3 console stream.

Each query has its own explicit checkpoint location, so a restart resumes
from its offsets; the file sinks commit through ``_spark_metadata`` and give
exactly-once output per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.messages import BAD_COLUMN, parse_messages
from ..functions.text import clean_text
from ..session import materialize, scratch_scope
from ..sinks.batches import replace_batch
from ..sinks.files import CSV_WRITE_OPTIONS
from .control import observed_rows, start, start_dead_letter
from .dedupe import final_copies, first_copies, small_batches

WRITE_SALTS = 8           # tasks that one partition value of a micro-batch is written by, at most
INGEST_COLUMNS = ["title", "text", "subject", "date", "source", "article_id"]


def parsed_stream(stream: DataFrame) -> DataFrame:
    """P1 + J1 + P2 with the X5 flag; keeps the raw value for the dead letter."""
    return parse_messages(stream, flag_bad=True, required=())


def ingest_frame(parsed: DataFrame, min_text_chars: int = C.MIN_TEXT_CHARS,
                 with_event_time: bool = False) -> DataFrame:
    """T1 + P3: cleaned article rows with the processing time.

    ``with_event_time`` adds ``event_time``: the producer's ISO ``timestamp``
    of the message, or the processing time when it is missing or unparsable.
    """
    good = parsed.filter(~F.col(BAD_COLUMN)).drop(BAD_COLUMN, "raw_value", "_corrupt")
    cleaned = clean_text(good, min_text_chars)
    now = F.current_timestamp()
    extra = [F.coalesce(F.try_to_timestamp(F.col("timestamp")), now).alias("event_time")] if with_event_time else []
    return cleaned.select(*INGEST_COLUMNS, now.alias("processed_at"), *extra)


def clustered_for_write(rows: DataFrame, partition_by, n: int | None = None, salts: int = WRITE_SALTS) -> DataFrame:
    """Hash-partition a micro-batch on (partition columns, salt).

    A partition value goes to at most ``salts`` tasks, so each task writes into
    few folders and a hot value is split: the salt is a hash of the row's title
    and text, which every message has, and deterministic on retry.  A hash
    exchange reads its input once (a range exchange would sample it first).
    """
    n = n or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *partition_by, F.pmod(F.xxhash64("title", "text"), F.lit(salts)))


def write_both(out: str):
    """``foreachBatch`` function that commits each batch as a whole to the Parquet sink, and from there to the
    CSV sink, so both hold the same rows."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = clustered_for_write(batch, ("subject", "date"))
        written = replace_batch(rows, f"{out}/parquet", batch_id, partition_by=("subject", "date"))
        back = batch.sparkSession.read.schema(batch.schema).parquet(written)
        replace_batch(back.select("title", "text", "subject", "date"), f"{out}/csv", batch_id, "csv",
                      options=CSV_WRITE_OPTIONS)

    return write_batch


def write_batch_of_messages(out: str, dead_letter: str):
    """``foreachBatch`` function that reads and parses a batch of messages once, and commits its cleaned rows to the
    Parquet and the CSV sink and its malformed ones to the dead letter."""
    write_rows = write_both(out)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            parsed = materialize(batch, "ingest-batch")
            write_rows(ingest_frame(parsed), batch_id)
            bad = parsed.filter(F.col(BAD_COLUMN)).select("raw_value", F.current_timestamp().alias("received_at"))
            replace_batch(bad, dead_letter, batch_id, "json")

    return write_batch


def start_ingest_once(stream: DataFrame, out: str, checkpoint: str, trigger=C.INGEST_PARQUET_TRIGGER,
                      dead_letter: str | None = None, available_now: bool = False):
    """ST1 as one query: each message is read and parsed once for all three sinks, which share one trigger
    (``start_ingest`` runs a query, and a read of the source, for each)."""
    parsed = observed_rows(parsed_stream(stream))
    writer = write_batch_of_messages(out, dead_letter or f"{out}/dead_letter")
    return [start(parsed.writeStream.foreachBatch(writer), f"{checkpoint}/ingest", trigger, available_now)]


def start_ingest(stream: DataFrame, out: str, checkpoint: str, parquet_trigger=C.INGEST_PARQUET_TRIGGER,
                 csv_trigger=C.INGEST_CSV_TRIGGER, dead_letter: str | None = None,
                 available_now: bool = False, dedupe: bool | str | None = False, delay: str = C.DEDUPE_DELAY):
    """Starts the ingest queries; malformed messages always go to a dead letter (``out``/dead_letter unless named).

    Without ``dedupe``: the Parquet, the CSV and the dead-letter query, in that
    order.  With it (``first`` or ``final``, see ``streaming.dedupe``; True is ``first``): one
    query that feeds both sinks (D2), and the dead letter.
    """
    parsed = parsed_stream(stream)
    rows = observed_rows(ingest_frame(parsed, with_event_time=bool(dedupe)))
    if dedupe:
        copies = final_copies(rows, delay) if dedupe == "final" else first_copies(rows, delay)
        with small_batches(stream.sparkSession):
            queries = [start(copies.writeStream.outputMode("append").foreachBatch(write_both(out)), f"{checkpoint}/deduped",
                             parquet_trigger, available_now)]
    else:
        pq = start(clustered_for_write(rows, ("subject", "date")).writeStream.format("parquet")
                   .partitionBy("subject", "date").outputMode("append").option("path", f"{out}/parquet"),
                   f"{checkpoint}/parquet", parquet_trigger, available_now)
        csv = start(rows.select("title", "text", "subject", "date").writeStream.format("csv")
                    .options(**CSV_WRITE_OPTIONS).outputMode("append").option("path", f"{out}/csv"),
                    f"{checkpoint}/csv", csv_trigger, available_now)
        queries = [pq, csv]
    bad = start_dead_letter(parsed, dead_letter or f"{out}/dead_letter", checkpoint, parquet_trigger, available_now)
    return queries + [bad]


def start_console(stream: DataFrame, checkpoint: str, sink: str = "console", path: str | None = None,
                  available_now: bool = False):
    """ST3: parsed messages to the console (``truncate=false``), or to files for a look at larger streams."""
    w = parse_messages(stream).writeStream.format(sink).outputMode("append")
    w = w.option("truncate", "false") if sink == "console" else w.option("path", path)
    return start(w, checkpoint, None, available_now)
