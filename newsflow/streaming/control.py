"""ST5 triggers, ST6 checkpoints, ST7 waiting, G6 per-batch metrics."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.messages import BAD_COLUMN


def start(writer, checkpoint: str, trigger: str | None, available_now: bool = False):
    """Starts a query with an explicit checkpoint (required: restarts resume).

    ``available_now`` drains what is there and stops (tests, backfills);
    otherwise ``trigger`` is a processing-time interval, or the default
    (as fast as possible) when None.
    """
    if not checkpoint:
        raise ValueError("every streaming query needs its own checkpointLocation")
    w = writer.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def await_all(spark, queries, timeout: float | None = None) -> bool:
    """ST7: wait until every query has ended; if one fails, stop the others and raise.

    Returns False if ``timeout`` seconds pass first (the queries keep running).
    """
    end = None if timeout is None else time.monotonic() + timeout
    while True:
        failed = [q for q in queries if q.exception() is not None]
        if failed:
            for q in queries:
                if q.isActive:
                    q.stop()
            raise RuntimeError(f"streaming query failed: {failed[0].exception()}")
        active = [q for q in queries if q.isActive]
        if not active:
            return True
        if end is not None and time.monotonic() >= end:
            return False
        active[0].awaitTermination(1)


def observed_batch(df: DataFrame, name: str = "batch", label: str = "prediction_label"):
    """Per-micro-batch counts computed while writing (no second pass)."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"),
                      F.sum(F.when(F.col(label) == "FAKE", 1).otherwise(0)).alias("fake"))


def observed_rows(df: DataFrame, name: str = "ingest"):
    """G6 of the ingest stream: rows per micro-batch."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def start_dead_letter(parsed: DataFrame, path: str, checkpoint: str, trigger: str | None, available_now: bool):
    """Malformed messages, raw, to JSON files; their count per micro-batch is observed as ``bad``."""
    bad = parsed.filter(F.col(BAD_COLUMN)).select("raw_value", F.current_timestamp().alias("received_at"))
    bad = bad.observe("dead_letter", F.count(F.lit(1)).alias("bad"))
    return start(bad.writeStream.format("json").outputMode("append").option("path", path),
                 f"{checkpoint}/dead_letter", trigger, available_now)


class BatchMetricsListener(StreamingQueryListener):
    """Collects the observed metrics of every finished micro-batch."""

    def __init__(self, name: str = "batch"):
        self.name = name
        self.batches = []

    def totals(self) -> dict:
        """Sums of the metrics over all batches seen so far."""
        out: dict = {}
        for _, metrics in self.batches:
            for k, v in metrics.items():
                out[k] = out.get(k, 0) + (v or 0)
        return out

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        m = event.progress.observedMetrics.get(self.name)
        if m is not None:
            self.batches.append((event.progress.batchId, m.asDict()))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
