"""One copy of each title, with keyed state in Spark's state store.

Copies of a title are one article while each is no further than ``delay`` from the
next one in event time (a session of copies), in one batch or in several, whichever
arrives first.  Untitled rows (NULL or blank) are no copies of each other and all stay.

``first_copies`` passes on a session's first copy at once: of the copies of a micro-batch
the earliest.  Batch borders don't change what it gives for rows that arrive in order of
event time; a copy that arrives after a later one of its session is dropped in its
favour, and one that would join two sessions that were both passed on can't take one back.

``final_copies`` passes on each session's earliest copy when the watermark has
passed its end, so its result is the same for any batch borders and any order of arrival
within the watermark.  Rows come ``delay`` (twice, with the watermark) late, and rows behind
the watermark are dropped and counted by the query's progress (``numRowsDroppedByWatermark``).

Both combine the copies of a hot title in each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import config as C
from ..functions.text import unicode_strip

# One entry for each session passed on, in microseconds; a title's state goes after ``goes``, in milliseconds.
STATE = "titles array<string>, starts array<long>, ends array<long>, goes array<long>"
BUCKETS = 16384           # of titles, one group of rows and state each (fixed for a checkpoint)
ORDER = ["at", "article_id", "tie"]
BATCH_ROWS = 1000         # rows (with their texts) that a Python worker of the stream holds at once
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Streams started inside hand at most so many rows at once to a Python worker (a stream keeps the
    settings of its start); a smaller setting of the session holds."""
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) < rows:
        spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def micros(interval: str) -> int:
    """Microseconds of an interval of fixed length, such as ``90 minutes``."""
    number, unit = interval.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1_000_000


def titled() -> Column:
    return unicode_strip(F.coalesce("title", F.lit(""))) != ""


def _combined(gap: int):
    """The earliest row of each session of copies within an Arrow batch, with the session's end as ``until``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rows = rows.sort_values(["key", *ORDER], na_position="first", ignore_index=True)
            new = (rows["key"] != rows["key"].shift()) | (rows["at"] - rows["at"].shift() > gap) | rows["key"].str.startswith("u")
            until = rows.groupby(new.cumsum())["at"].transform("max")
            yield rows.assign(until=until)[new]
    return run


def _decide(gap: int, keep: int, columns: list[str]):
    """The rows of one title that are passed on.  State is kept by the time of arrival, so no row is late for it."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if key[0].startswith("u"):
            for rows in batches:
                yield rows[columns]
            return
        parts = list(batches)
        rows = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        if len(rows) > 1:           # most titles have one row, and then nothing to sort
            rows = rows.sort_values(ORDER, na_position="first", ignore_index=True)
        sessions = [list(s) for s in zip(*state.get)] if state.exists else []
        passed = []
        for i, at, until in zip(rows.index, rows["at"], rows["until"]):
            near = [s for s in sessions if s[0] - gap <= until and at <= s[1] + gap]
            if not near:
                passed.append(i)
            near.append([at, until])
            sessions = [s for s in sessions if s not in near] + [[min(s[0] for s in near), max(s[1] for s in near)]]
        newest = max(s[1] for s in sessions)
        sessions = sorted(s for s in sessions if s[1] >= newest - max(keep, gap))
        state.update(([s[0] for s in sessions], [s[1] for s in sessions]))
        state.setTimeoutTimestamp(int(rows["arrived"].max()) + keep // 1000)
        if passed:
            yield rows.loc[passed, columns]
    return run


class _Title:
    """The state of one title out of its bucket's."""

    hasTimedOut = False

    def __init__(self, sessions: tuple[list[int], list[int]] | None):
        self.exists, self.get, self.goes = sessions is not None, sessions, 0

    def update(self, value: tuple) -> None:
        self.exists, self.get = True, value

    def setTimeoutTimestamp(self, at: int) -> None:
        self.goes = at


def _decide_bucket(gap: int, keep: int, columns: list[str]):
    """``_decide`` for the titles of a bucket, so that the fixed cost of a group is not paid for each title."""
    decide = _decide(gap, keep, ["row"])

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[list[int], list[int]]] = {}
        goes: dict[str, int] = {}
        for title, start, end, at in zip(*state.get) if state.exists else ():
            for list_, value in zip(known.setdefault(title, ([], [])), (start, end)):
                list_.append(value)
            goes[title] = at
        seen: set[str] = set()
        out = None
        if not state.hasTimedOut:
            rows = pd.concat(list(batches), ignore_index=True)
            rows["row"] = range(len(rows))
            untitled = rows["key"].str.startswith("u")
            passed = rows.loc[untitled, "row"].tolist()
            titled_ = rows.loc[~untitled, ["key", *ORDER, "until", "arrived", "row"]]
            alone = ~titled_["key"].duplicated(keep=False) & ~titled_["key"].isin(known)
            first = titled_[alone]
            for title, at, until, arrived in zip(*(first[c].tolist() for c in ("key", "at", "until", "arrived"))):
                known[title], goes[title] = ([at], [until]), arrived + keep // 1000
            passed += first["row"].tolist()
            for title, copies in titled_[~alone].groupby("key", sort=False):
                one = _Title(known.get(title))
                passed += [i for df in decide((title,), iter([copies]), one) for i in df["row"].tolist()]
                known[title], goes[title] = one.get, one.goes
            seen.update(titled_["key"])
            out = rows.loc[passed, columns] if passed else None
        now = state.getCurrentWatermarkMs()
        for title in [t for t, at in goes.items() if at < now and t not in seen]:
            del known[title], goes[title]
        if known:
            flat = [(t, int(s), int(e), int(goes[t])) for t, (starts, ends) in known.items() for s, e in zip(starts, ends)]
            state.update(tuple(list(c) for c in zip(*flat)))
            state.setTimeoutTimestamp(min(goes.values()))
        elif state.exists:
            state.remove()
        if out is not None:
            yield out
    return run


def first_copies(rows: DataFrame, delay: str = C.DEDUPE_DELAY, keep: str = C.DEDUPE_KEEP) -> DataFrame:
    """The first copy of each session of a title to arrive; the state of a title goes ``keep`` after its last copy
    arrived, and within it sessions that ended ``keep`` before the newest."""
    gap, columns = micros(delay), [c for c in rows.columns if c != "event_time"]
    flat = rows.select(*columns, F.unix_micros("event_time").alias("at"), F.unix_millis("processed_at").alias("arrived"),
                       F.xxhash64("text", "subject", "date").alias("tie")).withColumn(
        "key", F.when(titled(), F.concat(F.lit("t"), "title")).otherwise(
            F.concat(F.lit("u"), F.hex(F.xxhash64("article_id", "tie"))))).withColumn(
        "bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)))
    wide = T.StructType(flat.schema.fields + [T.StructField("until", T.LongType())])
    out = T.StructType([flat.schema[c] for c in columns])
    return flat.mapInPandas(_combined(gap), wide).withWatermark("processed_at", "0 seconds").groupBy(
        "bucket").applyInPandasWithState(_decide_bucket(gap, micros(keep), columns), out, STATE, "append",
                                         GroupStateTimeout.EventTimeTimeout)


def final_copies(rows: DataFrame, delay: str = C.DEDUPE_DELAY) -> DataFrame:
    """The earliest copy of each session of a title, once the watermark (``delay`` behind the newest row) is past it."""
    columns = [c for c in rows.columns if c != "event_time"]
    content = F.xxhash64("text", "subject", "date")
    order = F.struct("event_time", F.coalesce("article_id", F.lit("")), content)
    # untitled rows with one id and content are counted and come out as often
    key = F.when(titled(), F.concat(F.lit("t"), "title")).otherwise(
        F.concat(F.lit("u"), F.hex(F.xxhash64("article_id", content)), F.hex(F.unix_micros("event_time"))))
    # a session of one row ends a microsecond after the delay, so that copies exactly so far apart meet
    gap = f"{micros(delay) + 1} microseconds"
    sessions = rows.withWatermark("event_time", delay).groupBy(F.session_window("event_time", gap), key.alias("key")).agg(
        F.min_by(F.struct(*columns), order).alias("row"), F.count(F.lit(1)).alias("n"))
    copies = F.when(F.col("key").startswith("u"), F.array_repeat("row", F.col("n").cast("int"))).otherwise(F.array("row"))
    return sessions.select(F.explode(copies).alias("row")).select("row.*")
