"""S1 in parallel: CSV with quoted line breaks, each file read by as many tasks as it has splits.

A line break ends a record only outside quotes, which a task that starts inside a file
can't know.  So the lines of a file are read twice, each time split by split:

1. For each split: whether it ends inside quotes if it starts outside, and if it starts
   inside; the text before its first record and the open record at its end, for both.
   A prefix scan over the splits of a file (one row each) gives the true states, and
   records that cross splits are put together from their parts.
2. Each task, told the true state of its splits, cuts the records that lie within one.

Records are parsed by ``from_csv``.  A quote opens a field only at its start and closes it
before a delimiter or a line end; doubled quotes stand for one.  Texts are UTF-8; the line
break is ``\\n`` or ``\\r\\n``; empty lines outside quotes are skipped, as by Spark's reader.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART_CHARS = 1 << 20      # text of a record in one split that the first reading keeps
CLOSE = re.compile(r'[^"]*(?:""[^"]*)*"(?=,|\r?$)')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the text is inside quotes after ``line``, if it was (or not) before."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside:
            closed = CLOSE.match(line, at)
            if not closed:
                return True
            inside, at = False, closed.end()
            if line[at:at + 1] != ",":
                return False
            at += 1
        elif line[at:at + 1] == '"':
            inside, at = True, at + 1
        else:
            at = line.find(",", at) + 1
            if not at:
                return False


class Cut:
    """Cuts the lines of one split into records, from a given state on.  With a ``limit``, text that is longer
    (a wrong guess of the state may never end) is not kept, and read again if it turns out to be needed."""

    def __init__(self, inside: bool, limit: int | None = None):
        self.inside, self.limit = inside, limit
        self.waits = inside                   # for the end of the record that began before the split
        self.lead: str | None = None          # that record's text in this split
        self.open: list[str] = []
        self.size = self.ended = 0

    def text(self) -> str | None:
        return None if self.limit is not None and self.size > self.limit else "\n".join(self.open)

    def add(self, line: str) -> str | None:
        """The record that ends with this line, if one that began in the split does."""
        self.inside = ends_inside(line, self.inside)
        self.size += len(line) + 1
        self.open.append(line)
        if self.limit is not None and self.size > self.limit:
            self.open.clear()
        if self.inside:
            return None
        record, self.open, self.size = self.text(), [], 0
        if self.waits:
            self.waits, self.lead = False, record
            return None
        self.ended += 1
        return record

    def parts(self) -> tuple[str | None, str | None]:
        """Text of the record that began before the split, and of the one that is open at its end."""
        return (self.text(), None) if self.waits else (self.lead, self.text() if self.inside else None)


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, bool], Iterator[str]]]:
    """(file, start, true state) and lines, one at a time, of each split of a task."""
    def rows():
        for b in batches:
            keys = list(zip(b.column("file").to_pylist(), b.column("start").to_pylist(), b.column("inside").to_pylist()))
            yield from zip(keys, b.column("value").to_pylist())

    def lines(first):
        nonlocal ahead
        key, line = first
        yield line
        for k, line in it:
            if k != key:
                ahead = k, line
                return
            yield line
        ahead = None

    it = rows()
    ahead = next(it, None)
    while ahead is not None:
        first = ahead
        yield first[0], lines(first)


STATES = "file long, start long, out0 boolean, out1 boolean, waits1 boolean, lead string, open0 string, open1 string, first0 boolean"
PARTS = "file long, start long, lead string, open string"
ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}


def _row(schema: str, *values) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], ARROW[t]) for v, (_, t) in zip(values, fields)], names=[n for n, _ in fields])


def _states(limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start, _), lines in _splits(batches):
            out, ins = Cut(False, limit), Cut(True, limit)
            for line in lines:
                out.add(line)
                ins.add(line)
            yield _row(STATES, file, start, out.inside, ins.inside, ins.waits, ins.parts()[0], out.parts()[1], ins.parts()[1],
                       not out.ended)
    return run


def _long_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, start, inside), lines in _splits(batches):
        cut = Cut(inside)
        for line in lines:
            cut.add(line)
        yield _row(PARTS, file, start, *cut.parts())


def _records(header: bool, at_once: int = 1024) -> Callable:
    def batch(found: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["record"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[str] = []
        for (_, start, inside), lines in _splits(batches):
            cut, skip = Cut(inside), header and start == 0
            for line in lines:
                record = cut.add(line)
                if record is None or record in ("", "\r"):
                    continue
                if not skip:
                    found.append(record)
                skip = False
                if len(found) >= at_once:
                    yield batch(found)
                    found = []
        if found:
            yield batch(found)
    return run


def _true_states(states: DataFrame) -> DataFrame:
    """The rows of ``states`` with ``inside``, the true state at the start of the split."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start")
    # from the last split whose end doesn't depend on its start, each split that flips the state
    fixed, flips = F.col("out0") == F.col("out1"), (F.col("out0") & ~F.col("out1")).cast("int")
    s = states.withColumn("flipped", F.sum(flips).over(upto))
    odd = (F.coalesce(F.sum(flips).over(before), F.lit(0))
           - F.coalesce(F.last(F.when(fixed, F.col("flipped")), True).over(before), F.lit(0))) % 2 == 1
    known = F.coalesce(F.last(F.when(fixed, F.col("out0")), True).over(before), F.lit(False))
    inside = F.col("inside")
    return s.withColumn("inside", known != odd).select(
        "file", "start", "inside", F.when(inside, F.col("lead")).alias("lead"),
        F.when(inside, F.col("open1")).otherwise(F.col("open0")).alias("open"),
        F.when(inside, F.col("out1") & ~F.col("waits1")).otherwise(F.col("out0")).alias("opens"),
        (~inside & (F.col("start") == 0) & F.col("first0")).alias("is_first"))


def _crossing(parts: DataFrame, header: bool) -> DataFrame:
    """The records that cross splits: an open record goes on in the leads up to the split in which it ends."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("opens"), F.col("start")), True).over(before)
    pieces = parts.filter("opens").select(
        "file", F.col("start").alias("owner"), "start", F.col("open").alias("text"), "is_first").unionByName(
        parts.withColumn("owner", owner).filter("inside").select(
            "file", "owner", "start", F.col("lead").alias("text"), F.lit(False).alias("is_first")))
    whole = pieces.groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("start", "text"))).alias("p"), F.max("is_first").alias("is_first"))
    if header:
        whole = whole.filter("not is_first")
    return whole.select(F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("record"))


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType, options: dict, header: bool = True) -> DataFrame:
    """Rows of one or more CSV files, parsed with ``schema`` by position and ``options`` of the CSV reader."""
    from ..session import materialize
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    parts = materialize(_true_states(materialize(
        lines.withColumn("inside", F.lit(False)).mapInArrow(_states(PART_CHARS), STATES), "csv-states")), "csv-parts")

    def told(which: DataFrame, how: str) -> DataFrame:
        # one row of 17 bytes per split of the files
        return lines.join(F.broadcast(which.select("file", "start", "inside")), ["file", "start"], how).select(
            "value", "file", "start", F.coalesce("inside", F.lit(False)).alias("inside"))

    cut_off = parts.filter("(inside and lead is null) or (opens and open is null)")
    if not cut_off.isEmpty():
        more = told(cut_off, "inner").mapInArrow(_long_parts, PARTS).withColumnsRenamed({"lead": "lead2", "open": "open2"})
        parts = materialize(parts.join(more, ["file", "start"], "left").withColumns(
            {"lead": F.coalesce("lead", "lead2"), "open": F.coalesce("open", "open2")}).drop("lead2", "open2"), "csv-parts")
    records = told(parts.filter("inside"), "left").mapInArrow(_records(header), "record string").unionByName(
        _crossing(parts, header))
    # a line break of two characters leaves its first one at the end of a record
    clean = F.regexp_replace("record", r"\r$", "")
    parsed = records.filter("record not in ('', '\\r')").select(
        F.from_csv(clean, schema.simpleString()[7:-1].replace(":", " "), {**options, "multiLine": "true"}).alias("row"))
    return parsed.select("row.*")
