"""Files read split by split give the rows of Spark's multi-line reader."""

import random

import pytest

from newsflow.schema import TRAINING_CSV_SCHEMA
from newsflow.session import scratch_path
from newsflow.sources import split_csv
from newsflow.sources.files import CSV_OPTIONS, read_article_csv


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def write(path: str, texts: list[str]) -> str:
    import os
    path = path.replace("file:", "")
    os.makedirs(path)
    for i, t in enumerate(texts):
        with open(f"{path}/{i}.csv", "w", newline="", encoding="utf-8") as f:
            f.write(t)
    return path


def field(r: random.Random) -> str:
    s = "".join(r.choice(["a", "b ", '"', ",", "\n", "\n\n", "é", "x" * 50, " ", "\t", '""']) for _ in range(r.randrange(20)))
    if r.random() < .04:
        s = "L\n" * 4000                                   # longer than several splits
    return '"' + s.replace('"', '""') + '"' if any(c in s for c in ',"\n') or r.random() < .3 else s


def table(seed: int, rows: int, nl: str, end: str = "") -> str:
    r = random.Random(seed)
    body = nl.join(",".join([f'5" pipe{i}' if i % 7 == 0 else str(i), field(r), field(r), field(r)]) for i in range(rows))
    return "title,text,subject,date" + nl + body + nl + end


def same(spark, path: str) -> int:
    want = spark.read.schema(TRAINING_CSV_SCHEMA).options(**CSV_OPTIONS).csv(path)
    got = read_article_csv(spark, path, split=True)
    assert got.schema == want.schema
    key = lambda r: tuple((x is not None, x or "") for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    return got.count()


@pytest.mark.parametrize("nl", ["\n", "\r\n"])
def test_rows_of_split_files(spark, small_splits, nl):
    texts = [table(1, 150, nl), table(2, 150, nl, nl + nl), table(3, 60, nl, 'last,"no end\nof line",s,d'), "",
             "title,text,subject,date", "title,text,subject,date" + nl + 'a,"b' + "\n" * 7000 + '",c,d']
    path = write(scratch_path(spark, "split_csv"), texts)
    assert same(spark, path) == 362
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 20


def test_parts_longer_than_the_first_reading_keeps(spark, small_splits, monkeypatch):
    monkeypatch.setattr(split_csv, "PART_CHARS", 40)
    assert same(spark, write(scratch_path(spark, "split_csv"), [table(5, 120, "\n")])) == 120


def test_a_header_over_several_splits(spark, small_splits):
    head = 'title,"text' + "\n" * 8000 + '",subject,date\n'
    assert same(spark, write(scratch_path(spark, "split_csv"), [head + "a,b,c,d\n"])) == 1


def test_large_files_are_split_by_default(spark, small_splits, monkeypatch):
    called = []
    monkeypatch.setattr("newsflow.sources.files.read_split_csv", lambda *a: called.append(a[1]))
    big, small = (write(scratch_path(spark, "split_csv"), [table(6, n, "\n")]) for n in (100, 2))
    read_article_csv(spark, big)
    assert read_article_csv(spark, small).count() == 2 and called == [big]


@pytest.mark.parametrize("line,inside,want", [
    ("a,b", False, False), ('a,"b', False, True), ('a,"b"', False, False), ('a"b,c', False, False), ('b",c', True, False),
    ('b"",c', True, True), ('b"",c",d', True, False), ('b","c', True, True), ('"",""', False, False), ('"', True, False),
    ('"', False, True), ('""', True, True), ('x",\r', True, False), ('x"\r', True, False), ("", True, True)])
def test_state_after_a_line(line, inside, want):
    assert split_csv.ends_inside(line, inside) is want
