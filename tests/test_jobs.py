"""User-level jobs: train/save/load, export, backfill, compaction, streams."""

import os

from pyspark.sql import functions as F

from newsflow.checks import fixtures
from newsflow.plans import jobs
from newsflow.session import scratch_path
from newsflow.sinks import files as sinks
from newsflow.sources.files import load_model, read_predictions
from newsflow.sources.tables import articles
from newsflow.streaming import ingest, scoring
from newsflow.streaming.control import await_all
from newsflow.streaming.sources import article_stream

SF = "/root/testdata/sf0.001"


def test_train_save_and_fallback_load(spark):
    fake, true = fixtures.training_csvs(spark, SF)
    primary, backup = scratch_path(spark, "model_a"), scratch_path(spark, "model_b")
    res = jobs.train(spark, fake, true, model_paths=[primary, backup])
    assert 0.0 <= res.metrics["accuracy"] <= 1.0 and res.metrics["n"] > 0
    assert 0.0 <= res.metrics["auc_margin"] <= 1.0
    missing = scratch_path(spark, "no_model")
    model = load_model([missing, backup])                 # first path fails, backup loads
    arts = articles(spark, SF, labelled=False)
    a = jobs.score_batch(res.model, arts).select("title", "prediction_label", "prob_true")
    b = jobs.score_batch(model, arts).select("title", "prediction_label", "prob_true")
    assert a.exceptAll(b).count() == 0


def test_export_writes_four_files(spark):
    path = fixtures.prediction_dataset(spark, SF)
    out = scratch_path(spark, "export")
    spread = jobs.export(spark, path, scratch_path(spark, "export"))
    assert all(os.path.isdir(v.replace("file:", "")) for v in spread.values())      # parallel by default
    res = jobs.export(spark, path, out, single_file=True)
    for k in ("predictions", "by_label", "by_subject", "by_date"):
        assert os.path.isfile(res[k].replace("file:", "")), k
    n = read_predictions(spark, path).count()
    for key, schema in (("by_label", "prediction_label string, count bigint"),
                        ("by_subject", "subject string, prediction_label string, count bigint"),
                        ("by_date", "date string, prediction_label string, count bigint")):
        back = spark.read.options(**sinks.CSV_OPTIONS).schema(schema).csv(res[key])
        assert back.agg(F.sum("count")).first()[0] == n, key
    from newsflow.operators.aggregates import export_summaries
    p = export_summaries(read_predictions(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan") == 1                      # three summaries, one scan


def test_backfill_and_compaction(spark):
    src = fixtures.article_csv(spark, SF)
    out = scratch_path(spark, "backfill")
    n = jobs.backfill(spark, src, out)
    dst = scratch_path(spark, "compacted")
    sinks.compact(spark, f"{out}/parquet", dst, partition_by=("subject",))
    assert spark.read.parquet(dst).count() == n


def test_scoring_stream_metrics_and_dead_letter(spark):
    from newsflow.checks.queries import _ml_model
    model = _ml_model(spark, SF)
    src = fixtures.landed_messages(spark, SF, malformed=True)
    out, ckpt, dead = (scratch_path(spark, n) for n in ("scored", "scored_ckpt", "dead"))
    qs = scoring.start_scoring(model, article_stream(spark, "json", src), out, ckpt, dead_letter=dead,
                               available_now=True)
    for q in qs:
        q.awaitTermination()
    good = read_predictions(spark, out).count()
    bad = spark.read.json(dead).count()
    total = articles(spark, SF, labelled=False).count()
    assert good + bad == total and bad > 0
    observed = qs[0].lastProgress["observedMetrics"]["batch"]
    assert int(observed["rows"]) == good


def test_await_all_waits_for_every_query(spark):
    src = fixtures.landed_messages(spark, SF)
    out, ckpt = scratch_path(spark, "ingest"), scratch_path(spark, "ingest_ckpt")
    qs = ingest.start_ingest(article_stream(spark, "json", src), out, ckpt, available_now=True)
    assert await_all(spark, qs, timeout=120)
    assert all(not q.isActive and q.exception() is None for q in qs)
    # K1: no query reads its input twice
    assert len({q.lastProgress["numInputRows"] for q in qs}) == 1


def test_await_all_stops_the_others_when_one_fails(spark):
    import pytest
    src = fixtures.landed_messages(spark, SF)

    def fail(df, batch_id):
        raise ValueError("no")

    stream = article_stream(spark, "json", src)
    bad = stream.writeStream.foreachBatch(fail).option("checkpointLocation", scratch_path(spark, "bad")).start()
    good = stream.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "good")).trigger(
        processingTime="1 second").start()
    with pytest.raises(RuntimeError):
        await_all(spark, [good, bad], timeout=60)
    assert not good.isActive


def test_processing_time_trigger_runs(spark):
    """ST5: a query with an interval keeps running until it is stopped."""
    src = fixtures.landed_messages(spark, SF)
    out, ckpt = scratch_path(spark, "ingest"), scratch_path(spark, "ingest_ckpt")
    qs = ingest.start_ingest(article_stream(spark, "json", src), out, ckpt, parquet_trigger="1 second",
                             csv_trigger="1 second")
    assert not await_all(spark, qs, timeout=12)
    assert all(q.isActive for q in qs)
    for q in qs:
        q.stop()
    assert spark.read.parquet(f"{out}/parquet").count() > 0


def test_foreach_batch_skips_empty_batches_and_replays(spark):
    """ST4 + X6: an empty batch writes nothing; a replayed one replaces itself, metrics and dead letter too."""
    from newsflow.checks.queries import _ml_model
    from newsflow.functions.messages import parse_messages
    from newsflow.sinks.files import path_exists
    out = scratch_path(spark, "batches")
    write = scoring.batch_writer(_ml_model(spark, SF), out)
    msgs = spark.read.schema("key string, value string").json(fixtures.landed_messages(spark, SF, malformed=True))
    parsed = parse_messages(msgs, flag_bad=True)
    write(parsed.limit(0), 0)
    assert not path_exists(spark, out)
    for _ in range(2):
        write(parsed, 1)
    m = spark.read.parquet(f"{out}_metrics").collect()
    assert len(m) == 1 and m[0].good + m[0].bad == msgs.count()
    assert spark.read.parquet(out).count() == m[0].good and spark.read.parquet(f"{out}_dead_letter").count() == m[0].bad


def test_batch_metrics_listener_sees_good_and_bad(spark):
    """The listener collects the observed counts of both queries of the scoring job."""
    import time
    from newsflow.checks.queries import _ml_model
    from newsflow.streaming.control import BatchMetricsListener
    good, bad = BatchMetricsListener("batch"), BatchMetricsListener("dead_letter")
    for x in (good, bad):
        spark.streams.addListener(x)
    try:
        src = fixtures.landed_messages(spark, SF, malformed=True)
        out, ckpt = scratch_path(spark, "scored"), scratch_path(spark, "scored_ckpt")
        for q in scoring.start_scoring(_ml_model(spark, SF), article_stream(spark, "json", src), out, ckpt,
                                       available_now=True):
            q.awaitTermination()
        end = time.time() + 20
        while time.time() < end and not (good.batches and bad.batches):
            time.sleep(0.2)
    finally:
        for x in (good, bad):
            spark.streams.removeListener(x)
    rows = good.totals()["rows"]
    assert rows == read_predictions(spark, out).count()
    assert rows + bad.totals()["bad"] == articles(spark, SF, labelled=False).count()


def test_status_of_missing_and_empty_datasets(spark):
    """0 files, as a listing of a folder that is not there yet."""
    empty = scratch_path(spark, "empty")
    sinks.make_folder(spark, empty)
    st = {r.dataset: r for r in jobs.dataset_status(spark, {"m": scratch_path(spark, "none"), "e": empty}).collect()}
    assert all((r.files, r.bytes, r.children, r.latest) == (0, 0, 0, None) for r in st.values()) and len(st) == 2


def test_score_batch_counts_what_it_cannot_score(spark):
    from newsflow.checks.queries import _ml_model
    df = spark.createDataFrame([("a", "b c", "s", "d"), (None, "x", "s", "d"), ("y", None, "s", "d")],
                               "title string, text string, subject string, date string")
    dead = scratch_path(spark, "unscored")
    assert jobs.score_batch(_ml_model(spark, SF), df, dead).count() == 1
    assert spark.read.parquet(dead).count() == 2


def test_ingest_reads_each_message_once(spark):
    """ST1 in one query: as many input rows as messages; a restart adds nothing; the same rows as three queries."""
    from newsflow.sources.files import read_ingested
    src = fixtures.landed_messages(spark, SF, malformed=True)
    n = spark.read.schema("key string, value string").json(src).count()
    out, ckpt = scratch_path(spark, "once"), scratch_path(spark, "once_ckpt")
    (q,) = ingest.start_ingest_once(article_stream(spark, "json", src), out, ckpt, available_now=True)
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == n
    (q,) = ingest.start_ingest_once(article_stream(spark, "json", src), out, ckpt, available_now=True)
    q.awaitTermination()
    other = scratch_path(spark, "thrice")
    for q in ingest.start_ingest(article_stream(spark, "json", src), other, scratch_path(spark, "thrice_ckpt"), available_now=True):
        q.awaitTermination()
    for read in (lambda o: read_ingested(spark, f"{o}/parquet").select("title", "text", "article_id", "subject", "date"),
                 lambda o: spark.read.schema("raw_value string").json(f"{o}/dead_letter").select("raw_value")):
        a, b = read(out), read(other)
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_poll_totals_and_formats(spark):
    """ST5b: totals come from the polls' own table, so a new process (or a replay) counts the same."""
    from newsflow.sources.tables import feed_documents
    from newsflow.streaming.feeds import poll_writer, running_totals
    docs = feed_documents(spark, SF)
    out = scratch_path(spark, "polls")
    assert running_totals(spark, f"{out}_totals")["polls"] == 0
    write = poll_writer(out, "parquet")
    write(docs, 0)
    write(docs.limit(0), 1)
    write(docs, 2)
    n = spark.read.parquet(out).filter("batch_id = 0").count()
    totals = running_totals(spark, f"{out}_totals")
    assert totals["polls"] == 2 and totals["messages"] == 2 * n and 0 < totals["guessed_dates"] < totals["messages"]
    assert totals["documents"] == 2 * docs.count() and totals["broken"] == 2 * docs.filter("url like '%-broken.xml'").count()
    # a poll replayed later gives the same messages
    a, b = (spark.read.parquet(out).filter(f"batch_id = {i}").drop("batch_id") for i in (0, 2))
    assert a.exceptAll(b).count() == 0
    # after a restart: the same batch again, by a new writer, and another without documents
    again = poll_writer(out, "parquet")
    again(docs, 2)
    assert running_totals(spark, f"{out}_totals") == totals
    again(docs.limit(0), 2)
    assert running_totals(spark, f"{out}_totals")["polls"] == 1
    assert spark.read.parquet(out).filter("batch_id = 2").count() == 0


def test_poller_keeps_broken_documents(spark):
    """entries before the break become messages; the rest of the document is in the dead letter."""
    from newsflow.schema import FEED_DOCUMENT_SCHEMA
    from newsflow.streaming.feeds import poll_writer
    whole = "".join(f"<item><title>t{i}</title><description>{'word ' * 10}</description></item>" for i in range(3))
    rows = [("s", 0, "u0", f"<rss><channel>{whole}<item><title>cut", None), ("s", 1, "u1", None, None),
            ("s", 2, "u2", "<html/>", None), ("s", 3, "u3", "<rss><channel/></rss>", None)]
    out = scratch_path(spark, "broken_polls")
    poll_writer(out)(spark.createDataFrame(rows, FEED_DOCUMENT_SCHEMA), 5)
    assert sorted(r.key for r in spark.read.json(f"{out}/batch_id=5").collect()) == ["t0", "t1", "t2"]
    dead = {r.url: (r.error, r.recovered, r.rest) for r in spark.read.parquet(f"{out}_dead_letter").collect()}
    assert dead == {"u0": ("broken", 3, "<rss><channel><item><title>cut"), "u1": ("missing", 0, None),
                    "u2": ("no feed", 0, "<html/>")}


def test_a_replay_leaves_the_last_attempt_only(spark):
    """ST4: other labels, other partitions or no rows at all in the second attempt."""
    from newsflow.sinks.batches import STAGED, clear_batch, replace_batch
    from newsflow.sinks.files import path_exists
    out = scratch_path(spark, "replaced")
    first = spark.createDataFrame([(1, "FAKE"), (2, "TRUE")], "id int, label string")
    replace_batch(first, out, 3, partition_by=("label",))
    replace_batch(first, out, 4, partition_by=("label",))
    replace_batch(first.filter("id = 2").withColumn("label", F.lit("FAKE")), out, 3, partition_by=("label",))
    rows = spark.read.schema("id int, label string, batch_id int").parquet(out)
    assert sorted((r.batch_id, r.id, r.label) for r in rows.collect()) == [(3, 2, "FAKE"), (4, 1, "FAKE"), (4, 2, "TRUE")]
    replace_batch(first.limit(0), out, 4, partition_by=("label",))
    assert spark.read.schema(rows.schema).parquet(out).count() == 1
    # what a crashed attempt left staged is not read, and goes with the next one
    first.write.parquet(f"{out}/{STAGED}/3-crashed")
    assert spark.read.schema(rows.schema).parquet(out).count() == 1
    clear_batch(spark, out, 3)
    assert not path_exists(spark, f"{out}/{STAGED}/3-crashed") and not path_exists(spark, f"{out}/batch_id=3")


def test_scored_batch_replayed_with_another_model(spark):
    """ST4: the replay's labels replace the first attempt's, also where a label has no rows any more."""
    from newsflow.checks.queries import _ml_model
    from newsflow.functions.messages import parse_messages
    from newsflow.operators import classifier
    from newsflow.plans.relational import prepared_articles
    out = scratch_path(spark, "remodelled")
    msgs = spark.read.schema("key string, value string").json(fixtures.landed_messages(spark, SF))
    parsed = parse_messages(msgs, flag_bad=True)
    scoring.batch_writer(_ml_model(spark, SF), out)(parsed, 0)
    prep = prepared_articles(spark, SF, 4).filter("label is not null")
    other = classifier.fit(prep.withColumn("label", 1.0 - F.col("label")))
    scoring.batch_writer(other, out)(parsed, 0)
    got, want = (df.groupBy("prediction_label").count().collect() for df in (
        spark.read.parquet(out), scoring.predictions(other, scoring.scorable(parsed))))
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert spark.read.parquet(out).count() == msgs.count()
    scoring.batch_writer(other, out)(parsed.limit(0), 0)
    assert spark.read.schema("title string, batch_id int").parquet(f"{out}_metrics").count() == 0


def _dedupe_runs(spark, mode, batches):
    import json as _json
    src, out, ckpt = (scratch_path(spark, n) for n in ("borders_src", "borders_out", "borders_ckpt"))
    for k, rows in enumerate(batches):
        vals = [(None, _json.dumps({"title": t, "text": "word " * 40 + i, "subject": "s", "date": "d", "article_id": i,
                                    "timestamp": f"2024-03-01T{at}:00"})) for t, i, at in rows]
        spark.createDataFrame(vals, "key string, value string").write.json(f"{src}/{k}")
        for q in ingest.start_ingest(article_stream(spark, "json", src + "/*"), out, ckpt, available_now=True, dedupe=mode):
            q.awaitTermination()
    schema = "title string, article_id string, subject string, date string"
    return sorted(r.article_id for r in spark.read.schema(schema).parquet(f"{out}/parquet").collect())


def test_stream_dedupe_is_the_same_for_all_batch_borders(spark):
    """Copies five hours apart are two articles in one batch, in two and in reverse; near ones are one."""
    early = [("A", "a0", "01:00"), ("A", "a1", "01:30"), ("A", "a2", "02:20"), (None, "n", "01:00"), (None, "n", "01:00"),
             (" ", "b", "01:00"), (" ", "b2", "01:00")]
    late = [("A", "a3", "07:00"), ("B", "b0", "07:10"), (None, "n2", "07:00")]
    want = ["a0", "a3", "b", "b0", "b2", "n", "n", "n2"]
    for batches in ([early + late], [early, late], [late, early], [early[:1] + late, early[1:]]):
        assert _dedupe_runs(spark, "first", batches) == want


def test_final_copies_don_t_depend_on_order_within_the_watermark(spark):
    """D2, final: the earliest copy of each session comes out once the watermark has passed it."""
    a = [("A", "a1", "05:30"), ("B", "b0", "05:40"), (None, "n", "05:40")]
    b = [("A", "a0", "05:10"), ("A", "a2", "06:20"), ("B", "b1", "05:20")]
    beat = [("beat", "beat", "23:00")]
    for batches in ([a + b + beat], [a, b, beat], [b, a, beat]):
        assert _dedupe_runs(spark, "final", batches) == ["a0", "b1", "n"]


def test_hot_title_is_combined_before_the_state():
    """A task passes on one row per session of a title's copies, whatever their number."""
    import pandas as pd
    from newsflow.streaming.dedupe import _combined
    rows = pd.DataFrame({"key": ["tA"] * 1000 + ["u1"] * 3, "at": [i * 10 for i in range(1000)] + [5] * 3,
                         "article_id": [str(i) for i in range(1003)], "tie": 0})
    (got,) = _combined(60)(iter([rows.sample(frac=1, random_state=1)]))
    assert got[["key", "at", "until"]].values.tolist() == [["tA", 0, 9990]] + [["u1", 5, 5]] * 3


def test_state_of_old_titles_goes():
    """Sessions that ended long before the newest leave the state; a timed-out title leaves it whole."""
    import pandas as pd
    from newsflow.streaming.dedupe import _decide

    class State:
        exists, hasTimedOut, get, timeout = False, False, None, None

        def update(self, value):
            self.exists, self.get = True, value

        def setTimeoutTimestamp(self, at):
            self.timeout = at

        def remove(self):
            self.exists = False

    state, decide = State(), _decide(60, 1000, ["article_id"])

    def send(*at):
        rows = pd.DataFrame({"at": at, "until": at, "article_id": [str(x) for x in at], "tie": 0, "arrived": 7})
        return [i for df in decide(("tA",), iter([rows]), state) for i in df["article_id"]]

    assert send(0, 50, 200) == ["0", "200"] and state.get == ([0, 200], [50, 200]) and state.timeout == 8
    assert send(100) == [] and send(1150) == ["1150"] and state.get == ([200, 1150], [200, 1150]) or state.get
    assert send(5000) == ["5000"] and state.get == ([5000], [5000])
    state.hasTimedOut = True
    assert send(1) == [] and not state.exists


def test_untitled_rows_and_equal_sinks_of_a_deduped_stream(spark):
    """Untitled articles are no copies of each other; both sinks hold the same rows; the earliest copy wins."""
    import json as _json
    from newsflow.sources.files import read_article_csv, read_ingested
    src, out, ckpt = (scratch_path(spark, n) for n in ("d2_src", "d2_out", "d2_ckpt"))
    body = "word " * 40
    rows = [(None, f"n{i}", "2024-03-01T10:00:00") for i in range(5)] + [
        ("A", "late", "2024-03-01T10:20:00"), ("A", "early", "2024-03-01T10:00:00"), ("A", "b", "2024-03-01T10:00:00")]
    vals = [(None, _json.dumps({"title": t, "text": body + i, "subject": "s", "date": "d", "article_id": i,
                                "timestamp": ts})) for t, i, ts in rows]
    spark.createDataFrame(vals, "key string, value string").write.json(src)
    for q in ingest.start_ingest(article_stream(spark, "json", src), out, ckpt, available_now=True, dedupe=True):
        q.awaitTermination()
    got = read_ingested(spark, f"{out}/parquet")
    assert sorted(r.article_id for r in got.collect()) == ["b"] + [f"n{i}" for i in range(5)]
    csv = read_article_csv(spark, f"{out}/csv").select("title", "text")
    assert csv.exceptAll(got.select("title", "text")).count() == 0 and csv.count() == got.count()


def test_stream_dedupe_across_batches(spark):
    """A title seen in an earlier micro-batch is dropped in a later one."""
    from newsflow.functions.messages import to_message
    from newsflow.sources.files import read_ingested
    arts = articles(spark, SF, labelled=False)
    src = scratch_path(spark, "dedupe_src")
    out, ckpt = scratch_path(spark, "dedupe_out"), scratch_path(spark, "dedupe_ckpt")
    fields = ["title", "text", "subject", "date", "article_id"]
    to_message(arts, fields).write.json(f"{src}/batch1")
    for q in ingest.start_ingest(article_stream(spark, "json", src + "/*"), out, ckpt, available_now=True,
                                 dedupe=True):
        q.awaitTermination()
    first = read_ingested(spark, f"{out}/parquet").count()
    # Same titles again, new ids: all are duplicates of batch 1.
    again = arts.withColumn("article_id", F.concat(F.col("article_id"), F.lit("-again")))
    to_message(again, fields).write.json(f"{src}/batch2")
    for q in ingest.start_ingest(article_stream(spark, "json", src + "/*"), out, ckpt, available_now=True,
                                 dedupe=True):
        q.awaitTermination()
    assert read_ingested(spark, f"{out}/parquet").count() == first


def test_dataset_status_counts_files_and_children(spark):
    from pyspark.sql import Row
    base = scratch_path(spark, "status")
    df = spark.createDataFrame([Row(subject=s, v=i) for i, s in enumerate(["a", "a", "b", "c"])])
    df.repartition(2).write.partitionBy("subject").parquet(f"{base}/parted")
    df.coalesce(1).write.parquet(f"{base}/flat")
    st = {r["dataset"]: r for r in jobs.dataset_status(spark, {"parted": f"{base}/parted",
                                                                "flat": f"{base}/flat"}).collect()}
    assert st["parted"]["children"] == 3 and st["parted"]["files"] >= 3
    assert st["flat"]["children"] == st["flat"]["files"] == 1
    assert st["flat"]["bytes"] > 0


def test_area_under_roc_choices(spark):
    fake, true = fixtures.training_csvs(spark, SF)
    res = jobs.train(spark, fake, true)
    for k in ("auc_margin", "auc_raw", "auc_probability"):
        assert 0.0 <= res.metrics[k] <= 1.0


def test_command_line_jobs(spark, capsys):
    import json as _json
    from newsflow.__main__ import main
    fake, true = fixtures.training_csvs(spark, SF)
    model = scratch_path(spark, "cli_model")
    assert main(["train", "--fake", fake, "--true", true, "--model", model], spark=spark) == 0
    metrics = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert 0.0 <= metrics["accuracy"] <= 1.0
    src = fixtures.landed_messages(spark, SF)
    out, ckpt = scratch_path(spark, "cli_scored"), scratch_path(spark, "cli_ckpt")
    assert main(["score-stream", "--input", src, "--checkpoint", ckpt, "--out", out, "--model", model,
                 "--available-now"], spark=spark) == 0
    exp = scratch_path(spark, "cli_export")
    assert main(["export", "--input", out, "--out", exp], spark=spark) == 0
    batch = scratch_path(spark, "cli_batch")
    assert main(["score-batch", "--input", fixtures.article_csv(spark, SF), "--model", model, "--out", batch],
                spark=spark) == 0
    assert read_predictions(spark, batch).count() > 0
    capsys.readouterr()
    assert main(["latest", batch, "-n", "1", "--by", "modificationTime"], spark=spark) == 0
    assert "prediction_label=" in capsys.readouterr().out
    assert read_predictions(spark, out).count() == articles(spark, SF, labelled=False).count()


def test_console_stream_runs(spark, capfd):
    src = fixtures.landed_messages(spark, SF)
    q = ingest.start_console(article_stream(spark, "json", src), scratch_path(spark, "console_ckpt"),
                             available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    assert q.lastProgress["numInputRows"] == articles(spark, SF, labelled=False).count()


def test_single_file_export_of_empty_result(spark):
    out = scratch_path(spark, "empty_export")
    df = spark.createDataFrame([], "subject string, prediction_label string, count bigint")
    target = sinks.export_summary(df, out, "summary.csv", single_file=True)
    assert os.path.isfile(target.replace("file:", ""))
    assert spark.read.options(**sinks.CSV_OPTIONS).schema("subject string, prediction_label string, count bigint") \
        .csv(target).count() == 0


def test_stream_dedupe_uses_producer_time_and_delay(spark):
    """D2 semantics: a copy within the delay is dropped; later it is new again."""
    import json as _json
    src = scratch_path(spark, "wm_src")
    out, ckpt = scratch_path(spark, "wm_out"), scratch_path(spark, "wm_ckpt")
    full = "word " * 40

    def land(batch, rows, body=full):
        vals = [(None, _json.dumps({"title": t, "text": body + t, "subject": "s", "date": "d", "article_id": i,
                                    "timestamp": ts})) for t, i, ts in rows]
        spark.createDataFrame(vals, "key string, value string").write.json(f"{src}/{batch}")
        for q in ingest.start_ingest(article_stream(spark, "json", src + "/*"), out, ckpt, available_now=True,
                                     dedupe=True):
            q.awaitTermination()
        schema = "title string, text string, subject string, date string, article_id string"
        return sorted(r["article_id"] for r in spark.read.schema(schema).parquet(f"{out}/parquet").collect())

    assert land("b0", [("Z", "0", "2024-03-01T09:00:00")], "short ") == []           # nothing accepted yet
    assert land("b1", [("A", "1", "2024-03-01T10:00:00")]) == ["1"]
    assert land("b2", [("A", "2", "2024-03-01T10:30:00"), ("B", "3", "2024-03-01T12:00:00")]) == ["1", "3"]
    assert land("b3", [("A", "4", "2024-03-01T12:30:00")]) == ["1", "3", "4"]


def test_command_line_other_jobs(spark, capsys):
    import json as _json
    from newsflow.__main__ import main
    from newsflow.sources.tables import feed_documents
    fake, true = fixtures.training_csvs(spark, SF)
    src = fixtures.article_csv(spark, SF)
    out = scratch_path(spark, "cli")
    assert main(["backfill", "--input", src, "--out", f"{out}/backfill"], spark=spark) == 0
    assert _json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows"] > 0
    assert main(["land-training", "--fake", fake, "--true", true, "--out", f"{out}/landed"], spark=spark) == 0
    assert main(["status", f"bf={out}/backfill/parquet", f"landed={out}/landed"], spark=spark) == 0
    lines = [_json.loads(x) for x in capsys.readouterr().out.strip().splitlines() if x.startswith("{")]
    assert {d["dataset"] for d in lines if "dataset" in d} == {"bf", "landed"}
    feeds_in = scratch_path(spark, "cli_feeds")
    feed_documents(spark, SF).write.parquet(feeds_in)
    assert main(["extract-feeds", "--input", feeds_in, "--out", f"{out}/msgs"], spark=spark) == 0
    assert spark.read.json(f"{out}/msgs").count() > 0
    msgs = fixtures.landed_messages(spark, SF)
    assert main(["ingest-stream", "--input", msgs, "--checkpoint", f"{out}/ck1", "--out", f"{out}/ing",
                 "--dedupe", "--available-now"], spark=spark) == 0
    capsys.readouterr()
    assert main(["feed-stream", "--input", feeds_in, "--checkpoint", f"{out}/ck2", "--out", f"{out}/fs",
                 "--available-now"], spark=spark) == 0
    totals = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert totals["messages"] == spark.read.json(f"{out}/msgs").count()
    # source options reach the source: one file a batch is one poll a file
    assert main(["feed-stream", "--input", feeds_in, "--checkpoint", f"{out}/ck4", "--out", f"{out}/fs2", "--sink",
                 "parquet", "--sink-option", "compression=none", "--max-files-per-trigger", "1", "--option",
                 "pathGlobFilter=*.parquet", "--available-now"], spark=spark) == 0
    polls = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])["polls"]
    assert polls == len([f for f in os.listdir(feeds_in.replace("file:", "")) if f.endswith(".parquet")]) > 0
    assert spark.read.parquet(f"{out}/fs2").count() > 0
    assert main(["console", "--input", msgs, "--checkpoint", f"{out}/ck3", "--available-now"], spark=spark) == 0
    assert spark.read.json(f"{out}/fs").count() == spark.read.json(f"{out}/msgs").count()


def test_scratch_scope_deletes_what_was_made_inside(spark):
    from newsflow.session import materialize, scratch_scope
    kept = materialize(spark.range(3), "kept")
    with scratch_scope(spark):
        inside = materialize(spark.range(5), "inside")
        path = inside.inputFiles()[0].replace("file://", "")
        assert inside.count() == 5 and os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path)) and kept.count() == 3


def test_processing_time_is_that_of_the_run(spark):
    """Prediction and ingest rows carry the time at which they were processed."""
    import datetime
    from newsflow.checks.queries import _ml_model
    from newsflow.sources.files import read_ingested
    src, out = fixtures.landed_messages(spark, SF), scratch_path(spark, "p7")
    before = datetime.datetime.now(datetime.timezone.utc)
    queries = scoring.start_scoring(_ml_model(spark, SF), article_stream(spark, "json", src), f"{out}/pred", f"{out}/c1",
                                    available_now=True)
    queries += ingest.start_ingest(article_stream(spark, "json", src), f"{out}/in", f"{out}/c2", available_now=True)
    assert await_all(spark, queries, timeout=120)
    after = datetime.datetime.now(datetime.timezone.utc)
    for df in (read_predictions(spark, f"{out}/pred"), read_ingested(spark, f"{out}/in/parquet")):
        # as text: the session is in UTC whatever the zone of Python
        low, high = df.select(F.date_format("processed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("p")).agg(
            F.min("p"), F.max("p")).first()
        assert before.strftime("%Y-%m-%dT%H:%M:%S") <= low <= high <= after.strftime("%Y-%m-%dT%H:%M:%S.999999")
