"""Command line: ``python -m newsflow <job> [options]``.

Jobs: ``train``, ``score-batch``, ``score-stream``, ``ingest-stream``, ``console``,
``backfill``, ``export``, ``extract-feeds``, ``feed-stream``, ``land-training``,
``status``, ``latest``.  Streams take ``--format kafka`` (with ``--option kafka.bootstrap.servers=...``
and ``--option subscribe=...``) or ``--format json`` with ``--input`` (landed
message files), an explicit ``--checkpoint`` and ``--available-now`` for a
single pass.
"""

from __future__ import annotations

import argparse
import json
import sys

from . import config as C


def _options(pairs):
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def _stream(spark, args):
    from .streaming.sources import article_stream
    return article_stream(spark, args.format, args.input, _options(args.option), args.max_files_per_trigger)


def _finish(spark, queries, available_now: bool):
    from .streaming.control import await_all
    if available_now:
        for q in queries:
            q.awaitTermination()
    else:
        await_all(spark, queries)


def _sink_arguments(parser):
    parser.add_argument("--sink", default="json", choices=["json", "parquet", "kafka"], help="where messages go")
    parser.add_argument("--sink-option", action="append", help="sink option key=value (kafka: servers, topic)")


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="newsflow", description=__doc__.splitlines()[0])
    p.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    sub = p.add_subparsers(dest="job", required=True)

    t = sub.add_parser("train", help="labelled CSVs -> model (+ metrics as JSON)")
    t.add_argument("--fake", required=True)
    t.add_argument("--true", required=True)
    t.add_argument("--model", action="append", default=[], help="save location (repeat for backups)")

    for name, hlp in (("score-stream", "messages -> predictions partitioned by label"),
                      ("ingest-stream", "messages -> cleaned Parquet (subject, date) + CSV"),
                      ("console", "messages -> console"),
                      ("feed-stream", "landed feed documents -> messages, one poll per micro-batch")):
        s = sub.add_parser(name, help=hlp)
        s.add_argument("--format", default="parquet" if name == "feed-stream" else "json",
                       choices=["json", "kafka", "parquet"])
        s.add_argument("--input")
        s.add_argument("--option", action="append", help="source option key=value")
        s.add_argument("--max-files-per-trigger", type=int, default=None)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--available-now", action="store_true")
        if name != "console":
            s.add_argument("--out", required=name != "feed-stream")
        if name == "score-stream":
            s.add_argument("--model", action="append", required=True, help="model location(s), in fallback order")
            s.add_argument("--trigger", default=C.SCORE_TRIGGER)
        if name == "ingest-stream":
            s.add_argument("--dedupe", nargs="?", const="first", choices=["first", "final"],
                           help="one copy of a title: the first to arrive, or, later, the earliest")
            s.add_argument("--read-once", action="store_true", help="one query and trigger for all sinks (not with --dedupe)")
            s.add_argument("--delay", default=C.DEDUPE_DELAY, help="copies no further apart than this are one")
        if name == "feed-stream":
            s.add_argument("--trigger", default=C.FEED_POLL_TRIGGER)
            s.add_argument("--dead-letter", help="folder of broken documents (default: beside the output)")
            s.add_argument("--totals", help="folder of the polls' counts (default: beside the output)")
            _sink_arguments(s)
        elif name != "console":
            s.add_argument("--dead-letter", help="folder of malformed messages (default: beside the output)")

    b = sub.add_parser("backfill", help="article CSV -> cleaned Parquet by subject + CSV")
    b.add_argument("--input", required=True)
    b.add_argument("--out", required=True)

    e = sub.add_parser("export", help="prediction dataset -> predictions.csv + three summaries")
    e.add_argument("--input", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--single-file", action="store_true", help="one predictions.csv file (one task writes it)")

    f = sub.add_parser("extract-feeds", help="feed documents (Parquet) -> messages (JSON files)")
    f.add_argument("--input", required=True)
    f.add_argument("--out")
    _sink_arguments(f)

    sb = sub.add_parser("score-batch", help="article CSV -> predictions partitioned by label")
    sb.add_argument("--input", required=True)
    sb.add_argument("--model", action="append", required=True, help="model location(s), in fallback order")
    sb.add_argument("--out", required=True)
    sb.add_argument("--dead-letter", help="folder of articles without title or text (default: beside the output)")

    la = sub.add_parser("latest", help="last files of a dataset by name or time")
    la.add_argument("path")
    la.add_argument("-n", type=int, default=10)
    la.add_argument("--by", default="path", choices=["path", "modificationTime"])

    lt = sub.add_parser("land-training", help="labelled CSVs -> Parquet partitioned by label")
    lt.add_argument("--fake")
    lt.add_argument("--true")
    lt.add_argument("--out", required=True)

    st = sub.add_parser("status", help="file count, bytes and direct children per dataset folder")
    st.add_argument("dataset", nargs="+", help="name=path")
    return p


def main(argv=None, spark=None) -> int:
    args = build_parser().parse_args(argv)
    if spark is None:
        from .session import build_session
        spark = build_session(args.master, f"newsflow-{args.job}", None)
    from .session import scratch_scope
    with scratch_scope(spark):
        return _run(spark, args)


def _run(spark, args) -> int:
    from .plans import jobs

    if args.job == "train":
        res = jobs.train(spark, args.fake, args.true, model_paths=args.model)
        res.preview.show(truncate=False)
        res.sample.show(truncate=False)
        print(json.dumps({k: float(v) for k, v in res.metrics.items()}))
    elif args.job == "score-batch":
        from .sinks.files import write_parquet
        from .sources.files import load_model, read_article_csv
        pred = jobs.score_batch(load_model(args.model), read_article_csv(spark, args.input),
                                args.dead_letter or f"{args.out}_dead_letter")
        write_parquet(pred, args.out, partition_by=("prediction_label",))
    elif args.job == "latest":
        for r in jobs.latest_files(spark, args.path, args.n, args.by).collect():      # n rows
            print(json.dumps({k: str(v) for k, v in r.asDict().items()}))
    elif args.job == "score-stream":
        from .sources.files import load_model
        from .streaming.control import BatchMetricsListener
        from .streaming.scoring import start_scoring
        seen = [BatchMetricsListener("batch"), BatchMetricsListener("dead_letter")]     # G6
        for x in seen:
            spark.streams.addListener(x)
        qs = start_scoring(load_model(args.model), _stream(spark, args), args.out, args.checkpoint, args.trigger,
                           args.dead_letter, args.available_now)
        try:
            _finish(spark, qs, args.available_now)
        finally:
            for x in seen:
                spark.streams.removeListener(x)
                print(json.dumps({"metrics": x.name, "batches": len(x.batches), **x.totals()}))
    elif args.job == "ingest-stream":
        from .streaming.ingest import start_ingest, start_ingest_once
        if args.read_once and not args.dedupe:
            qs = start_ingest_once(_stream(spark, args), args.out, args.checkpoint, dead_letter=args.dead_letter,
                                   available_now=args.available_now)
        else:
            qs = start_ingest(_stream(spark, args), args.out, args.checkpoint, dead_letter=args.dead_letter,
                              available_now=args.available_now, dedupe=args.dedupe, delay=args.delay)
        _finish(spark, qs, args.available_now)
    elif args.job == "console":
        from .streaming.ingest import start_console
        _finish(spark, [start_console(_stream(spark, args), args.checkpoint, available_now=args.available_now)],
                args.available_now)
    elif args.job == "feed-stream":
        from .streaming.feeds import running_totals, start_feed_stream
        from .streaming.sources import feed_stream
        docs = feed_stream(spark, args.format, args.input, _options(args.option), args.max_files_per_trigger)
        where = {k: getattr(args, k) or f"{args.out or args.checkpoint}_{k}" for k in ("dead_letter", "totals")}
        _finish(spark, [start_feed_stream(docs, args.out, args.checkpoint, args.trigger, args.available_now, args.sink,
                                          _options(args.sink_option), **where)], args.available_now)
        print(json.dumps(running_totals(spark, where["totals"])))
    elif args.job == "backfill":
        print(json.dumps({"rows": jobs.backfill(spark, args.input, args.out)}))
    elif args.job == "export":
        print(json.dumps(jobs.export(spark, args.input, args.out, single_file=args.single_file)))
    elif args.job == "extract-feeds":
        jobs.extract_and_publish(spark.read.parquet(args.input), args.sink, args.out, _options(args.sink_option))
    elif args.job == "land-training":
        from .sinks.files import land_training
        print(json.dumps({str(k): v for k, v in land_training(spark, args.fake, args.true, args.out).items()}))
    elif args.job == "status":
        ds = dict(d.split("=", 1) for d in args.dataset)
        for r in jobs.dataset_status(spark, ds).collect():      # one row per named dataset
            print(json.dumps({k: str(v) for k, v in r.asDict().items()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
