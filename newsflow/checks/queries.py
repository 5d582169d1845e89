"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Spark derives from them) in full; the DuckDB twin of each key is in
``oracle.ORACLE`` (keys without one are checked on rows only).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import text as TX
from ..functions.html import clean_html
from ..functions.messages import parse_json, parse_messages, to_json_value, to_message
from ..operators import aggregates, classifier, evaluation, feeds, ordering
from ..operators.labels import decode_label
from ..operators.tfidf_nb import prepare
from ..plans import jobs
from ..schema import TRAINING_CSV_SCHEMA
from ..session import scratch_path
from ..sinks import files as sinks
from ..sources.files import list_files, read_article_csv, read_ingested, read_predictions
from ..streaming import ingest, scoring
from ..streaming.sources import article_stream
from . import fixtures
from .fixtures import articles, feed_documents, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# --------------------------------------------------------------------------
# relational model (M-R) and its summaries
# --------------------------------------------------------------------------

@register("mr_predict")
def mr_predict(spark, sf_dir):
    _, pred = fixtures.mr(spark, sf_dir)
    return pred.select("article_id", "subject", "label", "is_train", "prediction", "prediction_label")


@register("g3_by_subject_label")
def g3_by_subject_label(spark, sf_dir):
    _, pred = fixtures.mr(spark, sf_dir)
    return aggregates.by_subject_label(pred)


@register("g1_row_count")
def g1_row_count(spark, sf_dir):
    _, pred = fixtures.mr(spark, sf_dir)
    return aggregates.row_count(pred)


@register("g2_by_label")
def g2_by_label(spark, sf_dir):
    _, pred = fixtures.mr(spark, sf_dir)
    return aggregates.by_label(pred)


@register("g4_by_date_label")
def g4_by_date_label(spark, sf_dir):
    _, pred = fixtures.mr(spark, sf_dir)
    return aggregates.by_date_label(pred)


@register("p5_label_decode")
def p5_label_decode(spark, sf_dir):
    """P5 over all articles: an unlabelled one (NULL) decodes to TRUE."""
    return articles(spark, sf_dir, how="left").select("article_id", "label", decode_label("label").alias("decoded"))


@register("m2_document_frequency")
def m2_document_frequency(spark, sf_dir):
    model, _ = fixtures.mr(spark, sf_dir)
    return model.term_stats.select("term", "df", F.round("idf", 9).alias("idf"))


@register("mr_theta")
def mr_theta(spark, sf_dir):
    model, _ = fixtures.mr(spark, sf_dir)
    return model.term_stats.select("term", "tf0", "tf1", F.round("theta0", 6).alias("theta0"),
                                   F.round("theta1", 6).alias("theta1"))


@register("m6_hash_split")
def m6_hash_split(spark, sf_dir):
    return articles(spark, sf_dir, labelled=False).select("article_id", evaluation.is_train("article_id")
                                                          .alias("is_train"))


@register("m7_metrics")
def m7_metrics(spark, sf_dir):
    _, pred = fixtures.mr(spark, sf_dir)
    m = evaluation.classification_metrics(pred.filter("is_test"))
    return m.select(*[F.round(c, 9).alias(c) for c in ("accuracy", "weighted_precision", "weighted_recall", "f1")],
                    "n")


@register("m8_auc_rank")
def m8_auc_rank(spark, sf_dir):
    _, pred = fixtures.mr(spark, sf_dir)
    scored = pred.filter("is_test").select(
        "label", F.round(F.col("score1") - F.col("score0"), 6).alias("margin"))
    return evaluation.auc_rank(scored, score="margin").select(F.round("auc", 9).alias("auc"))


@register("m9_sample_predictions")
def m9_sample_predictions(spark, sf_dir):
    _, pred = fixtures.mr(spark, sf_dir)
    sample = pred.select("article_id", "label", "prediction", F.round("prob_true", 6).alias("prob_true"))
    return evaluation.sample_predictions(sample, 10, ("article_id",), width=50,
                                         content=fixtures.prepared(spark, sf_dir))


@register("a1_token_counts")
def a1_token_counts(spark, sf_dir):
    prep = prepare(articles(spark, sf_dir, labelled=False))
    return prep.select(F.explode(TX.tokens("content")).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"))


@register("a2_stopword_removed")
def a2_stopword_removed(spark, sf_dir):
    prep = prepare(articles(spark, sf_dir, labelled=False))
    return prep.select("article_id", F.size(TX.tokens("content")).alias("n_tokens"),
                       F.size(TX.terms("content")).alias("n_terms"))


# --------------------------------------------------------------------------
# ML model (M1-M5)
# --------------------------------------------------------------------------

def _rounded():
    return [F.round(c, 6).alias(c) for c in ("prob_fake", "prob_true")]


def _ml_predictions(spark, sf_dir):
    """Fits the ML model on the training share; returns it with predictions of all prepared articles."""
    prep = fixtures.prepared(spark, sf_dir).drop("date", "is_test")
    model = classifier.fit(prep.filter("is_train"))
    return model, classifier.score(model, prep)


@register("m1_term_hash")
def m1_term_hash(spark, sf_dir):
    """M1: the hashed feature of every term of the corpus, read off the transformer's own vectors."""
    from pyspark.ml.functions import vector_to_array
    content = articles(spark, sf_dir, labelled=False).filter("title is not null and text is not null").select(
        TX.preprocessed_content("title", "text").alias("content"))
    tokenizer, remover, hasher = classifier.build_model().getStages()[:3]
    words = remover.transform(tokenizer.transform(content)).select(
        F.explode("filtered_words").alias("term")).distinct().select("term", F.array("term").alias("filtered_words"))
    return hasher.transform(words).select(
        "term", (F.array_position(vector_to_array("raw_features"), F.lit(1.0)) - 1).cast("int").alias("bucket"))


@register("m4_tfidf_nb_predict")
def m4_tfidf_nb_predict(spark, sf_dir):
    _, pred = _ml_predictions(spark, sf_dir)
    return pred.select("article_id", "label", "is_train", "prediction", "prediction_label")


@register("p6_probabilities")
def p6_probabilities(spark, sf_dir):
    _, pred = _ml_predictions(spark, sf_dir)
    return pred.select("article_id", *_rounded())


# --------------------------------------------------------------------------
# text functions and filters
# --------------------------------------------------------------------------

@register("t1_clean_text")
def t1_clean_text(spark, sf_dir):
    return TX.clean_text(articles(spark, sf_dir, labelled=False))


def _page_articles(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return pages.select(F.col("page_id").cast("string").alias("article_id"),
                        F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"),
                        F.col("html").alias("text"),
                        F.regexp_extract("url", r"://[^/]+/([^/?#]+)", 1).alias("subject"))


@register("t1_clean_pages")
def t1_clean_pages(spark, sf_dir):
    return TX.clean_text(_page_articles(spark, sf_dir))


@register("x2_min_text")
def x2_min_text(spark, sf_dir):
    return TX.clean_text(_page_articles(spark, sf_dir)).select("article_id", F.length("text").alias("text_len"))


@register("t3_content_null")
def t3_content_null(spark, sf_dir):
    a = articles(spark, sf_dir, labelled=False)
    c = TX.content("title", "text")
    return a.select("article_id", c.isNull().alias("content_null"), F.length(c).alias("content_len"))


@register("t4_preprocess")
def t4_preprocess(spark, sf_dir):
    a = articles(spark, sf_dir, labelled=False)
    return a.select("article_id", TX.preprocessed_content().alias("content"))


@register("x1_min_content")
def x1_min_content(spark, sf_dir):
    return prepare(articles(spark, sf_dir, labelled=False)).select("article_id", F.length("content").alias("content_len"))


@register("t6_key_prefix")
def t6_key_prefix(spark, sf_dir):
    return articles(spark, sf_dir, labelled=False).select("article_id", TX.title_key("title").alias("key"))


@register("t2_references")
def t2_references(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", clean_html(fixtures.references(F.col("text"))).alias("text"))


@register("t2_clean_html")
def t2_clean_html(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select("page_id", clean_html("html").alias("text"))


# --------------------------------------------------------------------------
# JSON messages
# --------------------------------------------------------------------------

@register("j1_json_parse")
def j1_json_parse(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", parse_json("props", PROPS_SCHEMA)["k"].alias("k"))


PROPS_SCHEMA = T.StructType([T.StructField("k", T.LongType(), True)])


@register("j2_json_build")
def j2_json_build(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    fields = ["event_id", "user_id", "event_type", "value", "props"]
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
                           T.StructField("props", T.StringType())])
    js = ev.select(to_json_value(fields).alias("value"))
    return js.select(F.from_json("value", schema).alias("d")).select("d.*")


@register("p2_flatten")
def p2_flatten(spark, sf_dir):
    msgs = to_message(articles(spark, sf_dir, labelled=False), fixtures.MESSAGE_FIELDS)
    return parse_messages(msgs)


@register("k10_message_key_value")
def k10_message_key_value(spark, sf_dir):
    path = scratch_path(spark, "published")
    msgs = to_message(articles(spark, sf_dir, labelled=False), fixtures.MESSAGE_FIELDS)
    sinks.publish(msgs, "json", path)
    back = spark.read.schema("key string, value string").json(path)
    return parse_messages(back, keep=("key",)).select("key", "article_id", "title", "subject", "date")


@register("x5_dead_letter")
def x5_dead_letter(spark, sf_dir):
    """What the ingest of malformed messages leaves in its dead-letter sink."""
    src = fixtures.landed_messages(spark, sf_dir, malformed=True)
    out, ckpt, dead = (scratch_path(spark, n) for n in ("scored", "scored_ckpt", "dead_letter"))
    for q in scoring.start_scoring(_ml_model(spark, sf_dir), article_stream(spark, "json", src), out, ckpt,
                                   dead_letter=dead, available_now=True):
        q.awaitTermination()
    rows = spark.read.schema("raw_value string, received_at timestamp").json(dead)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count("raw_value").alias("with_value"))


def _foreach_batch(spark, sf_dir):
    src = fixtures.landed_messages(spark, sf_dir, malformed=True)
    out = scratch_path(spark, "scored_batches")
    scoring.start_scoring_foreach_batch(_ml_model(spark, sf_dir), article_stream(spark, "json", src), out,
                                        scratch_path(spark, "scored_batches_ckpt"), available_now=True).awaitTermination()
    return out


@register("st4_foreach_batch")
def st4_foreach_batch(spark, sf_dir):
    return read_predictions(spark, _foreach_batch(spark, sf_dir)).select(
        "title", "subject", "date", "prediction_label", *_rounded())


@register("g6_batch_metrics")
def g6_batch_metrics(spark, sf_dir):
    """Good, bad and FAKE counts that the batches wrote, added up."""
    m = spark.read.parquet(f"{_foreach_batch(spark, sf_dir)}_metrics")
    return m.agg(*[F.sum(c).alias(c) for c in ("good", "bad", "fake")])


# --------------------------------------------------------------------------
# CSV / Parquet sources and sinks
# --------------------------------------------------------------------------

@register("s1_csv_roundtrip")
def s1_csv_roundtrip(spark, sf_dir):
    fake, true = fixtures.training_csvs(spark, sf_dir)
    return jobs.labelled_articles(spark, fake, true)


@register("s1_split_csv")
def s1_split_csv(spark, sf_dir):
    return read_article_csv(spark, fixtures.article_csv(spark, sf_dir), split=True)


@register("u1_labelled_union")
def u1_labelled_union(spark, sf_dir):
    fake, true = fixtures.training_csvs(spark, sf_dir)
    return aggregates.count_by(jobs.labelled_articles(spark, fake, true), "label")


@register("k11_land_training")
def k11_land_training(spark, sf_dir):
    fake, true = fixtures.training_csvs(spark, sf_dir)
    out = scratch_path(spark, "landed_training")
    sinks.land_training(spark, fake, true, out)
    schema = T.StructType(TRAINING_CSV_SCHEMA.fields + [T.StructField("label", T.DoubleType(), True)])
    return spark.read.schema(schema).parquet(out)


def _backfilled(spark, sf_dir):
    src = fixtures.article_csv(spark, sf_dir)
    out = scratch_path(spark, "backfill")
    n = jobs.backfill(spark, src, out)
    return out, n


@register("k4_backfill_parquet")
def k4_backfill_parquet(spark, sf_dir):
    out, _ = _backfilled(spark, sf_dir)
    return spark.read.schema(TRAINING_CSV_SCHEMA).parquet(f"{out}/parquet")


@register("k5_backfill_csv")
def k5_backfill_csv(spark, sf_dir):
    out, _ = _backfilled(spark, sf_dir)
    return read_article_csv(spark, f"{out}/csv")


@register("st8_backfill")
def st8_backfill(spark, sf_dir):
    """ST8: an aggregate over what the backfill wrote."""
    out, _ = _backfilled(spark, sf_dir)
    return spark.read.schema(TRAINING_CSV_SCHEMA).parquet(f"{out}/parquet").groupBy("subject").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@register("s3_partition_scan")
def s3_partition_scan(spark, sf_dir):
    path = fixtures.prediction_dataset(spark, sf_dir)
    df = read_predictions(spark, path).filter(F.col("prediction_label") == C.LABEL_FAKE)
    return df.select("title", "subject", "date", "prob_fake", "prob_true", "prediction_label")


@register("k7_export_predictions")
def k7_export_predictions(spark, sf_dir):
    path = fixtures.prediction_dataset(spark, sf_dir)
    out = scratch_path(spark, "export")
    res = jobs.export(spark, path, out)
    return spark.read.schema("title string, subject string, date string, prediction_label string, "
                             "prob_fake double, prob_true double").options(**sinks.CSV_OPTIONS).csv(res["predictions"])


def _summary(spark, sf_dir, name, schema):
    res = jobs.export(spark, fixtures.prediction_dataset(spark, sf_dir), scratch_path(spark, "export"))
    return spark.read.schema(schema).options(**sinks.CSV_OPTIONS).csv(res[name])


@register("k8_export_summaries")
def k8_export_summaries(spark, sf_dir):
    return _summary(spark, sf_dir, "by_subject", "subject string, prediction_label string, count bigint")


@register("k8_by_label")
def k8_by_label(spark, sf_dir):
    return _summary(spark, sf_dir, "by_label", "prediction_label string, count bigint")


@register("k8_by_date")
def k8_by_date(spark, sf_dir):
    return _summary(spark, sf_dir, "by_date", "date string, prediction_label string, count bigint")


@register("r2_preview")
def r2_preview(spark, sf_dir):
    path = fixtures.prediction_dataset(spark, sf_dir)
    df = read_predictions(spark, path).select("title", "subject", "prediction_label", "prob_fake")
    return ordering.preview(df, 10, ("subject", "title", "prob_fake"), truncate=40)


def _bucket_listing(spark, sf_dir):
    listing = list_files(spark, fixtures.bucket_files(spark, sf_dir))
    return listing.withColumn("partition", F.regexp_extract("path", r"/(bucket=[^/]*)/", 1)).withColumn(
        "file", F.regexp_extract("path", r"/file=([^/]*)/", 1).cast("bigint"))


@register("s6_file_inventory")
def s6_file_inventory(spark, sf_dir):
    return _bucket_listing(spark, sf_dir).groupBy("partition").agg(
        F.count(F.lit(1)).alias("files"), F.min("file").alias("first"), F.max("file").alias("last"),
        (F.min("length") > 0).alias("has_bytes"))


@register("g5_dataset_status")
def g5_dataset_status(spark, sf_dir):
    empty = scratch_path(spark, "empty")
    sinks.make_folder(spark, empty)
    st = jobs.dataset_status(spark, {"buckets": fixtures.bucket_files(spark, sf_dir), "empty": empty,
                                     "missing": scratch_path(spark, "missing")})
    return st.select("dataset", "files", "children", (F.col("bytes") > 0).alias("has_bytes"),
                     F.col("latest").isNotNull().alias("has_time"))


@register("r3_latest_partitions")
def r3_latest_partitions(spark, sf_dir):
    """R3 by name: the last files of the dataset (the folder names compare as text)."""
    return ordering.latest(_bucket_listing(spark, sf_dir), 5).select("partition", "file")


@register("r3_latest_by_time")
def r3_latest_by_time(spark, sf_dir):
    """R3 by time: the latest of all files, and how many of the listing are not later."""
    listing = _bucket_listing(spark, sf_dir)
    newest = ordering.latest(listing, 1, by="modificationTime").select(F.col("modificationTime").alias("at"))
    return listing.join(F.broadcast(newest), F.col("modificationTime") <= F.col("at")).agg(
        F.count(F.lit(1)).alias("files"), F.countDistinct("partition").alias("partitions"))


# --------------------------------------------------------------------------
# feed extraction
# --------------------------------------------------------------------------

@register("f1_rss_entries")
def f1_rss_entries(spark, sf_dir):
    e = feeds.feed_entries(feed_documents(spark, sf_dir))
    return e.select("feed_pos", "pos", "title", "published")


@register("f2_feed_errors")
def f2_feed_errors(spark, sf_dir):
    return feeds.feed_errors(feed_documents(spark, sf_dir)).select(
        "feed_pos", "url", "error", "recovered", F.col("rest").endswith("it never ends").alias("has_rest"))


@register("w1_first_n_per_feed")
def w1_first_n_per_feed(spark, sf_dir):
    e = feeds.first_entries(feeds.feed_entries(feed_documents(spark, sf_dir)))
    return e.select("feed_pos", "pos")


@register("x3_nonempty_title")
def x3_nonempty_title(spark, sf_dir):
    e = feeds.nonempty_titles(feeds.first_entries(feeds.feed_entries(feed_documents(spark, sf_dir))))
    return e.select("feed_pos", "pos", "title")


@register("d1_first_by_title")
def d1_first_by_title(spark, sf_dir):
    e = feeds.nonempty_titles(feeds.first_entries(feeds.feed_entries(feed_documents(spark, sf_dir))))
    return feeds.first_by_title(e).select("feed_pos", "pos", "title", "published", "fetched_at")


@register("x4_min_feed_text")
def x4_min_feed_text(spark, sf_dir):
    arts = feeds.extract_feeds(feed_documents(spark, sf_dir))
    return arts.select("feed_pos", "pos", F.length("text").alias("text_len"))


@register("t7_date_format")
def t7_date_format(spark, sf_dir):
    e = feeds.feed_entries(feed_documents(spark, sf_dir))
    return e.select("feed_pos", "pos", TX.article_date("published", F.col("fetched_at")).alias("date"))


@register("f_extract_feeds")
def f_extract_feeds(spark, sf_dir):
    arts = feeds.extract_feeds(feed_documents(spark, sf_dir))
    return arts.select("title", "text", "subject", "date", "timestamp", "date_guessed")


@register("k10_feed_messages")
def k10_feed_messages(spark, sf_dir):
    msgs = jobs.extract_and_publish(feed_documents(spark, sf_dir))
    return parse_messages(msgs, keep=("key",)).select("key", "title", "subject", "date", "timestamp")


# --------------------------------------------------------------------------
# streaming (file double of the message topic, availableNow triggers)
# --------------------------------------------------------------------------

def _ingested(spark, sf_dir, dedupe=False, runs=1):
    src = fixtures.landed_messages(spark, sf_dir)
    out, ckpt = scratch_path(spark, "ingest"), scratch_path(spark, "ingest_ckpt")
    for _ in range(runs):
        for q in ingest.start_ingest(article_stream(spark, "json", src), out, ckpt, available_now=True,
                                     dedupe=dedupe):
            q.awaitTermination()
    return out


@register("st1_ingest")
def st1_ingest(spark, sf_dir):
    out = _ingested(spark, sf_dir)
    return read_ingested(spark, f"{out}/parquet").drop("processed_at")


@register("st1_ingest_once")
def st1_ingest_once(spark, sf_dir):
    """ST1 with one read of the messages, malformed ones among them: rows by sink."""
    src = fixtures.landed_messages(spark, sf_dir, malformed=True)
    out = scratch_path(spark, "ingest")
    for q in ingest.start_ingest_once(article_stream(spark, "json", src), out, scratch_path(spark, "ingest_ckpt"),
                                      available_now=True):
        q.awaitTermination()
    rows = read_ingested(spark, f"{out}/parquet").select(F.lit("parquet").alias("sink"), "article_id", "subject")
    bad = spark.read.schema("raw_value string").json(f"{out}/dead_letter").agg(F.count(F.lit(1)).alias("n"))
    csv = read_article_csv(spark, f"{out}/csv").agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(bad.select(F.lit("dead letter").alias("sink"), F.col("n").cast("string").alias("article_id"),
                                       F.lit(None).cast("string").alias("subject"))).unionByName(
        csv.select(F.lit("csv").alias("sink"), F.col("n").cast("string").alias("article_id"),
                   F.lit(None).cast("string").alias("subject")))


@register("k1_stream_parquet")
def k1_stream_parquet(spark, sf_dir):
    """K1 layout: partition folders (subject, date) and the ids filed under them."""
    out = _ingested(spark, sf_dir)
    folders = list_files(spark, f"{out}/parquet").select(
        F.regexp_extract("path", r"/subject=([^/]*)/", 1).alias("subject_dir"),
        F.regexp_extract("path", r"/date=([^/]*)/", 1).alias("date_dir")).distinct()
    # Folder names carry %XX escapes only; keep a literal '+' from turning into a blank.
    def unescape(c):
        return F.expr(f"reflect('java.net.URLDecoder', 'decode', replace({c}, '+', '%2B'), 'UTF-8')")
    return folders.select(unescape("subject_dir").alias("subject"), unescape("date_dir").alias("date"))


@register("k2_stream_csv")
def k2_stream_csv(spark, sf_dir):
    out = _ingested(spark, sf_dir)
    return read_article_csv(spark, f"{out}/csv")


@register("st6_restart")
def st6_restart(spark, sf_dir):
    out = _ingested(spark, sf_dir, runs=2)
    return aggregates.row_count(read_ingested(spark, f"{out}/parquet"))


@register("d2_stream_dedupe")
def d2_stream_dedupe(spark, sf_dir):
    out = _ingested(spark, sf_dir, dedupe=True)
    return read_ingested(spark, f"{out}/parquet").select("title", "text", "article_id", "subject", "date")


@register("d2_stream_dedupe_csv")
def d2_stream_dedupe_csv(spark, sf_dir):
    """The CSV sink holds the same rows as the Parquet sink."""
    out = _ingested(spark, sf_dir, dedupe=True)
    return read_article_csv(spark, f"{out}/csv").select("title", "text", "subject", "date")


@register("d2_stream_sessions")
def d2_stream_sessions(spark, sf_dir):
    """D2 by the producer's time, over two runs: later copies arrive in the second."""
    src = scratch_path(spark, "timed_messages")
    minute = (F.col("article_id").cast("bigint") * 37 % 11) * 45
    arts = articles(spark, sf_dir, labelled=False).withColumn("minute", minute).withColumn(
        "timestamp", F.date_format(F.timestamp_seconds(minute * 60 + 1709251200), "yyyy-MM-dd'T'HH:mm:ssXXX"))
    out, ckpt = scratch_path(spark, "ingest"), scratch_path(spark, "ingest_ckpt")
    for part, rows in enumerate(("minute < 225", "minute >= 225")):
        to_message(arts.filter(rows), [*fixtures.MESSAGE_FIELDS, "timestamp"]).write.json(f"{src}/{part}")
        for q in ingest.start_ingest(article_stream(spark, "json", f"{src}/*"), out, ckpt, available_now=True, dedupe=True):
            q.awaitTermination()
    return read_ingested(spark, f"{out}/parquet").select("title", "article_id", "subject")


@fixtures.once("ml_model")
def _ml_model(spark, sf_dir):
    """The fitted ML model of an input, trained once per session (the scorer
    loads a trained model; it does not train)."""
    return _ml_predictions(spark, sf_dir)[0]


@register("k9_model_roundtrip")
def k9_model_roundtrip(spark, sf_dir):
    """K9 + S4: save to primary and backup, load through the fallback order
    (the first location is missing), score every document."""
    from ..sources.files import load_model
    model = _ml_model(spark, sf_dir)
    primary, backup = scratch_path(spark, "model"), scratch_path(spark, "model_backup")
    sinks.save_model(model, [primary, backup])
    loaded = load_model([scratch_path(spark, "missing_model"), backup])
    return jobs.score_batch(loaded, articles(spark, sf_dir, labelled=False)).select(
        "title", "subject", "prediction_label", *_rounded())


@register("st2_score")
def st2_score(spark, sf_dir):
    model = _ml_model(spark, sf_dir)
    src = fixtures.landed_messages(spark, sf_dir)
    out, ckpt = scratch_path(spark, "scored"), scratch_path(spark, "scored_ckpt")
    for q in scoring.start_scoring(model, article_stream(spark, "json", src), out, ckpt, available_now=True):
        q.awaitTermination()
    return read_predictions(spark, out).select("title", "subject", "date", "prediction_label", *_rounded())


@register("k6_score_stream_append")
def k6_score_stream_append(spark, sf_dir):
    return st2_score(spark, sf_dir)


@register("k6_replay_idempotent")
def k6_replay_idempotent(spark, sf_dir):
    model = _ml_model(spark, sf_dir)
    src = fixtures.landed_messages(spark, sf_dir)
    out = scratch_path(spark, "scored_batches")
    batch = parse_messages(spark.read.schema("key string, value string").json(src), flag_bad=True)
    write = scoring.batch_writer(model, out)
    write(batch, 0)
    write(batch, 0)          # replay of the same micro-batch
    return spark.read.parquet(out).select("title", "subject", "date", "prediction_label", *_rounded(), "batch_id")


@register("st5b_feed_stream")
def st5b_feed_stream(spark, sf_dir):
    from ..streaming.feeds import start_feed_stream
    src = scratch_path(spark, "feed_docs")
    feed_documents(spark, sf_dir).write.parquet(src)
    out, ckpt = scratch_path(spark, "feed_messages"), scratch_path(spark, "feed_ckpt")
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    start_feed_stream(stream, out, ckpt, available_now=True).awaitTermination()
    msgs = spark.read.schema("key string, value string, batch_id int").json(out)
    return parse_messages(msgs, keep=("key",)).select("key", "title", "subject", "date", "timestamp")


@register("st3_console")
def st3_console(spark, sf_dir):
    src = fixtures.landed_messages(spark, sf_dir)
    out = scratch_path(spark, "console")
    ingest.start_console(article_stream(spark, "json", src), scratch_path(spark, "console_ckpt"), sink="json", path=out,
                         available_now=True).awaitTermination()
    return spark.read.schema("title string, subject string, date string, article_id string").json(out)
