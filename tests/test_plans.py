"""Physical-plan properties the jobs rely on at scale."""

import re

from pyspark.sql import functions as F

from newsflow.checks import fixtures
from newsflow.operators import aggregates, feeds, tfidf_nb
from newsflow.plans import relational
from newsflow.session import scratch_path
from newsflow.sources.files import read_predictions
from newsflow.sources.tables import feed_documents

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_and_column_pruning(spark):
    path = fixtures.prediction_dataset(spark, SF)
    fake = read_predictions(spark, path).filter(F.col("prediction_label") == "FAKE").select("title")
    p = plan(fake)
    assert "PartitionFilters: [isnotnull(prediction_label" in p and "(prediction_label#" in p
    assert "ReadSchema: struct<title:string>" in p
    summary = aggregates.by_subject_label(read_predictions(spark, path))
    assert "ReadSchema: struct<subject:string>" in plan(summary)


def test_feed_extraction_is_one_shuffle_and_one_parse(spark):
    """D1 by one aggregation: no window, no join, one exchange; one XML parse per document, and one of the
    entries of broken documents."""
    path = scratch_path(spark, "feeds")
    feed_documents(spark, SF).write.parquet(path)
    p = plan(feeds.extract_feeds(spark.read.parquet(path)))
    assert "Window" not in p and "Join" not in p
    assert p.count("Exchange hashpartitioning") == 1 and p.count("FileScan") == 1
    parses = re.findall(r"(?:from_xml|xmltostructs)\(", p.lower())
    assert len(parses) == 2, p


def test_landing_training_needs_no_shuffle(spark):
    """Every input file has one label already."""
    from newsflow.operators.labels import union_labelled, with_label
    from newsflow.sources.files import read_article_csv
    fake, true = fixtures.training_csvs(spark, SF)
    both = union_labelled(with_label(read_article_csv(spark, fake), 0.0), with_label(read_article_csv(spark, true), 1.0))
    assert "Exchange" not in plan(both)


def test_hot_partition_value_is_split_without_sampling(spark):
    """K1: one (subject, date) and no article id; a hash exchange, several tasks."""
    from newsflow.streaming.ingest import clustered_for_write
    rows = spark.range(4000).selectExpr("concat('t', id) as title", "concat('x', id) as text", "'s' as subject",
                                        "'d' as date", "cast(null as string) as article_id")
    out = clustered_for_write(rows, ("subject", "date"))
    assert "rangepartitioning(" not in plan(out) and "Exchange hashpartitioning" in plan(out)
    tasks = out.groupBy(F.spark_partition_id()).count().count()
    assert tasks > 2
    assert clustered_for_write(rows, ("subject", "date"), salts=1).groupBy(F.spark_partition_id()).count().count() == 1


def test_no_python_udf_in_scoring(spark):
    from newsflow.checks.queries import _ml_predictions
    _, pred = _ml_predictions(spark, SF)
    p = plan(pred)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_scoring_is_one_plan_without_hints(spark):
    """The scorer has no row-count branch: counts per (document, term), then a join AQE may pick freely."""
    docs = relational.prepared_articles(spark, SF)
    pred = tfidf_nb.fit(docs.filter("is_train")).predict(docs)
    logical = pred._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in logical and "UnresolvedHint" not in logical
    assert logical.count("Aggregate") == 2 and pred.count() == docs.count()


def test_preview_has_no_cap(spark):
    from newsflow.operators.ordering import preview
    assert preview(spark.range(6000), 5000, ("id",)).count() == 5000


def test_tasks_are_an_explicit_choice(spark):
    from newsflow.sources.tables import read_table
    assert "Exchange" not in plan(read_table(spark, SF, "documents"))
    assert "hashpartitioning(doc_id" in plan(read_table(spark, SF, "documents", 5))


def test_term_stats_single_aggregation(spark):
    docs = relational.prepared_articles(spark, SF)
    model = tfidf_nb.fit(docs.filter("is_train"))
    # One row per training term; document frequency never exceeds the number of documents.
    row = model.term_stats.agg(F.count("*").alias("v"), F.max("df").alias("mx")).first()
    assert row["v"] == model.vocab_size and row["mx"] <= model.n_docs


def test_colocated_join_has_no_exchange(spark):
    from newsflow.sources.tables import articles, colocated_articles
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        co = colocated_articles(spark, SF, buckets=4)
        p = plan(co)
        assert "SortMergeJoin" in p and "Exchange" not in p
        cols = ["article_id", "title", "text", "subject", "date", "label"]
        base = articles(spark, SF).select(*cols)
        assert co.select(*cols).exceptAll(base).count() == 0 and base.exceptAll(co.select(*cols)).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_messages_are_parsed_once(spark):
    from newsflow.functions.messages import parse_messages
    from newsflow.streaming.ingest import ingest_frame
    msgs = spark.read.schema("key string, value string").json(fixtures.landed_messages(spark, SF))
    p = plan(ingest_frame(parse_messages(msgs, flag_bad=True, required=())))
    assert p.count("from_json(") == 1
    t1 = plan(__import__("newsflow.checks.queries", fromlist=["x"]).t1_clean_text(spark, SF))
    assert t1.count("<[^>]+>") == 1                      # the tag strip runs once (not inlined into the filter)


def test_checkpoint_root_requires_shared_folder_on_a_cluster():
    from newsflow import session as S

    class Ctx:
        master = "spark://cluster:7077"
        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class FakeSession:
        conf = Conf()
        sparkContext = Ctx()

    import pytest
    with pytest.raises(RuntimeError):
        S.checkpoint_root(FakeSession())
