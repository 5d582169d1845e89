"""ST2 scoring stream (M5 + P5/P6/P7 -> K6) and its ``foreachBatch`` variant (ST4).

Primary path: the model's ``transform`` runs directly on the streaming
DataFrame (row-local, no shuffle) into the Parquet file sink partitioned by
``prediction_label``: exactly-once through the sink's commit log, one
computation per micro-batch.

``foreachBatch`` variant: each batch is committed as a whole under its own
``batch_id`` folder, so a replay leaves exactly the last attempt's rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.messages import BAD_COLUMN, parse_messages
from ..functions.text import preprocessed_content
from ..operators.classifier import score
from ..sinks.batches import clear_batch, replace_batch
from .control import observed_batch, start, start_dead_letter

PREDICTION_COLUMNS = ["title", "text", "subject", "date", "prob_fake", "prob_true", "processed_at",
                      "prediction_label"]


def scorable(parsed: DataFrame) -> DataFrame:
    """Good rows (X5) with the serving-side ``content`` (T3 + T4, no length cut)."""
    return parsed.filter(~F.col(BAD_COLUMN)).withColumn("content", preprocessed_content("title", "text"))


def predictions(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """M5 + P5 + P6 + P7: the prediction row of each article."""
    out = score(model, rows, keep=["title", "text", "subject", "date"])
    return out.select("title", "text", "subject", "date", "prob_fake", "prob_true",
                      F.current_timestamp().alias("processed_at"), "prediction_label")


def start_scoring(model: PipelineModel, stream: DataFrame, out: str, checkpoint: str,
                  trigger: str = C.SCORE_TRIGGER, dead_letter: str | None = None,
                  available_now: bool = False):
    """Starts the scoring and the dead-letter query (``out`` + ``_dead_letter`` unless named); returns them."""
    parsed = parse_messages(stream, flag_bad=True)
    pred = observed_batch(predictions(model, scorable(parsed)))       # G6: counts per micro-batch
    q = start(pred.writeStream.format("parquet").partitionBy("prediction_label").outputMode("append")
              .option("path", out), f"{checkpoint}/predictions", trigger, available_now)
    return [q, start_dead_letter(parsed, dead_letter or f"{out}_dead_letter", checkpoint, trigger, available_now)]


def batch_writer(model: PipelineModel, out: str, dead_letter: str | None = None):
    """ST4: ``foreachBatch`` function that commits one ``batch_id`` folder per batch and output.

    Predictions go to ``out``, malformed messages to the dead letter (``out`` +
    ``_dead_letter`` unless named), and one row of counts (G6: good, bad, fake) to ``out``
    + ``_metrics``, taken from what was written.  A batch without messages writes nothing
    (X6) and clears what an earlier attempt of it wrote.
    """
    bad_path, metrics = dead_letter or f"{out}_dead_letter", f"{out}_metrics"

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if batch_df.isEmpty():
            for path in (out, bad_path, metrics):
                clear_batch(spark, path, batch_id)
            return
        pred = predictions(model, scorable(batch_df))
        written = replace_batch(pred, out, batch_id, partition_by=("prediction_label",))
        bad = batch_df.filter(F.col(BAD_COLUMN)).select("raw_value", F.current_timestamp().alias("received_at"))
        bad_written = replace_batch(bad, bad_path, batch_id)
        good = spark.read.schema(pred.schema).parquet(written).agg(
            F.count(F.lit(1)).alias("good"),
            F.count_if(F.col("prediction_label") == C.LABEL_FAKE).alias("fake"))
        bad = spark.read.schema(bad.schema).parquet(bad_written).agg(F.count(F.lit(1)).alias("bad"))
        replace_batch(good.crossJoin(bad).select("good", "bad", "fake"), metrics, batch_id)    # one row each
    return write_batch


def start_scoring_foreach_batch(model: PipelineModel, stream: DataFrame, out: str, checkpoint: str,
                                trigger: str = C.SCORE_TRIGGER, dead_letter: str | None = None,
                                available_now: bool = False):
    parsed = parse_messages(stream, flag_bad=True)
    return start(parsed.writeStream.foreachBatch(batch_writer(model, out, dead_letter)), checkpoint, trigger,
                 available_now)
