"""Scoring listings as they arrive with a model that was fitted before."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from listingflow.functions.columns import FRAUD_THRESHOLD, price_band
from listingflow.operators.model import predict

FEED_COLUMNS = (
    "listing_id", "title", "area", "property_type", "listed_date", "price_aed_month",
)


def arriving_listings(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """A stream over a folder in which new Parquet files of listings appear."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def judge_feed(predicted: DataFrame, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """Feed columns with prediction, relative gap and band; the band looks at the unrounded gap."""
    gap = F.try_divide(F.col("price_aed_month") - F.col("raw_prediction"), F.col("raw_prediction"))
    return predicted.withColumn("_gap", gap).select(
        *FEED_COLUMNS,
        F.bround("raw_prediction", 0).cast("bigint").alias("predicted_price_aed_month"),
        F.bround("_gap", 4).alias("residual_pct"),
        price_band("_gap", -threshold).alias("flag"),
    )


def score_stream(listings: DataFrame, model: PipelineModel, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """Every arriving listing scored; stateless, so a batch frame gives the same rows."""
    return judge_feed(predict(model, listings), threshold)


def write_feed(feed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append scored listings to Parquet, each input file exactly once; ends when all present files are done."""
    return (
        feed.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


_PROGRESS = (
    "run_id string, batch_id bigint, started timestamp, n_rows bigint, latency_ms double, scoring_ms double, planning_ms double"
)


def _progress_row(progress) -> tuple:
    took = dict(progress.durationMs)
    return (
        str(progress.runId), progress.batchId, datetime.fromisoformat(progress.timestamp), progress.numInputRows,
        *(float(took.get(name, 0)) for name in ("triggerExecution", "addBatch", "queryPlanning")),
    )


def run_feed(spark: SparkSession, query: StreamingQuery, path: str, poll_seconds: float = 1.0, held: int = 1000) -> None:
    """Wait for the query's end and append one row for each of its micro-batches to the table at ``path``.

    Rows come from the query's own progress while it runs: when the micro-batch began, its rows, and the
    milliseconds of the whole trigger, of scoring and writing, and of planning. Spark keeps the last 100 reports; they are asked
    for much more often than that, and at most ``held`` rows wait for being written.
    """
    last, rows = -1, []

    def flush() -> None:
        if rows:
            spark.createDataFrame(rows, _PROGRESS).coalesce(1).write.mode("append").parquet(path)
            rows.clear()

    ended = False
    while not ended:
        ended = query.awaitTermination(poll_seconds)
        for progress in query.recentProgress:
            # A report of a trigger without new files repeats the number of the batch to come, with no rows.
            if progress.batchId > last and "addBatch" in dict(progress.durationMs):
                last = progress.batchId
                rows.append(_progress_row(progress))
        if ended or len(rows) >= held:
            flush()


def batch_durations(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, batch_id, started, n_rows, latency_ms, scoring_ms, planning_ms) of each micro-batch written to ``path``."""
    return spark.read.schema(_PROGRESS).parquet(path)
