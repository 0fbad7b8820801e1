"""All steps on one batch, from raw listings to the loaded warehouse and its result files."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from listingflow.functions.columns import FRAUD_THRESHOLD
from listingflow.operators import evaluate, model, quality, requests, review, sampling
from listingflow.operators.dedup import Duplicates, MatchConfig, find_duplicates
from listingflow.plans.analytics import QueryResult, run_all
from listingflow.plans.load import LoadResult, load_batch, table_counts
from listingflow.session import materialize, work_path
from listingflow.sources.listings import write_records
from listingflow.streaming import scoring
from listingflow.streaming.scoring import judge_feed

STREAM_FILES = 8  # files of a micro-batch


@dataclass(frozen=True)
class FullRun:
    duplicates: Duplicates
    duplicate_metrics: DataFrame
    model: PipelineModel
    model_metrics: DataFrame
    importances: DataFrame
    scored: DataFrame
    fraud_metrics: DataFrame
    load: LoadResult
    queries: list[QueryResult]


def _stream_latency(
    spark: SparkSession, raw: DataFrame, price_model: PipelineModel, threshold: float, output: str
) -> DataFrame:
    """Scores the batch once more as a stream of its files; the latencies of its micro-batches."""
    arrived, scored = work_path(spark, "arrived"), f"{output}/streamed_feed"
    raw.write.parquet(arrived)
    stream = scoring.arriving_listings(spark, arrived, raw.schema, max_files=STREAM_FILES)
    feed = scoring.score_stream(stream, price_model, threshold)
    progress = f"{output}/stream_progress"
    scoring.run_feed(spark, scoring.write_feed(feed, scored, work_path(spark, "feed-checkpoint")), progress)
    return sampling.latency_summary(scoring.batch_durations(spark, progress), "latency_ms")


def run_full(
    spark: SparkSession, raw: DataFrame, warehouse: str, output: str,
    config: MatchConfig = MatchConfig(), params: model.ModelParams = model.ModelParams(),
    threshold: float = FRAUD_THRESHOLD, now: datetime | None = None,
    areas: DataFrame | None = None, types: DataFrame | None = None,
) -> FullRun:
    """Duplicates, clean set, model, out-of-fold scores, evaluation, load, queries, result files.

    Duplicates and the cheap price flag come before training: the model may learn neither from one unit twice nor
    from prices that look false. The model goes to ``output``/model, JSON records to folders next to it.

    ``raw`` is read by several steps, so it should be a stored table or a frame read from files as it is.
    """
    found = find_duplicates(raw, config)
    labelled = model.with_clusters(raw, found.members)
    flags = materialize(evaluate.naive_price_flag(raw), "naive-flags")
    clean = materialize(model.clean_training_set(raw, found.members, flags), "clean")

    fitted = model.fit_price_model(clean, params, written=True)
    model.save_model(fitted.model, f"{output}/model")
    scored = materialize(model.score_out_of_fold(raw, clean, found.members, params=params), "scored")
    loaded = load_batch(spark, warehouse, scored, found.members, threshold, now)
    queries = run_all(loaded.warehouse)

    duplicate_metrics = evaluate.pair_metrics(labelled)
    fraud_metrics = evaluate.compare_fraud_methods(raw, scored, threshold)
    transformed = fitted.model.transform(model.with_distance(raw))
    importances = model.feature_importances(fitted.model, transformed)
    # Only the picked listings are predicted.
    sample = sampling.systematic_sample(raw, ["listed_date", "listing_id"], "listing_id")
    feed = judge_feed(model.predict(fitted.model, sample))
    if areas is None:
        areas = materialize(requests.area_table(raw), "areas")
    if types is None:
        types = materialize(requests.type_table(raw), "types")

    records = {
        "duplicate_metrics": duplicate_metrics,
        "model_metrics": fitted.metrics,
        "fraud_metrics": fraud_metrics,
        "field_completeness": quality.field_completeness(raw),
        "exact_duplicates": quality.exact_duplicates(raw),
        "invalid_prices": quality.invalid_prices(raw),
        "total_rows": quality.total_rows(raw),
        "feature_importances": importances,
        "warehouse_counts": table_counts(loaded.warehouse),
        "etl_runs": loaded.warehouse.table("etl_runs"),
        "fair_value_grid": requests.fair_value_grid(areas, types, fitted.model),
        "test_predictions": fitted.heldout,
        "live_feed": feed,
        "cluster_members": review.review_members(raw, found),
        "cluster_pairs": review.review_pairs(found),
        "cluster_sample": review.cluster_sample(raw, found),
        "flagged_listings": model.flagged_listings(scored, threshold),
        **{f"query_{q.name}": q.rows for q in queries},
    }
    for name, rows in records.items():
        write_records(rows, f"{output}/{name}")
    write_records(_stream_latency(spark, raw, fitted.model, threshold, output), f"{output}/stream_latency")
    return FullRun(found, duplicate_metrics, fitted.model, fitted.metrics, importances, scored,
                          fraud_metrics, loaded, queries)
