"""Headline timings on the driver's tables seen as listings.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Inputs (the listings and the
scored listings) are written once before the clock starts, as files of a batch would be; each query then runs to its
last row.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from listingflow import bindings, fixtures as fx  # noqa: E402
from listingflow.operators import evaluate, model, requests, sampling  # noqa: E402
from listingflow.operators.dedup import find_duplicates  # noqa: E402
from listingflow.plans import analytics, load  # noqa: E402
from listingflow.session import work_path  # noqa: E402
from listingflow.streaming import scoring  # noqa: E402


def run(df) -> None:
    """Compute every row and column."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}

    def clock(name, work):
        start = time.perf_counter()
        out = work()
        times[name] = round(time.perf_counter() - start, 3)
        return out

    def prepared(df, label):
        path = work_path(spark, label)
        df.repartition(cpus).write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    listings = prepared(fx.listings(spark, sf_dir), "listings")
    scored = prepared(fx.scored(spark, sf_dir), "scored")
    members = prepared(bindings._members(scored), "members")
    batch = scored.drop("dup_cluster_id")
    n = listings.count()

    found = find_duplicates(listings)
    clock("find_duplicates", lambda: found.clusters)  # works out all but the listed pairs
    clock("pair_metrics", lambda: run(evaluate.pair_metrics(model.with_clusters(listings, found.members))))
    # Building these frames already computes part of them, so that is on the clock too.
    clock("naive_price_flag", lambda: run(evaluate.naive_price_flag(listings)))
    flags = prepared(evaluate.naive_price_flag(listings), "flags")
    clock("clean_training_set", lambda: run(model.clean_training_set(listings, found.members, flags)))
    clean = prepared(model.clean_training_set(listings, found.members, flags), "clean")
    fitted = clock("fit_price_model", lambda: model.fit_price_model(clean, written=True)).model
    clock("score_out_of_fold", lambda: run(model.score_out_of_fold(listings, clean, found.members)))
    clock("score_all", lambda: run(model.score_all(fitted, listings)))

    path = work_path(spark, "warehouse")
    times_of_load = bindings.LOAD_TIMES
    clock("load_batch", lambda: load.load_batch(spark, path, batch, members, now=times_of_load[0]))
    loaded = clock("reload_batch", lambda: load.load_batch(spark, path, batch, members, now=times_of_load[1]))
    for name, _ in analytics.QUERIES:
        clock(name, lambda name=name: run(analytics.run_query(loaded.warehouse, name)[1]))
    clock("compare_fraud_methods", lambda: run(evaluate.compare_fraud_methods(listings, scored)))

    areas, types = requests.area_table(listings), requests.type_table(listings)
    asked = listings.withColumn("size_sqft", F.col("size_sqft").cast("double"))

    def score_requests():
        valid, _ = requests.prepare_requests(asked, areas, types)
        run(requests.score_requests(valid, fitted))

    clock("score_requests", score_requests)
    clock("fair_value_grid", lambda: run(requests.fair_value_grid(areas, types, fitted)))
    clock("systematic_sample", lambda: run(
        sampling.systematic_sample(listings, ["listed_date", "listing_id"], "listing_id")))

    arrived = work_path(spark, "arrived")
    listings.write.parquet(arrived)
    stream = scoring.arriving_listings(spark, arrived, listings.schema, max_files=2)
    feed = scoring.score_stream(stream, fitted)
    clock("score_stream", lambda: scoring.write_feed(
        feed, work_path(spark, "feed"), work_path(spark, "feed-checkpoint")).awaitTermination())

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"), "listings": n, "cpus": cpus,
        "rows_per_second": {
            name: round(n / times[name]) for name in ("find_duplicates", "score_all", "score_stream", "load_batch")
        },
        "reload_counts": {k: v for k, v in loaded.run.items() if k != "run_id"},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
