import random
import statistics
import statistics

import pytest
from pyspark.sql import functions as F

from builders import listing, listings
from listingflow.operators import evaluate, quality, sampling


def test_only_the_row_far_below_its_median_is_flagged(spark):
    df = listings(spark, *[listing(i, price_aed_month=10000) for i in (1, 2, 3, 4)],
                  listing(5, price_aed_month=5000), listing(6, area=None, price_aed_month=1),
                  listing(7, price_aed_month=None))
    flags = {r.listing_id: r.flag for r in evaluate.naive_price_flag(df).collect()}
    assert flags == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 6: 0, 7: 0}


def test_medians_are_exact(spark):
    rng = random.Random(1)
    data = [("a" if rng.random() < 0.5 else "b", rng.randrange(40)) for _ in range(501)] + [("c", 3), ("c", 4)]
    got = {r.g: r.median for r in evaluate.group_medians(
        spark.createDataFrame(data, "g string, v int"), ("g",), "v").collect()}
    assert got == {g: statistics.median([v for k, v in data if k == g]) for g in "abc"}


def test_flag_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0)], "flag int, truth int")
    row = evaluate.flag_metrics(df).first()
    assert (row.true_positives, row.false_positives, row.false_negatives) == (1, 1, 1)
    assert (row.precision, row.recall, row.f1) == (0.5, 0.5, 0.5)


def test_medians_by_selection(spark, monkeypatch):
    rng = random.Random(6)
    groups = {
        "one": [5.0], "two": [1.0, 2.0], "same": [7.0] * 50, "ends": [0.0] * 30 + [1e6] * 30,
        "wide": [rng.uniform(-1e9, 1e9) for _ in range(999)] + [1e300, -1e300], "ints": [float(rng.randrange(10**6)) for _ in range(2000)],
        "tiny": [1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1e308, -1e308], "far": [float("inf"), 1.0, 2.0, 3.0, float("-inf")],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("one", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    for bins in (4, evaluate.BINS):
        monkeypatch.setattr(evaluate, "BINS", bins)
        got = {r.g: r.median for r in evaluate.group_medians(df, ("g",), "v").collect()}
        assert got == {g: statistics.median(values) for g, values in groups.items()}
    assert evaluate.group_medians(df.limit(0), ("g",), "v").count() == 0


def test_flag_metrics_without_flags(spark):
    row = evaluate.flag_metrics(spark.createDataFrame([(0, 1), (0, 0)], "flag int, truth int")).first()
    assert (row.flagged, row.precision, row.f1) == (0, 0.0, 0.0)
    empty = evaluate.flag_metrics(spark.createDataFrame([], "flag int, truth int")).first()
    assert (empty.flagged, empty.f1) == (0, 0.0)


def test_methods_are_compared_on_all_rows(spark):
    df = listings(spark, *[listing(i, price_aed_month=10000) for i in (1, 2, 3, 4)],
                  listing(5, price_aed_month=5000, is_suspicious_truth=1),
                  listing(6, price_aed_month=7000, is_suspicious_truth=1))
    scored = spark.createDataFrame([(5, -0.5), (6, -0.3), (1, 0.0)], "listing_id bigint, residual_pct double")
    rows = {r.method: r for r in evaluate.compare_fraud_methods(df, scored).collect()}
    assert (rows["naive"].recall, rows["model"].recall) == (0.5, 1.0)
    assert rows["model"].true_suspicious == 2 and rows["naive"].f1_gain == pytest.approx(0.3333, abs=1e-4)


def test_quality(spark):
    df = listings(spark, listing(1), listing(2), listing(3, title=None), listing(4, title=None),
                  listing(5, price_aed_month=0), listing(6, price_aed_month=None))
    full = {r.field: r.completeness for r in quality.field_completeness(df).collect()}
    assert full["title"] == 0.6667 and full["area"] == 1.0 and full["price_aed_month"] == 0.8333
    assert quality.exact_duplicates(df).first()[0] == 2
    assert quality.invalid_prices(df).first()[0] == 1


def test_every_kth_row_from_the_first(spark):
    df = spark.range(1000).select((1000 - F.col("id")).alias("v"), F.lit("wide").alias("text"))
    rows = sampling.systematic_sample(df, ["v"], "v", 60).collect()
    assert sorted(r.v for r in rows) == [1 + 16 * i for i in range(63)]
    assert sampling.systematic_sample(df.limit(5), ["v"], "v", 60).count() == 5


def test_latency_positions(spark):
    values = [float(i) for i in range(1, 201)]
    random.Random(2).shuffle(values)
    row = sampling.latency_summary(spark.createDataFrame([(v,) for v in values] + [(None,)], "ms double"), "ms").first()
    assert tuple(row) == (200, 100.5, 101.0, 199.0, 200.0)


def test_latency_of_one_repeated_value(spark):
    row = sampling.latency_summary(spark.range(3000).select(F.lit(2.0).alias("ms")), "ms").first()
    assert tuple(row) == (3000, 2.0, 2.0, 2.0, 2.0)
