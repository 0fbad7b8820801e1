import datetime as dt

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from listingflow.functions import columns as c
from listingflow.functions.ordering import with_row_index
from listingflow.functions.text import ENGLISH_STOP_WORDS, tokens


def one(spark, *cols, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(*cols).first()


def test_listing_text_keeps_the_blank(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), (None, None)], "title string, description string")
    assert [r[0] for r in df.select(c.listing_text()).collect()] == ["a b", " b", "a ", " "]


def test_distance_to_center(spark):
    df = spark.createDataFrame([(25.1972, 55.2744), (25.0805, 55.1403)], "lat double, lon double")
    here, marina = [r[0] for r in df.select(c.distance_to_center_km()).collect()]
    assert here == 0 and 15 < marina < 22


def test_ratio_similarity_edges(spark):
    df = spark.createDataFrame(
        [(100.0, 90.0), (90.0, 100.0), (0.0, 0.0), (0.0, 5.0), (-5.0, 5.0), (None, 5.0), (5.0, None)],
        "a double, b double")
    got = [r[0] for r in df.select(c.ratio_similarity("a", "b")).collect()]
    assert got[:2] == [pytest.approx(0.9)] * 2 and got[2:] == [None, 0.0, 0.0, None, None]


def test_rounding_is_half_even_and_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(2.5, 4), (3.5, 4), (0.4, 4)], "raw_prediction double, price_aed_month int")
    rows = c.add_residuals(df).collect()
    assert [r.predicted_price_aed_month for r in rows] == [2.0, 4.0, 0.0]
    assert [r.residual_pct for r in rows] == [1.0, 0.0, None]


def test_bands_include_their_limits(spark):
    df = spark.createDataFrame([(-0.3,), (-0.2999,), (0.2999,), (0.3,)], "residual_pct double")
    assert [r[0] for r in df.select(c.price_band()).collect()] == ["underpriced", "fair", "fair", "overpriced"]


def test_row_hash_keeps_neighbours_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), (None, "a")], "x string, y string")
    hashes = [r[0] for r in df.select(c.row_hash(["x", "y"])).collect()]
    assert len(set(hashes)) == 4 and hashes[3] == hashes[4]


def test_psf_unit_dates_and_nan(spark):
    row = one(spark, c.annual_price_per_sqft().alias("psf"), c.unit_key().alias("unit"),
              c.date_key("d").alias("d"), c.month_label(F.lit(2026), F.lit(3)).alias("m"),
              price_aed_month=1000, size_sqft=0, dup_cluster_id=None, listing_id=7, d=dt.date(2026, 3, 9))
    assert (row.psf, row.unit, row.d, row.m) == (None, "L7", 20260309, "2026-03")
    df = spark.createDataFrame([(float("nan"), 1), (2.0, None)], "x double, n int")
    assert [tuple(r) for r in c.nan_to_null(df).collect()] == [(None, 1), (2.0, None)]


def test_review_fields_are_those_that_exist(spark):
    df = spark.createDataFrame([(1, "t", 2)], "listing_id int, title string, other int")
    assert c.project_review_fields(df).columns == ["listing_id", "title"]


def test_tokens_of_any_script(spark):
    df = spark.createDataFrame([("The Été a new_unit 42 x! Дом won't",)], "t string")
    assert df.select(tokens(F.col("t"))).first()[0] == ["été", "new_unit", "42", "дом", "won"]


def test_stop_words_are_those_that_ship_with_spark(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_row_index_is_the_global_position(spark):
    df = spark.range(5000).select(F.expr("pmod(id * 7919, 13)").alias("k"), "id").repartition(7)
    rows = with_row_index(df, [F.col("k"), F.col("id")]).orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(5000))
    assert [(r.k, r.id) for r in rows] == sorted((r.k, r.id) for r in rows)
    assert with_row_index(df.where("id < 0"), [F.col("id")]).count() == 0
