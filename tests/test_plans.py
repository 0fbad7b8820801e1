"""Plans have the shape that holds at scale."""

import datetime as dt

import pytest

import __spark_entry__ as spark_entry
from builders import listing, listings, members, scored, scored_row
from listingflow import bindings
from listingflow.operators import model
from listingflow.operators.dedup import MatchConfig, gated_pairs
from listingflow.plans.analytics import run_query
from listingflow.plans.load import load_batch
from listingflow.session import work_path

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "size_gate", "find_duplicates_pairs", "cluster_review_members", "truth_links", "pair_metrics",
    "naive_price_flag", "compare_fraud_methods", "clean_training_set", "grid_points", "prepare_requests",
    "interpolate_grid", "upsert_facts", "classify_changes", "area_leaderboard", "monthly_rent_index",
    "agent_repost_rate", "model_error_by_segment", "systematic_sample",
])
def test_no_join_without_keys(spark, name):
    text = plan(spark_entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_pairs_meet_on_block_and_cell(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(gated_pairs(listings(spark, listing(1), listing(2)), MatchConfig()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(line for line in text.splitlines() if "SortMergeJoin" in line)
    assert all(key in join for key in ("area", "property_type", "bedrooms", "band", "cell"))


@pytest.fixture(scope="module")
def warehouse(spark):
    rows = [scored_row(i, listed_date=dt.date(2026, 5, 1 + i)) for i in range(1, 5)]
    return load_batch(spark, work_path(spark, "warehouse"), scored(spark, *rows),
                      members(spark, {1: "cluster_1", 2: "cluster_1"})).warehouse


@pytest.mark.parametrize("name", ["area_leaderboard", "monthly_rent_index"])
def test_first_postings_are_cut_before_the_exchange(warehouse, name):
    text = plan(run_query(warehouse, name)[1])
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text
    assert "EqualTo(is_active,1)" in text and "title" not in text


def test_training_rows_are_cut_before_the_exchange(spark):
    df = listings(spark, listing(1), listing(2))
    flags = spark.createDataFrame([(1, 0)], "listing_id bigint, flag int")
    text = plan(model.clean_training_set(df, members(spark, {1: "c", 2: "c"}), flags))
    assert "Window" not in text  # ranked on ids and dates alone, before the full rows are joined


def test_batches_are_read_off_one_written_table(spark):
    for batch in bindings._batches(spark, SF_DIR):
        text = plan(batch)
        assert "Window" not in text and "Join" not in text
