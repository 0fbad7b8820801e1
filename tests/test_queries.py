"""Every registered query at the smallest scale, next to its SQL where there is one."""

import pytest

import __spark_entry__ as spark_entry
from compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
ORACLES = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", spark_entry.queries())
def test_query(spark, con, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == ""
    else:
        assert df.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(spark_entry.queries())


def test_entry(spark):
    rows = spark_entry.entry(spark).collect()
    assert len(rows) == 25 and rows[0].avg_price_per_sqft_annual >= rows[-1].avg_price_per_sqft_annual


def test_predictions_reach_every_listing(spark):
    scored = spark_entry.queries()["score_out_of_fold"](spark, SF_DIR)
    assert scored.select("listing_id").distinct().count() == 1500
