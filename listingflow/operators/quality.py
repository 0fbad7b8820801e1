"""Data quality of a raw batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUIRED_COLUMNS = ("title", "area", "property_type", "price_aed_month", "size_sqft", "listed_date")
EXACT_KEYS = ("title", "area", "price_aed_month")


def field_completeness(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """(field, completeness): share of non-null values, all columns in one pass."""
    shares = df.agg(*[F.bround(F.avg(F.col(c).isNotNull().cast("int")), 4).alias(c) for c in columns])
    return shares.unpivot([], list(columns), "field", "completeness")


def exact_duplicates(df: DataFrame, keys: Sequence[str] = EXACT_KEYS) -> DataFrame:
    """One row: rows beyond the first of each key; null equals null."""
    repeats = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n"))
    return repeats.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("exact_duplicate_rows"))


def invalid_prices(df: DataFrame, price: str = "price_aed_month") -> DataFrame:
    """One row: rows with a price of 0 or less; a null price is not counted."""
    return df.agg(F.count_if(F.col(price) <= 0).alias("invalid_price_rows"))


def total_rows(df: DataFrame) -> DataFrame:
    """One row: the rows of the batch."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"))
