"""Positions in a sorted feed: systematic samples and latency percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.functions.ordering import with_row_index
from listingflow.session import materialize

FEED_LENGTH = 60


def systematic_sample(
    df: DataFrame, order: Sequence[str], key: str, length: int = FEED_LENGTH
) -> DataFrame:
    """Every k-th row in ascending ``order`` from the first on, k so that about ``length`` rows remain; with
    ``position``.

    Only the order columns and ``key``, which names a row, are sorted; the few picked keys then meet the whole rows.
    """
    slim = df.select(*dict.fromkeys([*order, key]))
    indexed = with_row_index(slim, [F.asc_nulls_last(c) for c in order], "position")
    step = max(1, indexed.count() // length)
    picked = materialize(indexed.where(F.col("position") % step == 0).select(key, "position"), "picked")
    return df.join(picked, key)


def latency_summary(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, middle value, value at 99 % and maximum, to 4 digits.

    Percentiles are values at a position of the sorted column, not interpolated. A tie-break per row lets the
    range partitioning cut through a value that very many rows share.
    """
    values = df.select(F.col(column).cast("double").alias("v"), F.monotonically_increasing_id().alias("tie")).where(
        F.col("v").isNotNull()
    )
    indexed = with_row_index(values, [F.col("v"), F.col("tie")], "position")
    n = indexed.count()
    at = {"p50": n // 2, "p99": int(n * 0.99)}
    return indexed.agg(
        F.count(F.lit(1)).alias("events_scored"),
        F.bround(F.avg("v"), 4).alias("avg_latency"),
        *[F.bround(F.max(F.when(F.col("position") == i, F.col("v"))), 4).alias(f"{name}_latency")
          for name, i in at.items()],
        F.bround(F.max("v"), 4).alias("max_latency"),
    )
