"""A global position for every row without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.session import materialize

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, position below


def with_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row under ``order``, which must be a total order.

    Rows are range-partitioned and sorted per partition; positions are written with the rows, then shifted by
    the number of rows in the partitions before. Only one row per partition is ever gathered.
    """
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "row-index",
    )
    part = F.shiftright("_slot", _POSITION_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # One row per task of the sort above, so the broadcast is bounded by the number of shuffle partitions.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position)
        .drop("_part", "_offset", "_slot")
    )
