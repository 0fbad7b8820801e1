"""Pairs of nearby points: an exact distance join written as an equi-join on grid cells."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.functions.columns import METERS_PER_DEGREE, dbl
from listingflow.session import materialize

# Cells are a hair wider than the limit, so rounding can never put a pair at the limit two cells apart.
_SLACK = 1.0 + 1e-6
# From this latitude on, one cell spans all longitudes.
_POLAR_DEGREES = 89.9
# Logarithms of usable values are far from this, so negative values share one cell without neighbours.
_NEGATIVE_CELL = -1_000_000


def _band(lat: Column, max_m: float) -> Column:
    return F.floor(lat / dbl(max_m * _SLACK / METERS_PER_DEGREE))


def _lon_cell(lon: Column, band: Column, max_m: float) -> Column:
    """Longitude cell in a latitude band; wide enough for the band and the bands next to it."""
    height = max_m * _SLACK / METERS_PER_DEGREE
    steepest = F.greatest(F.abs(band - 1), F.abs(band + 2)) * dbl(height)
    width = F.when(
        steepest < dbl(_POLAR_DEGREES), dbl(height) / F.cos(F.radians(steepest))
    ).otherwise(dbl(1e6))
    return F.floor(lon / width)


def ratio_cell(value: Column, min_similarity: float | None) -> Column:
    """Cell such that two values whose ratio passes the similarity limit are at most one cell apart."""
    if min_similarity is None or min_similarity <= 0:
        return F.lit(0).cast("bigint")
    width = -math.log(min_similarity) * _SLACK if min_similarity < 1 else 1e-9
    return F.when(value > 0, F.floor(F.ln(value) / dbl(width))).otherwise(F.lit(_NEGATIVE_CELL).cast("bigint"))


def neighbour_cells(cell: str) -> Column:
    return F.explode(F.array(*[F.col(cell) + step for step in (-1, 0, 1)]))


def place(points: DataFrame, max_m: float) -> DataFrame:
    """Add the home cell (``band``, ``cell``) of each point."""
    band = _band(F.col("lat"), max_m)
    return points.withColumn("band", band).withColumn("cell", _lon_cell(F.col("lon"), F.col("band"), max_m))


def reach(points: DataFrame, max_m: float) -> DataFrame:
    """One row per cell in which a point looks for partners: its own, the next one, and three in the band above.

    The cells behind are covered by the partner looking forward, so two points meet exactly once
    (twice inside a cell, where the caller compares the ids).
    """
    here, above = _band(F.col("lat"), max_m), _band(F.col("lat"), max_m) + 1
    here_cell, above_cell = _lon_cell(F.col("lon"), here, max_m), _lon_cell(F.col("lon"), above, max_m)
    targets = [(here, here_cell, True), (here, here_cell + 1, False)]
    targets += [(above, above_cell + step, False) for step in (-1, 0, 1)]
    options = F.array(*[
        F.struct(b.alias("band"), c.alias("cell"), F.lit(own).alias("own")) for b, c, own in targets
    ])
    return points.withColumn("_target", F.explode(options)).select(*points.columns, "_target.*")


def join_on_cells(
    probe: DataFrame, home: DataFrame, keys: Sequence[str], hot_rows: int, condition: Column, ids: tuple[str, str]
) -> DataFrame:
    """Equi-join on ``keys``; a key with more than ``hot_rows`` home rows is spread over several tasks.

    Home rows of a hot key get one of its salts and probe rows all of them, so each task compares at most about
    ``hot_rows`` home rows, and every pair still meets once. ``probe`` and ``home`` are aliased p and h.
    """
    hot = materialize(
        home.groupBy(*keys).count().where(F.col("count") > hot_rows)
        .select(*keys, F.ceil(F.col("count") / F.lit(hot_rows)).cast("int").alias("salts")),
        "hot-cells",
    )
    if hot.isEmpty():
        on = [F.col(f"p.{k}") == F.col(f"h.{k}") for k in keys]
        return probe.alias("p").join(home.alias("h"), [*on, condition])
    probe_id, home_id = ids
    salted_home = home.join(hot, list(keys), "left").withColumn(
        "salt", F.pmod(F.xxhash64(home_id), F.coalesce("salts", F.lit(1)).cast("bigint"))
    ).drop("salts")
    salted_probe = probe.join(hot, list(keys), "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1)).cast("bigint") - 1))
    ).drop("salts")
    on = [F.col(f"p.{k}") == F.col(f"h.{k}") for k in [*keys, "salt"]]
    return salted_probe.alias("p").join(salted_home.alias("h"), [*on, condition])
