"""Valuation requests: defaults, validation, scoring, and estimates from a precomputed grid."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.functions.columns import FRAUD_THRESHOLD, dbl, price_band
from listingflow.operators.model import predict
from listingflow.session import materialize

# Fixed values.
DEFAULT_AGE = 8
TOWER_FLOOR = 15
GRID_SIZES = 6
SQUARE = 1000  # rows of each side that one key of the grid's product pairs
GRID_KEY = ("area", "property_type", "furnished")
SIZE_LIMITS = (100, 20_000)
BEDROOM_LIMITS = (0, 10)
AGE_LIMITS = (0, 100)
FLOOR_LIMITS = (0, 200)


def area_table(df: DataFrame) -> DataFrame:
    """(area, lat, lon): the mean place of each area's listings."""
    return df.dropna(subset=["area"]).groupBy("area").agg(
        F.round(F.avg("lat"), 4).alias("lat"), F.round(F.avg("lon"), 4).alias("lon")
    )


def type_table(df: DataFrame) -> DataFrame:
    """(property_type, default_bedrooms, min_size, max_size, is_tower) as the listings show them.

    Default bedrooms are the half-even middle of the range; a type is a tower if any listing is above ground.
    """
    middle = F.bround((F.min("bedrooms") + F.max("bedrooms")) / dbl(2), 0)
    return df.dropna(subset=["property_type"]).groupBy("property_type").agg(
        middle.cast("int").alias("default_bedrooms"),
        F.min("size_sqft").alias("min_size"), F.max("size_sqft").alias("max_size"),
        F.max((F.col("floor") > 0).cast("int")).alias("is_tower"),
    )


def _default_floor(is_tower: Column) -> Column:
    return F.when(is_tower == 1, F.lit(TOWER_FLOOR)).otherwise(F.lit(0))


def _every_pair(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Each row of one table with each row of the other, dealt out in squares.

    The rows of each table fall into parts of about ``SQUARE`` rows by a hash of their key; a row is copied once
    for every part of the other table, and an ordinary join on both part numbers pairs them. A task's work is bounded by
    its squares, and the copies by the number of parts, whatever the tables' sizes.
    """
    n_left, n_right = (max(1, -(-t.count() // SQUARE)) for t in (left, right))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    rows = left.withColumn("_row", dealt(left_key, n_left)).withColumn("_column", numbers(n_right))
    columns = right.withColumn("_column", dealt(right_key, n_right)).withColumn("_row", numbers(n_left))
    return rows.join(columns, ["_row", "_column"]).drop("_row", "_column")


def grid_points(areas: DataFrame, types: DataFrame, steps: int = GRID_SIZES) -> DataFrame:
    """Every area with every type, ``steps`` evenly spaced sizes and both furnishings, other features at defaults."""
    per_type = _every_pair(areas.select("area", "lat", "lon"), types.select(
        "property_type", F.col("default_bedrooms").cast("int").alias("bedrooms"),
        F.col("min_size").cast("double").alias("low"), F.col("max_size").cast("double").alias("high"),
        F.col("is_tower").cast("int").alias("is_tower"),
    ), "area", "property_type")
    sized = per_type.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))))
    size = F.col("low") + F.col("i") * ((F.col("high") - F.col("low")) / dbl(steps - 1))
    return sized.select(
        "area", "lat", "lon", "property_type", "bedrooms",
        F.bround(size, 0).cast("int").alias("size_sqft"),
        F.lit(DEFAULT_AGE).alias("building_age_years"),
        _default_floor(F.col("is_tower")).alias("floor"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("furnished"),
    )


def fair_value_grid(areas: DataFrame, types: DataFrame, model: PipelineModel, steps: int = GRID_SIZES) -> DataFrame:
    """The model's price at every grid point."""
    return predict(model, grid_points(areas, types, steps)).select(
        "area", "property_type", "size_sqft", "furnished",
        F.bround("raw_prediction", 0).alias("predicted_price_aed_month"),
    )


def _outside(name: str, limits: tuple[float, float], low_open: bool = False) -> Column:
    value = F.col(name)
    low = value <= limits[0] if low_open else value < limits[0]
    return F.coalesce(low | (value > limits[1]) | F.isnan(value.cast("double")), F.lit(False))


def prepare_requests(requests: DataFrame, areas: DataFrame, types: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): defaults filled from the area and type tables, rejected rows with a reason.

    Area, type and size are required. Checks apply to what was asked, before defaults.
    """
    known_areas = materialize(
        areas.select("area", F.col("lat").alias("area_lat"), F.col("lon").alias("area_lon")), "areas"
    )
    known_types = materialize(types.select("property_type", "default_bedrooms", "is_tower"), "types")
    rules = [
        ("unknown area", F.col("area_lat").isNull()),
        ("unknown property_type", F.col("is_tower").isNull()),
        ("size_sqft missing", F.col("size_sqft").isNull()),
        ("size_sqft out of range", _outside("size_sqft", SIZE_LIMITS, low_open=True)),
        ("bedrooms out of range", _outside("bedrooms", BEDROOM_LIMITS)),
        ("building_age_years out of range", _outside("building_age_years", AGE_LIMITS)),
        ("floor out of range", _outside("floor", FLOOR_LIMITS)),
    ]
    if "price_aed_month" in requests.columns:
        price = F.col("price_aed_month")
        rules.append(("price_aed_month not positive", F.coalesce(~(price > 0), F.lit(True))))
    checked = (
        requests.join(known_areas, "area", "left")
        .join(known_types, "property_type", "left")
        .withColumn("reason", F.coalesce(*[F.when(broken, reason) for reason, broken in rules]))
    )
    valid = (
        checked.where(F.col("reason").isNull())
        .withColumn("bedrooms", F.coalesce("bedrooms", "default_bedrooms"))
        .withColumn("furnished", F.coalesce(F.col("furnished").cast("int"), F.lit(0)))
        .withColumn("building_age_years", F.coalesce("building_age_years", F.lit(DEFAULT_AGE)))
        .withColumn("floor", F.coalesce("floor", _default_floor(F.col("is_tower"))))
        .withColumn("lat", F.col("area_lat"))
        .withColumn("lon", F.col("area_lon"))
        .drop("area_lat", "area_lon", "default_bedrooms", "is_tower", "reason")
    )
    rejected = checked.where(F.col("reason").isNotNull()).select(*requests.columns, "reason")
    return valid, rejected


def judge_requests(predicted: DataFrame, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """Residuals, band and suspicion from ``raw_prediction``; the band looks at the rounded relative gap."""
    whole = F.bround("raw_prediction", 0)
    gap = F.col("price_aed_month") - F.col("predicted_price_aed_month")
    return (
        predicted.withColumn("predicted_price_aed_month", whole)
        .withColumn("residual_pct", F.bround(F.try_divide(gap, F.col("predicted_price_aed_month")), 4))
        .withColumn("residual_aed", F.bround(gap, 1))
        .withColumn("flag", price_band("residual_pct", -threshold))
        .withColumn("suspicious", F.coalesce(F.col("residual_pct") <= dbl(threshold), F.lit(False)))
        .drop("raw_prediction")
    )


def score_requests(requests: DataFrame, model: PipelineModel, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """Prepared requests with a price, scored by the model."""
    return judge_requests(predict(model, requests), threshold)


def grid_segments(grid: DataFrame) -> DataFrame:
    """(key, low, high, low_price, high_price): between two neighbouring sizes of a key, low included.

    Under the first size the first price holds, from the last size on the last one. Of several prices of one
    size the highest begins a segment and the lowest ends one.
    """
    points = grid.groupBy(*GRID_KEY, F.col("size_sqft").cast("double").alias("low")).agg(
        F.max(F.col("predicted_price_aed_month").cast("double")).alias("low_price"),
        F.min(F.col("predicted_price_aed_month").cast("double")).alias("_least"),
    ).where(F.col("low").isNotNull())
    by_size = Window.partitionBy(*GRID_KEY).orderBy("low")
    return points.select(
        *GRID_KEY, "low", F.lead("low").over(by_size).alias("high"), "low_price",
        F.lead("_least").over(by_size).alias("high_price"),
        F.when(F.row_number().over(by_size) == 1, F.col("_least")).alias("first_price"),
    )


def interpolate_grid(requests: DataFrame, grid: DataFrame) -> DataFrame:
    """``estimate``: linear between the grid sizes next to the asked size, the end value outside the grid.

    Each key's range of sizes is cut into as many bins as it has points. A segment is listed in every bin that it
    touches, at most two rows a point over all, and a request in its one bin, so that request and segment meet on key and bin
    and no key's grid is held together. A request without a size, or with a key that the grid lacks, has no estimate.
    """
    segments = materialize(grid_segments(grid), "segments")
    ranges = materialize(
        segments.groupBy(*GRID_KEY).agg(
            F.min("low").alias("_first"), F.max("low").alias("_last"), F.count(F.lit(1)).alias("_bins"),
            F.max("first_price").alias("_first_price"),
        ),
        "segment-ranges",
    )

    def bin_of(size: Column) -> Column:
        share = F.coalesce((size - F.col("_first")) / F.nullif(F.col("_last") - F.col("_first"), dbl(0)), dbl(0))
        inner = F.least(F.floor(share * F.col("_bins")), F.col("_bins") - 1)
        return F.when(size >= F.col("_last"), F.col("_bins") - 1).when(size < F.col("_first"), F.lit(0)).otherwise(inner)

    listed = segments.join(ranges, list(GRID_KEY)).withColumn(
        "_bin", F.explode(F.sequence(bin_of(F.col("low")), bin_of(F.coalesce("high", "low"))))
    ).select(*GRID_KEY, "_bin", "low", "high", "low_price", "high_price").alias("s")
    # The request travels as one column, so that no name of it is taken for another.
    asked = requests.select(
        F.struct(*requests.columns).alias("request"), *GRID_KEY, F.col("size_sqft").cast("double").alias("_size")
    ).join(ranges, list(GRID_KEY), "left").withColumn("_bin", bin_of(F.col("_size"))).alias("a")
    size, low, high = F.col("a._size"), F.col("s.low"), F.col("s.high")
    met = asked.join(
        listed,
        [*[F.col(f"a.{k}") == F.col(f"s.{k}") for k in (*GRID_KEY, "_bin")], size >= low, high.isNull() | (size < high)],
        "left",
    )
    step = F.coalesce((size - low) / (high - low), dbl(0))
    between = F.col("s.low_price") + step * (F.coalesce("s.high_price", "s.low_price") - F.col("s.low_price"))
    estimate = F.when(size < F.col("a._first"), F.col("a._first_price")).otherwise(between)
    return met.select("a.request.*", F.round(estimate, 0).alias("estimate"))
