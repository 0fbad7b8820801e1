"""Scalar and derived columns. All are native Spark expressions, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
CENTER = (25.1972, 55.2744)
METERS_PER_DEGREE = 111_000.0
FRAUD_THRESHOLD = -0.30
REVIEW_COLUMNS = (
    "listing_id", "title", "area", "property_type", "bedrooms", "size_sqft",
    "price_aed_month", "agent_name", "listed_date",
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(value: float) -> Column:
    """A double literal (a bare ``0.3`` in SQL text would be a decimal)."""
    return F.lit(float(value))


def listing_text(title="title", description="description") -> Column:
    """Title, a blank, description; a null part counts as empty but the blank stays."""
    return F.concat(F.coalesce(_col(title), F.lit("")), F.lit(" "), F.coalesce(_col(description), F.lit("")))


def flat_distance(lat1, lon1, lat2, lon2, unit: str = "m") -> Column:
    """Flat-earth distance in metres or kilometres, accurate at city scale."""
    per_degree = {"m": METERS_PER_DEGREE, "km": METERS_PER_DEGREE / 1000.0}[unit]
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    north = (lat1 - lat2) * dbl(per_degree)
    east = (lon1 - lon2) * dbl(per_degree) * F.cos(F.radians((lat1 + lat2) / dbl(2)))
    return F.hypot(north, east)


def distance_to_center_km(lat="lat", lon="lon", center: tuple[float, float] = CENTER) -> Column:
    return F.bround(flat_distance(lat, lon, dbl(center[0]), dbl(center[1]), "km"), 2)


def ratio_similarity(a, b) -> Column:
    """1 for equal values, falling with their relative gap to 0; 0 next to a smaller value is 0, two zeros are null."""
    a, b = _col(a).cast("double"), _col(b).cast("double")
    larger = F.greatest(a, b)
    gap = F.abs(a - b) / F.nullif(larger, dbl(0))
    known = a.isNotNull() & b.isNotNull()
    return F.when(known & (larger == 0) & (a != b), dbl(0)).when(known & gap.isNotNull(), dbl(1) - F.least(gap, dbl(1)))


def date_parts(date="listed_date") -> dict[str, Column]:
    date = _col(date)
    return {"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)}


def date_key(date="listed_date") -> Column:
    """yyyymmdd as a number, so that ordering by the key is ordering by date."""
    p = date_parts(date)
    return p["year"] * 10000 + p["month"] * 100 + p["day"]


def month_label(year="year", month="month") -> Column:
    return F.format_string("%04d-%02d", _col(year), _col(month))


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-1 of the row as JSON with nulls kept, so no value can run into its neighbour."""
    return F.sha1(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def price_band(residual="residual_pct", threshold: float = -FRAUD_THRESHOLD) -> Column:
    residual = _col(residual)
    return (
        F.when(residual <= dbl(-threshold), "underpriced")
        .when(residual >= dbl(threshold), "overpriced")
        .otherwise("fair")
    )


def annual_price_per_sqft(price="price_aed_month", size="size_sqft") -> Column:
    return _col(price) * dbl(12) / F.nullif(_col(size), F.lit(0))


def unit_key(cluster="dup_cluster_id", listing_id="listing_id") -> Column:
    """The physical unit of a listing: its duplicate cluster, or itself."""
    return F.coalesce(_col(cluster), F.concat(F.lit("L"), _col(listing_id).cast("string")))


def add_residuals(df: DataFrame, prediction="raw_prediction", price: str = "price_aed_month") -> DataFrame:
    """Whole-unit prediction with the gap to the asked price, absolute and relative (4 digits)."""
    predicted = F.bround(_col(prediction), 0)
    return (
        df.withColumn("predicted_price_aed_month", predicted)
        .withColumn("residual_aed", F.col(price) - F.col("predicted_price_aed_month"))
        .withColumn("residual_pct", F.bround(F.try_divide("residual_aed", "predicted_price_aed_month"), 4))
    )


def project_review_fields(df: DataFrame, columns: Sequence[str] = REVIEW_COLUMNS) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])


def hash_bucket(key, buckets: int) -> Column:
    """Bucket of a key that does not depend on partitioning or row order."""
    return F.pmod(F.conv(F.substring(F.md5(_col(key).cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))
