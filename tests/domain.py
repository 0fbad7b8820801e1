"""A made-up market for the tests: areas with their places, and property types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Area, latitude, longitude.
AREAS = (
    ("Harbour East", 41.390, 2.154),
    ("Old Mill", 41.401, 2.187),
    ("Tannery Row", 41.377, 2.142),
    ("Observatory Hill", 41.418, 2.129),
    ("Saltworks", 41.362, 2.171),
    ("Lower Orchard", 41.433, 2.196),
    ("Canal Bend", 41.395, 2.208),
    ("Quarry Park", 41.446, 2.163),
    ("Lantern Square", 41.383, 2.176),
    ("Weavers Yard", 41.409, 2.151),
    ("North Gate", 41.457, 2.182),
    ("Ferry Landing", 41.371, 2.193),
)

# Type, default bedrooms, smallest and largest size, whether in a tower.
PROPERTY_TYPES = (
    ("Loft", 1, 400, 600, 1),
    ("Flat", 2, 640, 940, 1),
    ("Duplex", 2, 960, 1410, 1),
    ("Penthouse", 4, 1450, 2150, 1),
    ("Terrace house", 4, 1750, 2550, 0),
    ("Farmhouse", 5, 2900, 5100, 0),
)


def default_areas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AREAS, "area string, lat double, lon double")


def default_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PROPERTY_TYPES,
        "property_type string, default_bedrooms int, min_size int, max_size int, is_tower int",
    )
