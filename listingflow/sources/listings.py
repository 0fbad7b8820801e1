"""Reading raw listing batches and writing result records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.sources.schema import LISTING_SCHEMA


_BROKEN = "_broken"


def _read_csv(spark: SparkSession, path: str, schema: str, multiline: bool) -> DataFrame:
    # RFC 4180 quoting: a quote inside a quoted field is doubled. Without column pruning a line is judged by all its
    # fields, whatever is selected later.
    reader = spark.read.schema(f"{schema}, {_BROKEN} string").option("columnPruning", False)
    return reader.csv(
        path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN, escape='"', multiLine=multiline,
        enforceSchema=False,
    )


def _broken(lines: DataFrame) -> Column:
    """1 for a line that does not fit, else 0.

    Spark refuses queries on raw files that look at nothing but the broken line, such as a count of the others, so
    the first column takes part in a condition that always holds.
    """
    first = F.hash(lines.columns[0])
    return F.when(F.col(_BROKEN).isNull() & (F.least(first, F.lit(2147483647)) == first), 0).otherwise(1)


def read_listings(
    spark: SparkSession, path: str, schema: str = LISTING_SCHEMA, fmt: str = "csv", multiline: bool = False
) -> DataFrame:
    """Listings from CSV with a header, or from Parquet; the schema is never inferred.

    Lines that do not fit the schema are left out here and returned by ``rejected_lines``; no value turns into a null
    silently. With ``multiline``, quoted fields may hold line breaks; each file is then read by one task, so such a
    feed should come as many files. Without it a large file is split, and a record with a line break inside quotes
    ends up among the rejected lines.
    """
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    lines = _read_csv(spark, path, schema, multiline)
    return lines.where(_broken(lines) == 0).drop(_BROKEN)


def rejected_lines(
    spark: SparkSession, path: str, schema: str = LISTING_SCHEMA, multiline: bool = False
) -> DataFrame:
    """(file, line): the text of each CSV line that ``read_listings`` leaves out."""
    lines = _read_csv(spark, path, schema, multiline).withColumn("file", F.col("_metadata.file_path"))
    return lines.where(_broken(lines) == 1).select("file", F.col(_BROKEN).alias("line"))


def write_records(df: DataFrame, path: str) -> None:
    """Result rows as JSON records, nulls kept, in the order of ``df`` across the part files."""
    df.write.json(path, ignoreNullFields=False, mode="overwrite")
