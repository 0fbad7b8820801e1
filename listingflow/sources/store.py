"""Warehouse tables as Parquet written by Spark, and a pointer file that says which folders are current.

Every load writes below a name of its own (``<table>/load=<name>``), and then moves one small JSON file into place as the
next version: the load of each dimension and of the run log, and for the facts, which Spark partitions by a hash of
their id, the load that last wrote each bucket. A name that is taken is an error, so of two loads that started from one
version the later one fails and loses nothing of the other's; where moving onto a taken name is not refused by the
store itself, as HDFS does, run one loader at a time. Folders that no pointer names may be deleted at any time, and old pointers
with them.

The number of buckets follows the facts: about ``ROWS_PER_BUCKET`` rows each, so that a changed row costs one bucket of
bounded size whatever the size of the table. When the facts have outgrown their buckets by half, the load that sees it
deals all of them out anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.sources.schema import SCHEMA_VERSION, WAREHOUSE_TABLES

FACTS = "fact_listings"
ROWS_PER_BUCKET = 1_000_000


@dataclass(frozen=True)
class Warehouse:
    """The warehouse at ``path`` as of ``version``; version 0 is the empty warehouse."""

    spark: SparkSession
    path: str
    version: int = 0
    loads: Mapping[str, str] = field(default_factory=dict)  # the load of each table but the facts
    facts: Mapping[str, str] = field(default_factory=dict)  # the load of each bucket that has rows
    buckets: int = 1

    def table(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """A whole table; of the facts, if wanted, only some buckets."""
        if name == FACTS:
            wanted = self.facts if buckets is None else {str(b) for b in buckets} & self.facts.keys()
            folders = [f"load={self.facts[b]}/bucket={b}" for b in sorted(wanted)]
        else:
            folders = [f"load={self.loads[name]}"] if name in self.loads else []
        schema = WAREHOUSE_TABLES[name]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{name}/{f}" for f in folders))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in WAREHOUSE_TABLES}


def bucket_of(listing_id: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(listing_id).cast("bigint")), F.lit(buckets)).cast("int")


def buckets_for(n_facts: int, now: int = 0) -> int:
    """As many buckets as ``n_facts`` rows need; those there are ``now`` will do until they are half too full."""
    needed = max(1, -(-n_facts // ROWS_PER_BUCKET))
    return now if needed <= now * 3 // 2 else needed


def _names(spark: SparkSession, path: str):
    """The file system and folder of ``path``, and the names in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, folder, [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def open_warehouse(spark: SparkSession, path: str, schema_version: int = SCHEMA_VERSION) -> Warehouse:
    """The current state; a warehouse of another schema version is taken as empty, and its version goes on."""
    names = [n.removesuffix(".json") for n in _names(spark, f"{path}/versions")[2]]
    version = max((int(n) for n in names if n.isdigit()), default=0)
    if not version:
        return Warehouse(spark, path)
    stated = json.loads(spark.read.text(f"{path}/versions/{version}.json", wholetext=True).first()["value"])
    if stated.pop("schema_version") != schema_version:
        return Warehouse(spark, path, version)
    return Warehouse(spark, path, version, **stated)


def write_table(spark: SparkSession, path: str, load: str, name: str, df: DataFrame, buckets: int = 1) -> dict[str, str]:
    """Write a table with its fixed columns and types; returns the load of each bucket of facts, or of the table."""
    types = spark.createDataFrame([], WAREHOUSE_TABLES[name]).schema.fields
    rows = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in types]).withColumn("load", F.lit(load))
    if name != FACTS:
        rows.write.mode("append").partitionBy("load").parquet(f"{path}/{name}")
        return {name: load}
    rows = rows.withColumn("bucket", bucket_of("listing_id", buckets))
    # A rebalanced partition holds whole buckets, and large ones are split.
    rows.hint("rebalance", "bucket").write.mode("append").partitionBy("load", "bucket").parquet(f"{path}/{name}")
    return {n.removeprefix("bucket="): load for n in _names(spark, f"{path}/{name}/load={load}")[2] if n.startswith("bucket=")}


def new_load() -> str:
    return uuid.uuid4().hex


def point_to(new: Warehouse, schema_version: int = SCHEMA_VERSION) -> Warehouse:
    """Make ``new`` the current state; ``FileExistsError`` if another load has become its version before."""
    fs, folder, _ = _names(new.spark, f"{new.path}/versions")
    path = new.spark._jvm.org.apache.hadoop.fs.Path
    draft, place = path(folder, f"draft-{uuid.uuid4().hex}"), path(folder, f"{new.version}.json")
    stated = {"schema_version": schema_version, "loads": new.loads, "facts": new.facts, "buckets": new.buckets}
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(stated).encode()))
    out.close()
    if fs.exists(place) or not fs.rename(draft, place):
        fs.delete(draft, False)
        raise FileExistsError(f"another load has become version {new.version} of {new.path}")
    return new


def write_all(
    spark: SparkSession, path: str, tables: Mapping[str, DataFrame], schema_version: int = SCHEMA_VERSION
) -> Warehouse:
    """Write a full set of tables as the next version."""
    load, buckets = new_load(), buckets_for(tables[FACTS].count())
    loads = {}
    for name in WAREHOUSE_TABLES:
        if name != FACTS:
            loads |= write_table(spark, path, load, name, tables[name])
    facts = write_table(spark, path, load, FACTS, tables[FACTS], buckets)
    version = open_warehouse(spark, path, schema_version).version + 1
    return point_to(Warehouse(spark, path, version, loads, facts, buckets), schema_version)
