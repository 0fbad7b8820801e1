"""Incremental, idempotent loads of scored batches into the star schema."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.functions.columns import FRAUD_THRESHOLD, date_key, date_parts, dbl, nan_to_null, row_hash
from listingflow.functions.ordering import with_row_index
from listingflow.operators.model import with_clusters
from listingflow.session import materialize
from listingflow.sources.schema import SCHEMA_VERSION, STAGING_COLUMNS, STAGING_TYPES, WAREHOUSE_TABLES
from listingflow.sources.store import (
    FACTS, Warehouse, bucket_of, buckets_for, new_load, open_warehouse, point_to, write_table,
)

# (dimension, its id, its natural key, the staged column)
MEMBER_DIMENSIONS = (
    ("dim_area", "area_id", "area_name", "area"),
    ("dim_property_type", "property_type_id", "property_type", "property_type"),
    ("dim_agent", "agent_id", "agent_name", "agent_name"),
)
DIMENSIONS = ("dim_area", "dim_property_type", "dim_agent", "dim_date")
REQUIRED = ("listing_id", "area", "property_type", "agent_name", "listed_date")
DESCRIPTIVE = (
    "title", "bedrooms", "size_sqft", "furnished", "building_age_years", "floor", "price_aed_month",
    "predicted_price_aed_month", "residual_pct", "lat", "lon", "dup_cluster_id", "is_duplicate", "is_flagged_fraud",
)
KEYS = ("area_id", "property_type_id", "agent_id", "date_id")


@dataclass(frozen=True)
class LoadResult:
    warehouse: Warehouse
    run: dict  # the audit row of this load
    rejects: DataFrame  # staged rows that were not loaded, with copies and a reason


def derive_flags(df: DataFrame, members: DataFrame | None, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """Duplicate flag from the cluster map, fraud flag from the residual (the threshold itself counts)."""
    fraud = F.coalesce(F.col("residual_pct") <= dbl(threshold), F.lit(False))
    return with_clusters(df, members).withColumns({
        "is_duplicate": F.col("dup_cluster_id").isNotNull().cast("int"),
        "is_flagged_fraud": fraud.cast("int"),
    })


def build_staging(df: DataFrame, members: DataFrame | None, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """The batch as it will be loaded: fixed columns and types, flags, NaN as null, and a hash of the row."""
    typed = derive_flags(df, members, threshold)
    staged = nan_to_null(typed.select(*[F.col(c).cast(STAGING_TYPES[c]).alias(c) for c in STAGING_COLUMNS]))
    return staged.withColumn("row_hash", row_hash(STAGING_COLUMNS))


def split_batch(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a written batch: rows without a required key are rejected, and of a repeated id
    all but one.

    Ids are counted first, over one narrow column; only rows of repeated ids are looked at again. Equal rows
    combine before the shuffle, and of different rows with one id the latest is kept (by date, then by hash).
    Rejected rows carry how many ``copies`` of them the batch held.
    """
    columns = staged.columns
    missing = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"{c} missing")) for c in REQUIRED])
    copies = F.count(F.lit(1)).alias("copies")
    rejected = staged.where(missing.isNotNull()).groupBy(*columns).agg(copies).withColumn("reason", missing)
    complete = staged.where(missing.isNull())
    repeated = (
        complete.groupBy("listing_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("listing_id")
    )
    if repeated.isEmpty():
        return complete, rejected
    repeated = materialize(repeated, "repeated-ids")
    versions = materialize(
        complete.join(repeated, "listing_id", "left_semi").groupBy(*columns).agg(copies), "repeated-rows"
    )
    rank = F.struct("listed_date", "row_hash")
    latest = materialize(versions.groupBy("listing_id").agg(F.max(rank).alias("keep")), "latest-rows")
    judged = versions.join(latest, "listing_id").withColumn("kept", rank == F.col("keep"))
    surplus = F.when(F.col("kept"), F.col("copies") - 1).otherwise(F.col("copies"))
    accepted = complete.join(repeated, "listing_id", "left_anti").unionByName(judged.where("kept").select(*columns))
    return accepted, rejected.unionByName(
        judged.withColumn("copies", surplus).where("copies > 0")
        .select(*columns, "copies", F.lit("repeated listing_id").alias("reason"))
    )


def new_members(dims: Mapping[str, DataFrame], staged: DataFrame) -> DataFrame:
    """(dimension, member, nth): natural keys of the batch that no dimension knows yet, numbered per dimension.

    All dimensions are read off in one pass over the batch; the numbering sorts by range, not in one task.
    """
    found = staged.select(F.explode(F.array(
        *[F.struct(F.lit(name).alias("dimension"), F.col(source).alias("member"))
          for name, _, _, source in MEMBER_DIMENSIONS],
        F.struct(F.lit("dim_date").alias("dimension"), F.col("listed_date").cast("string").alias("member")),
    )).alias("m")).select("m.*").where(F.col("member").isNotNull()).distinct()
    known = dims["dim_date"].select(F.lit("dim_date").alias("dimension"), F.col("full_date").cast("string").alias("member"))
    for name, _, key, _ in MEMBER_DIMENSIONS:
        known = known.unionByName(dims[name].select(F.lit(name).alias("dimension"), F.col(key).alias("member")))
    order = [F.col("dimension"), F.col("member")]
    indexed = with_row_index(found.join(known, ["dimension", "member"], "left_anti"), order)
    starts = indexed.groupBy("dimension").agg(F.min("row_index").alias("start"))  # one row per dimension
    return indexed.join(F.broadcast(starts), "dimension").select(
        "dimension", "member", (F.col("row_index") - F.col("start") + 1).alias("nth")
    )


def upsert_dimensions(dims: Mapping[str, DataFrame], staged: DataFrame) -> dict[str, DataFrame]:
    """The dimensions with the batch's new members. Known members keep their ids, new ones follow in key order.

    A date's id is the date as yyyymmdd, so ids order like dates.
    """
    new = new_members(dims, staged)
    grown = {}
    for name, id_column, key, _ in MEMBER_DIMENSIONS:
        last = dims[name].agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("last")).scalar()
        grown[name] = dims[name].unionByName(new.where(F.col("dimension") == name).select(
            (F.col("nth") + last).alias(id_column), F.col("member").alias(key)
        ))
    dates = new.where(F.col("dimension") == "dim_date").select(F.col("member").cast("date").alias("full_date"))
    grown["dim_date"] = dims["dim_date"].unionByName(dates.select(
        date_key("full_date").alias("date_id"), "full_date",
        *[c.alias(n) for n, c in date_parts("full_date").items()],
    ))
    return grown


def resolve_keys(accepted: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Staged rows with dimension ids instead of natural keys. Written dimensions broadcast when they are small."""
    out = accepted.withColumn("date_id", date_key())
    for name, id_column, key, source in MEMBER_DIMENSIONS:
        out = out.join(dims[name].select(F.col(key).alias("_key"), id_column), F.col(source) == F.col("_key"))
        out = out.drop("_key")
    return out.select("listing_id", *KEYS, *DESCRIPTIVE, "row_hash")


def _change(fact: str, staged: str) -> Column:
    """The kind of change for a full outer join of facts and staged rows."""
    f_id, s_id = F.col(f"{fact}.listing_id"), F.col(f"{staged}.listing_id")
    same = (F.col(f"{fact}.row_hash") == F.col(f"{staged}.row_hash")) & (F.col(f"{fact}.is_active") == 1)
    return (
        F.when(f_id.isNull(), "inserted")
        .when(s_id.isNotNull() & same, "unchanged")
        .when(s_id.isNotNull(), "updated")
        .when(F.col(f"{fact}.is_active") == 1, "deactivated")
        .otherwise("absent")
    )


def classify_changes(fact: DataFrame, staged: DataFrame) -> DataFrame:
    """(listing_id, change): inserted, updated (changed or back), unchanged, deactivated, or absent as before."""
    f = fact.select("listing_id", "row_hash", "is_active").alias("f")
    s = staged.select("listing_id", "row_hash").alias("s")
    return f.join(s, F.col("f.listing_id") == F.col("s.listing_id"), "full_outer").select(
        F.coalesce("f.listing_id", "s.listing_id").alias("listing_id"), _change("f", "s").alias("change")
    )


def merge_facts(fact: DataFrame, resolved: DataFrame, now: Column) -> DataFrame:
    """The new facts with the ``change`` each row went through, from one full outer join.

    Inserts, updates and returning rows take the staged values; rows missing from the batch are switched off and
    kept; equal rows keep their values and times.
    """
    joined = fact.alias("f").join(resolved.alias("s"), F.col("f.listing_id") == F.col("s.listing_id"), "full_outer")
    changed = joined.withColumn("change", _change("f", "s"))
    take = F.col("change").isin("inserted", "updated")
    touched = F.col("change").isin("inserted", "updated", "deactivated")
    columns = [F.coalesce("f.listing_id", "s.listing_id").alias("listing_id")]
    columns += [F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"f.{c}")).alias(c)
                for c in (*KEYS, *DESCRIPTIVE, "row_hash")]
    columns += [
        F.when(take, 1).when(F.col("change") == "deactivated", 0).otherwise(F.col("f.is_active")).alias("is_active"),
        F.when(F.col("change") == "inserted", now).otherwise(F.col("f.first_loaded_at")).alias("first_loaded_at"),
        F.when(touched, now).otherwise(F.col("f.last_updated_at")).alias("last_updated_at"),
    ]
    return changed.select(*columns, "change")


def _utc(moment: datetime) -> Column:
    return F.lit(moment.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S") + "Z").cast("timestamp")


def audit_run(runs: DataFrame, run: Mapping[str, int], started: datetime, finished: datetime) -> tuple[DataFrame, dict]:
    """The audit log with one row more, and that row's counts."""
    spark = runs.sparkSession
    last = runs.agg(F.coalesce(F.max("run_id"), F.lit(0)).alias("last")).first()["last"]
    counts = ["rows_in_batch", "rows_inserted", "rows_updated", "rows_unchanged", "rows_deactivated", "rows_rejected"]
    row = spark.range(1).select(
        F.lit(last + 1).cast("bigint").alias("run_id"),
        _utc(started).alias("started_at"), _utc(finished).alias("finished_at"),
        *[F.lit(int(run[c])).cast("bigint").alias(c) for c in counts],
    )
    return runs.unionByName(row), {"run_id": last + 1, **{c: int(run[c]) for c in counts}}


def load_batch(
    spark: SparkSession, path: str, scored: DataFrame, members: DataFrame | None,
    threshold: float = FRAUD_THRESHOLD, now: datetime | None = None, schema_version: int = SCHEMA_VERSION,
) -> LoadResult:
    """Load one batch: what it changes, then the pointer. A load that another one overtook fails at its pointer.

    Changes are found on ids, hashes and states alone. Only the fact buckets in which something changed are read
    whole, merged and written; an unchanged batch writes no fact at all. Facts that have outgrown their buckets are
    dealt out anew.
    """
    started = (now or datetime.now(timezone.utc)).replace(microsecond=0)
    old, load = open_warehouse(spark, path, schema_version), new_load()

    accepted, rejected = split_batch(materialize(build_staging(scored, members, threshold), "staging"))
    rejected = materialize(rejected, "rejected")

    grown = upsert_dimensions({name: old.table(name) for name in DIMENSIONS}, accepted)
    with ThreadPoolExecutor(len(grown)) as pool:  # independent small writes
        written = pool.map(lambda name: write_table(spark, path, load, name, grown[name]), grown)
    loads = {name: by for part in written for name, by in part.items()}
    dims = {name: Warehouse(spark, path, loads=loads).table(name) for name in grown}

    # At most one row per bucket and kind of change.
    changes = classify_changes(old.table(FACTS), accepted).groupBy(
        bucket_of("listing_id", old.buckets).alias("bucket"), "change"
    ).count().collect()
    counts = {f"rows_{kind}": sum(r["count"] for r in changes if r["change"] == kind)
              for kind in ("inserted", "updated", "unchanged", "deactivated")}
    buckets = buckets_for(sum(r["count"] for r in changes), old.buckets)
    touched = sorted({r["bucket"] for r in changes if r["change"] in ("inserted", "updated", "deactivated")})
    facts = old.facts
    if buckets != old.buckets:
        merged = merge_facts(old.table(FACTS), resolve_keys(accepted, dims), _utc(started))
        facts = write_table(spark, path, load, FACTS, merged, buckets)
    elif touched:
        arriving = accepted.where(bucket_of("listing_id", buckets).isin(touched)) if len(touched) < buckets else accepted
        merged = merge_facts(old.table(FACTS, touched), resolve_keys(arriving, dims), _utc(started))
        facts = {**old.facts, **write_table(spark, path, load, FACTS, merged, buckets)}

    loaded = sum(counts[f"rows_{kind}"] for kind in ("inserted", "updated", "unchanged"))
    lost = rejected.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"]
    run = {**counts, "rows_in_batch": loaded + lost, "rows_rejected": lost}
    finished = now or datetime.now(timezone.utc)
    runs, row = audit_run(old.table("etl_runs"), run, started, finished)
    loads |= write_table(spark, path, load, "etl_runs", runs)
    current = Warehouse(spark, path, old.version + 1, loads, facts, buckets)
    return LoadResult(point_to(current, schema_version), row, rejected)


def table_counts(warehouse: Warehouse) -> DataFrame:
    """(table, n) for the six tables."""
    parts = [
        warehouse.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name in WAREHOUSE_TABLES
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
