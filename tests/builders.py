"""Hand-made rows for the tests."""

from __future__ import annotations

import datetime as dt

from listingflow.sources.schema import LISTING_SCHEMA, STAGING_TYPES

SCORED_COLUMNS = [c for c in STAGING_TYPES if c not in ("dup_cluster_id", "is_duplicate", "is_flagged_fraud")]
SCORED_SCHEMA = ", ".join(f"{c} {STAGING_TYPES[c]}" for c in SCORED_COLUMNS)


def listing(listing_id, **overrides):
    row = {
        "listing_id": listing_id, "dup_group_truth": listing_id, "is_suspicious_truth": 0, "status": "active",
        "area": "Harbour East", "property_type": "Flat", "bedrooms": 1, "lat": 41.39, "lon": 2.154,
        "price_aed_month": 6000, "size_sqft": 600, "floor": 3, "furnished": 0, "building_age_years": 21,
        "title": "Corner flat by the ferry pier", "description": "Quiet street, lift, cellar and a south kitchen.",
        "agent_name": "Agency Nord", "listed_date": dt.date(2025, 11, 3),
    }
    return {**row, **overrides}


def listings(spark, *rows):
    names = [f.split()[0] for f in LISTING_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], LISTING_SCHEMA)


def scored_row(listing_id, **overrides):
    row = {
        **{c: listing(listing_id)[c] for c in SCORED_COLUMNS if c not in ("predicted_price_aed_month", "residual_pct")},
        "title": f"unit no. {listing_id}", "predicted_price_aed_month": 6000.0, "residual_pct": 0.0,
    }
    return {**row, **overrides}


def scored(spark, *rows):
    return spark.createDataFrame([tuple(r[n] for n in SCORED_COLUMNS) for r in rows], SCORED_SCHEMA)


def members(spark, mapping):
    return spark.createDataFrame(list(mapping.items()), "listing_id bigint, dup_cluster_id string")
