"""Schemas of the raw batch and the warehouse. Names and types of columns are fixed values: the data contract."""

from __future__ import annotations

# Fixed values.
LISTING_SCHEMA = (
    "listing_id bigint, title string, description string, property_type string, area string, lat double, "
    "lon double, bedrooms int, size_sqft int, furnished int, building_age_years int, floor int, "
    "price_aed_month int, agent_name string, listed_date date, status string, is_suspicious_truth int, "
    "dup_group_truth bigint"
)

# Columns of a staged batch, in the order in which they are hashed.
STAGING_COLUMNS = (
    "listing_id", "area", "property_type", "agent_name", "listed_date", "title", "bedrooms", "size_sqft",
    "furnished", "building_age_years", "floor", "price_aed_month", "predicted_price_aed_month", "residual_pct",
    "lat", "lon", "dup_cluster_id", "is_duplicate", "is_flagged_fraud",
)

STAGING_TYPES = {
    "listing_id": "bigint", "area": "string", "property_type": "string", "agent_name": "string",
    "listed_date": "date", "title": "string", "bedrooms": "int", "size_sqft": "int", "furnished": "int",
    "building_age_years": "int", "floor": "int", "price_aed_month": "int", "predicted_price_aed_month": "double",
    "residual_pct": "double", "lat": "double", "lon": "double", "dup_cluster_id": "string", "is_duplicate": "int",
    "is_flagged_fraud": "int",
}

# Names the layout below in each commit. Readers take commits of another layout for none at all.
SCHEMA_VERSION = 3

# Fixed values.
WAREHOUSE_TABLES = {
    "fact_listings": (
        "listing_id bigint, area_id bigint, property_type_id bigint, agent_id bigint, date_id int, title string, "
        "bedrooms int, size_sqft int, furnished int, building_age_years int, floor int, price_aed_month int, "
        "predicted_price_aed_month double, residual_pct double, lat double, lon double, dup_cluster_id string, "
        "is_duplicate int, is_flagged_fraud int, is_active int, row_hash string, first_loaded_at timestamp, "
        "last_updated_at timestamp"
    ),
    "dim_area": "area_id bigint, area_name string",
    "dim_property_type": "property_type_id bigint, property_type string",
    "dim_agent": "agent_id bigint, agent_name string",
    "dim_date": "date_id int, full_date date, year int, month int, day int",
    "etl_runs": (
        "run_id bigint, started_at timestamp, finished_at timestamp, rows_in_batch bigint, rows_inserted bigint, "
        "rows_updated bigint, rows_unchanged bigint, rows_deactivated bigint, rows_rejected bigint"
    ),
}
