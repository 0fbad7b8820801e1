"""The driver's tables seen as listings, and the side tables the registered queries bind to.

The SQL here runs unchanged in Spark SQL and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LISTINGS_SQL = """
WITH k AS (
  SELECT o_orderkey AS k, o_custkey, CAST(o_orderdate AS DATE) AS odate,
         CASE WHEN o_orderkey > 1 AND o_orderkey % 35 = 1 THEN o_orderkey - 2
              WHEN o_orderkey > 0 AND o_orderkey % 7 = 0 THEN o_orderkey - 1
              ELSE o_orderkey END AS unit,
         (SELECT COUNT(*) FROM {part}) AS n_parts
  FROM {orders}),
u AS (
  SELECT k.k, k.o_custkey, k.unit, base.o_orderdate AS udate, n.n_name, n.n_nationkey AS a,
         p.p_name, p.p_type, p.p_partkey % 6 AS t,
         k.unit <> k.k AS repost
  FROM k
  JOIN {orders} base ON base.o_orderkey = k.unit
  JOIN {nation} n ON n.n_nationkey = (k.unit * 11) % 25
  JOIN {part} p ON p.p_partkey = (k.unit * 17) % k.n_parts),
s AS (
  SELECT u.*, 400 + t * 450 + (unit * 7919) % 300 AS size0,
         0.85 + ((unit * 104729) % 36) / 100.0 AS noise
  FROM u),
b AS (
  SELECT s.*, ROUND((48 + a * 5) * size0 * noise / 12.0 / 250.0) * 250.0 AS price0
  FROM s)
SELECT k AS listing_id,
       CONCAT(CASE WHEN repost THEN 'Hot Deal - ' ELSE 'Spacious ' END, p_name, ' type', CAST(t AS VARCHAR(4)), ' in ', n_name) AS title,
       CONCAT('bright unit ', p_name, ' code', CAST((unit * 31) % 10 AS VARCHAR(4)), CASE WHEN repost THEN ' covered parking included' ELSE ' balcony with community view' END) AS description,
       CONCAT('type', CAST(t AS VARCHAR(4))) AS property_type,
       n_name AS area,
       CAST(ROUND(25.0 + a * 0.2 + ((unit * 6151) % 1501 - 750) / 10000.0 + CASE WHEN repost THEN ((k * 17) % 21 - 10) / 10000.0 ELSE 0.0 END, 5) AS DOUBLE) AS lat,
       CAST(ROUND(55.0 + a * 0.2 + ((unit * 3571) % 1499 - 749) / 10000.0 + CASE WHEN repost THEN ((k * 13) % 21 - 10) / 10000.0 ELSE 0.0 END, 5) AS DOUBLE) AS lon,
       CAST(t + unit % 2 AS INT) AS bedrooms,
       CAST(size0 + CASE WHEN repost THEN (k % 3 - 1) * 5 ELSE 0 END AS INT) AS size_sqft,
       CAST(unit % 5 = 0 AS INT) AS furnished,
       CAST((unit * 13) % 23 AS INT) AS building_age_years,
       CAST(CASE WHEN t < 4 THEN 1 + (unit * 29) % 42 ELSE 0 END AS INT) AS floor,
       CAST(CASE WHEN NOT repost AND k % 33 = 5 THEN FLOOR(price0 * (35 + k % 21) / 100.0)
                 WHEN repost THEN ROUND(price0 * (100 + (k * 31) % 13 - 6) / 100.0 / 50.0) * 50.0
                 ELSE price0 END AS INT) AS price_aed_month,
       CONCAT('Agent ', CAST(o_custkey % 15 AS VARCHAR(4))) AS agent_name,
       CAST(udate AS DATE) + CASE WHEN repost THEN CAST(2 + k % 20 AS INT) ELSE 0 END AS listed_date,
       CAST(NOT repost AND k % 33 = 5 AS INT) AS is_suspicious_truth,
       unit AS dup_group_truth
FROM b
"""

# The same listings, made hard for duplicate detection: a third at the place of their block, prices and sizes on a
# coarse grid, long texts, copies, listings without a place, prices and sizes of 0 or null.
CROWDED_SQL = """
SELECT listing_id, property_type, area, bedrooms, furnished, building_age_years, floor, agent_name, listed_date,
       is_suspicious_truth, dup_group_truth,
       CASE WHEN listing_id % 4 = 1 THEN title
            ELSE CONCAT(title, ' ', description, ' lot', CAST(listing_id % 9 AS VARCHAR(4)), ' by ', agent_name) END AS title,
       CASE WHEN listing_id % 29 = 3 THEN NULL
            WHEN listing_id % 5 = 2 THEN description
            ELSE CONCAT(description, ' viewing', CAST(listing_id % 7 AS VARCHAR(4)), ' garden', CAST(listing_id % 3 AS VARCHAR(4))) END AS description,
       CASE WHEN listing_id % 31 = 4 THEN NULL WHEN listing_id % 3 = 0 THEN CAST(bedrooms AS DOUBLE) ELSE lat END AS lat,
       CASE WHEN listing_id % 37 = 5 THEN NULL WHEN listing_id % 3 = 0 THEN CAST(floor % 2 AS DOUBLE) * 0.0001 ELSE lon END AS lon,
       CASE WHEN listing_id % 41 = 6 THEN NULL WHEN listing_id % 19 = 7 THEN 0
            ELSE CAST(FLOOR(price_aed_month / 1500.0) * 1500 + 1500 AS INT) END AS price_aed_month,
       CASE WHEN listing_id % 43 = 8 THEN NULL WHEN listing_id % 47 = 9 THEN 0
            ELSE CAST(FLOOR(size_sqft / 120.0) * 120 + 120 AS INT) END AS size_sqft
FROM {listings}
"""

SCORED_SQL = """
SELECT x.*, ROUND(x.price_aed_month / x.predicted_price_aed_month - 1.0, 4) AS residual_pct
FROM (
  SELECT l.*, CAST(ROUND((48 + n.n_nationkey * 5) * l.size_sqft * 1.025 / 12.0) AS DOUBLE) AS predicted_price_aed_month,
         CASE WHEN COUNT(*) OVER (PARTITION BY l.dup_group_truth) > 1
              THEN CONCAT('cluster_', CAST(l.dup_group_truth AS VARCHAR(20))) END AS dup_cluster_id
  FROM {listings} l JOIN {nation} n ON n.n_name = l.area) x
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, nation, part = (table(spark, sf_dir, t) for t in ("orders", "nation", "part"))
    return spark.sql(LISTINGS_SQL, orders=orders, nation=nation, part=part)


def crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CROWDED_SQL, listings=listings(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCORED_SQL, listings=listings(spark, sf_dir), nation=table(spark, sf_dir, "nation"))
