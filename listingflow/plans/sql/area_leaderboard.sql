-- Average annual price per sqft by area. A unit counts once, by its earliest posting, and a flagged earliest
-- posting leaves the unit out of the average. Only clustered rows are ranked: any other row is its own unit.
WITH earliest AS (
  SELECT area_id, price_aed_month, size_sqft, is_flagged_fraud
  FROM {fact_listings}
  WHERE is_active = 1 AND dup_cluster_id IS NULL
  UNION ALL
  SELECT area_id, price_aed_month, size_sqft, is_flagged_fraud
  FROM (
    SELECT area_id, price_aed_month, size_sqft, is_flagged_fraud,
           ROW_NUMBER() OVER (PARTITION BY dup_cluster_id ORDER BY date_id, listing_id) AS nth_posting
    FROM {fact_listings}
    WHERE is_active = 1 AND dup_cluster_id IS NOT NULL)
  WHERE nth_posting = 1),
per_area AS (
  SELECT area_id,
         AVG(CASE WHEN is_flagged_fraud = 0
                  THEN price_aed_month * CAST(12 AS DOUBLE) / NULLIF(size_sqft, 0) END) AS psf,
         COUNT_IF(is_flagged_fraud = 0) AS clean_units,
         SUM(is_flagged_fraud) AS flagged_fraud
  FROM earliest
  GROUP BY area_id)
SELECT a.area_name AS area,
       ROUND(p.psf, 1) AS avg_price_per_sqft_annual,
       p.clean_units,
       p.flagged_fraud
FROM per_area p
JOIN {dim_area} a ON a.area_id = p.area_id
ORDER BY avg_price_per_sqft_annual DESC, area
