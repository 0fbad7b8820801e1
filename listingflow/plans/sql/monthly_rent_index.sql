-- Price per sqft of newly posted units by month, with the change to the month before in percent. Flagged rows
-- are left out first, then each unit counts in the month of its earliest remaining posting.
WITH earliest AS (
  SELECT date_id, price_aed_month, size_sqft
  FROM {fact_listings}
  WHERE is_active = 1 AND is_flagged_fraud = 0 AND dup_cluster_id IS NULL
  UNION ALL
  SELECT date_id, price_aed_month, size_sqft
  FROM (
    SELECT date_id, price_aed_month, size_sqft,
           ROW_NUMBER() OVER (PARTITION BY dup_cluster_id ORDER BY date_id, listing_id) AS nth_posting
    FROM {fact_listings}
    WHERE is_active = 1 AND is_flagged_fraud = 0 AND dup_cluster_id IS NOT NULL)
  WHERE nth_posting = 1),
monthly AS (
  SELECT d.year, d.month,
         COUNT(*) AS new_units,
         AVG(e.price_aed_month * CAST(12 AS DOUBLE) / NULLIF(e.size_sqft, 0)) AS psf
  FROM earliest e
  JOIN {dim_date} d ON d.date_id = e.date_id
  GROUP BY d.year, d.month),
compared AS (
  SELECT year, month, new_units, psf, LAG(psf) OVER (ORDER BY year, month) AS before
  FROM monthly)
SELECT FORMAT_STRING('%04d-%02d', year, month) AS month,
       new_units,
       ROUND(psf, 1) AS avg_price_per_sqft_annual,
       ROUND(100 * (psf - before) / NULLIF(before, 0), 1) AS mom_change_pct
FROM compared
ORDER BY month
