-- Per property type: mean absolute and mean signed residual in percent and mean absolute difference of price and
-- prediction, over active rows without a flag.
WITH per_type AS (
  SELECT property_type_id,
         COUNT(*) AS listings,
         AVG(ABS(residual_pct)) AS gap,
         AVG(residual_pct) AS bias,
         AVG(ABS(price_aed_month - predicted_price_aed_month)) AS mae
  FROM {fact_listings}
  WHERE is_active = 1 AND is_flagged_fraud = 0
  GROUP BY property_type_id)
SELECT t.property_type,
       p.listings,
       ROUND(p.gap * 100, 1) AS avg_abs_gap_pct,
       ROUND(p.bias * 100, 1) AS bias_pct,
       ROUND(p.mae, 0) AS mae_aed
FROM per_type p
JOIN {dim_property_type} t ON t.property_type_id = p.property_type_id
ORDER BY avg_abs_gap_pct DESC, property_type
