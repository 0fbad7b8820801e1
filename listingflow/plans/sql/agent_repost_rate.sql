-- Per agent: active rows, those beyond the first posting of a cluster, their share in percent, and flagged rows.
-- Reposts are counted as all active rows less first postings, so no cluster has to be numbered row by row.
WITH firsts AS (
  SELECT agent_id, COUNT(*) AS first_postings
  FROM (
    SELECT MIN_BY(agent_id, STRUCT(date_id, listing_id)) AS agent_id
    FROM {fact_listings}
    WHERE is_active = 1 AND dup_cluster_id IS NOT NULL
    GROUP BY dup_cluster_id)
  GROUP BY agent_id),
per_agent AS (
  SELECT agent_id,
         COUNT(*) AS listings,
         COUNT(dup_cluster_id) AS clustered,
         SUM(is_flagged_fraud) AS flagged_fraud
  FROM {fact_listings}
  WHERE is_active = 1
  GROUP BY agent_id),
counted AS (
  SELECT p.agent_id, p.listings, p.clustered - COALESCE(f.first_postings, 0) AS reposts, p.flagged_fraud
  FROM per_agent p
  LEFT JOIN firsts f ON f.agent_id = p.agent_id)
SELECT g.agent_name AS agent,
       c.listings,
       c.reposts,
       ROUND(CAST(100 AS DOUBLE) * c.reposts / c.listings, 1) AS repost_rate_pct,
       c.flagged_fraud
FROM counted c
JOIN {dim_agent} g ON g.agent_id = c.agent_id
ORDER BY repost_rate_pct DESC, listings DESC, agent
