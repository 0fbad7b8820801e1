"""DuckDB SQL for the registered queries, written from the definitions rather than from the Spark plans.

Duplicate detection compares every two listings of a block here, and pairs of groups are formed and counted one by
one, so the folded and counted Spark forms are checked against the plain ones.
"""

from __future__ import annotations

from listingflow.fixtures import CROWDED_SQL, LISTINGS_SQL, SCORED_SQL
from listingflow.functions.text import ENGLISH_STOP_WORDS
from listingflow.sources.schema import STAGING_COLUMNS, STAGING_TYPES

_LISTINGS = "listings AS (" + LISTINGS_SQL.format(orders="orders", nation="nation", part="part") + ")"
_SCORED = "scored AS (" + SCORED_SQL.format(listings="listings", nation="nation") + ")"

_STOP = ", ".join("('" + w.replace("'", "''") + "')" for w in ENGLISH_STOP_WORDS)
_TEXT = "COALESCE(title, '') || ' ' || COALESCE(description, '')"


def _distance(a: str, b: str, per_degree: str = "111000.0") -> str:
    """Distance of two aliased places; each alias names lat and lon."""
    north = f"({a}lat - {b}lat) * CAST({per_degree} AS DOUBLE)"
    east = (f"({a}lon - {b}lon) * CAST({per_degree} AS DOUBLE) * "
            f"COS(RADIANS(({a}lat + {b}lat) / CAST(2 AS DOUBLE)))")
    return f"SQRT(POW({north}, 2) + POW({east}, 2))"


def _ratio(a: str, b: str) -> str:
    either = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN NULLIF(CAST(GREATEST({a}, {b}) AS DOUBLE), 0) END"
    return f"(1 - CASE WHEN ABS({a} - {b}) / {either} > 1 THEN CAST(1 AS DOUBLE) ELSE ABS({a} - {b}) / {either} END)"


_PSIM = _ratio("a.price_aed_month", "b.price_aed_month")
_SSIM = _ratio("a.size_sqft", "b.size_sqft")


def _pairs(*gates: str) -> str:
    conditions = "".join(f"\n   AND {g}" for g in gates)
    return f"""
  SELECT a.listing_id AS id_a, b.listing_id AS id_b, {_PSIM} AS psim, {_SSIM} AS ssim
  FROM listings a
  JOIN listings b ON a.area = b.area AND a.property_type = b.property_type AND a.bedrooms = b.bedrooms
   AND a.listing_id < b.listing_id{conditions}"""


_GEO = _distance("a.", "b.") + " <= CAST(300 AS DOUBLE)"
_PRICE = f"{_PSIM} >= CAST(0.9 AS DOUBLE)"
_SIZE = f"{_SSIM} >= CAST(0.95 AS DOUBLE)"

_GATED = f"gated AS ({_pairs(_GEO, _PRICE, _SIZE)})"


def _weights(table: str, key: str, block: str, text: str) -> str:
    """CTE ``weights``: block-local TF-IDF weights of the texts of a table."""
    return f"""
stop_words(w) AS (VALUES {_STOP}),
tokens AS (
  SELECT {key}, {block}, UNNEST(regexp_extract_all(LOWER({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS token
  FROM {table}),
tf AS (
  SELECT {key}, {block}, token, COUNT(*) AS tf
  FROM tokens WHERE token NOT IN (SELECT w FROM stop_words) GROUP BY ALL),
dfs AS (SELECT {block}, token, COUNT(*) AS df FROM tf GROUP BY ALL),
docs AS (SELECT {block}, COUNT(*) AS n FROM {table} GROUP BY ALL),
raw_weights AS (
  SELECT {key}, token,
         tf * (LN((CAST(1 AS DOUBLE) + n) / (CAST(1 AS DOUBLE) + df)) + CAST(1 AS DOUBLE)) AS w
  FROM tf JOIN dfs USING ({block}, token) JOIN docs USING ({block})),
weights AS (SELECT {key}, token, w / SQRT(SUM(w * w) OVER (PARTITION BY {key})) AS weight FROM raw_weights)"""


_WEIGHTS = _weights("listings", "listing_id", "area, property_type, bedrooms", _TEXT)
_SCORED_PAIRS = f"""
{_WEIGHTS},
dots AS (
  SELECT g.id_a, g.id_b, SUM(x.weight * y.weight) AS dot
  FROM gated g
  JOIN weights x ON x.listing_id = g.id_a
  JOIN weights y ON y.listing_id = g.id_b AND y.token = x.token
  GROUP BY g.id_a, g.id_b),
likened AS (
  SELECT g.*, COALESCE(d.dot, CAST(0 AS DOUBLE)) AS tsim
  FROM gated g LEFT JOIN dots d ON d.id_a = g.id_a AND d.id_b = g.id_b),
matched AS (
  SELECT id_a, id_b, score FROM (
    SELECT id_a, id_b, CAST(0.45 AS DOUBLE) * tsim + CAST(0.30 AS DOUBLE) * psim + CAST(0.25 AS DOUBLE) * ssim AS score
    FROM likened)
  WHERE score >= CAST(0.55 AS DOUBLE))"""
_SIMILAR = f"{_GATED},{_SCORED_PAIRS}"


def _components(edges: str) -> str:
    return f"""
links(x, y) AS (SELECT id_a, id_b FROM {edges} UNION SELECT id_b, id_a FROM {edges}),
reach(id, low) AS (
  SELECT x, x FROM links
  UNION
  SELECT l.y, r.low FROM reach r JOIN links l ON l.x = r.id),
components AS (SELECT id, MIN(low) AS component FROM reach GROUP BY id)"""


_MEMBERS = f"""{_components("matched")},
members AS (SELECT id AS listing_id, 'cluster_' || CAST(component AS VARCHAR) AS dup_cluster_id FROM components)"""
_CLUSTERS = f"""{_SIMILAR},
{_MEMBERS},
clusters AS (
  SELECT dup_cluster_id AS cluster_id, COUNT(*) AS n_members, MIN(listing_id) AS first_id, MAX(listing_id) AS last_id
  FROM members GROUP BY dup_cluster_id)"""

_AREAS = """
areas AS (SELECT area, ROUND(AVG(lat), 4) AS lat, ROUND(AVG(lon), 4) AS lon FROM listings GROUP BY area)"""
_TYPES = """
types AS (
  SELECT property_type, CAST(round_even((MIN(bedrooms) + MAX(bedrooms)) / 2.0, 0) AS INT) AS default_bedrooms,
         MIN(size_sqft) AS min_size, MAX(size_sqft) AS max_size, MAX(CAST(floor > 0 AS INT)) AS is_tower
  FROM listings GROUP BY property_type)"""
_GRID = f"""{_AREAS}, {_TYPES},
grid AS (
  SELECT a.area, a.lat, a.lon, t.property_type, t.default_bedrooms AS bedrooms,
         CAST(ROUND(t.min_size + s.i * (t.max_size - t.min_size) / 5.0) AS INT) AS size_sqft,
         8 AS building_age_years, CASE WHEN t.is_tower = 1 THEN 15 ELSE 0 END AS floor, f.furnished
  FROM areas a, types t, (VALUES (0), (1), (2), (3), (4), (5)) s(i), (VALUES (0), (1)) f(furnished))"""

_REQUESTS = """
asked AS (
  SELECT listing_id, CASE WHEN agent_name = 'Agent 5' THEN 'Atlantis' ELSE area END AS area, property_type,
         CAST(size_sqft AS DOUBLE) AS size_sqft,
         CASE WHEN furnished = 0 THEN bedrooms END AS bedrooms, furnished,
         CASE WHEN building_age_years >= 6 THEN floor END AS floor,
         CAST(price_aed_month AS DOUBLE) AS price_aed_month, predicted_price_aed_month
  FROM scored)"""

_STAGED_VALUES = ("area, property_type, agent_name, listed_date, title, bedrooms, size_sqft, furnished, "
                  "building_age_years, floor, price_aed_month, predicted_price_aed_month, residual_pct, lat, lon, "
                  "dup_cluster_id")
_BATCHES = """
batch1 AS (SELECT * FROM scored WHERE listed_date < DATE '1999-01-01'),
batch2 AS (
  SELECT * REPLACE (CAST(CASE WHEN area = 'NATION_7' THEN price_aed_month - 500 ELSE price_aed_month END AS INT)
                    AS price_aed_month)
  FROM scored WHERE agent_name <> 'Agent 3'),
batch3 AS (SELECT * FROM scored)"""


def _merge(n: int, old: str, batch: str, day: str) -> str:
    """CTE ``fact{n}``: the table ``old`` after ``batch`` was loaded on ``day``; rows are compared value by value."""
    values = [v.strip() for v in _STAGED_VALUES.split(",")]
    same = " AND ".join(f"f.{v} IS NOT DISTINCT FROM s.{v}" for v in values)
    picked = ",\n         ".join(f"CASE WHEN change IN ('inserted', 'updated') THEN s_{v} ELSE f_{v} END AS {v}"
                                 for v in values)
    both = ", ".join(f"f.{v} AS f_{v}, s.{v} AS s_{v}" for v in values)
    return f"""
merge{n} AS (
  SELECT f.listing_id AS f_id, s.listing_id AS s_id, {both},
         f.is_active AS f_active, f.first_loaded AS f_first, f.last_updated AS f_last,
         CASE WHEN f.listing_id IS NULL THEN 'inserted'
              WHEN s.listing_id IS NOT NULL AND f.is_active = 1 AND {same} THEN 'unchanged'
              WHEN s.listing_id IS NOT NULL THEN 'updated'
              WHEN f.is_active = 1 THEN 'deactivated' ELSE 'absent' END AS change
  FROM {old} f FULL OUTER JOIN {batch} s ON s.listing_id = f.listing_id),
fact{n} AS (
  SELECT COALESCE(f_id, s_id) AS listing_id,
         {picked},
         CASE WHEN change IN ('inserted', 'updated') THEN 1 WHEN change = 'deactivated' THEN 0 ELSE f_active END
           AS is_active,
         CASE WHEN change = 'inserted' THEN '{day}' ELSE f_first END AS first_loaded,
         CASE WHEN change IN ('inserted', 'updated', 'deactivated') THEN '{day}' ELSE f_last END AS last_updated
  FROM merge{n})"""


_EMPTY = """
fact0 AS (
  SELECT listing_id, """ + _STAGED_VALUES + """, 1 AS is_active, '' AS first_loaded, '' AS last_updated
  FROM scored WHERE 1 = 0)"""
_LOADS = ",".join([
    _BATCHES, _EMPTY, _merge(1, "fact0", "batch1", "2026-01-01"), _merge(2, "fact1", "batch2", "2026-01-02"),
    _merge(3, "fact2", "batch3", "2026-01-03"), _merge(4, "fact3", "batch3", "2026-01-04"),
])

_FACT_COLUMNS = """
SELECT listing_id, area, property_type, agent_name, CAST(listed_date AS VARCHAR) AS listed_date, price_aed_month,
       ROUND(residual_pct, 4) AS residual_pct, COALESCE(dup_cluster_id, '') AS dup_cluster_id,
       CAST(dup_cluster_id IS NOT NULL AS INT) AS is_duplicate,
       CAST(COALESCE(residual_pct <= CAST(-0.30 AS DOUBLE), FALSE) AS INT) AS is_flagged_fraud,
       is_active, first_loaded, last_updated
FROM """

_NTH = """
nth AS (
  SELECT *, CAST(residual_pct <= CAST(-0.30 AS DOUBLE) AS INT) AS flagged,
         ROW_NUMBER() OVER (PARTITION BY COALESCE(dup_cluster_id, 'L' || CAST(listing_id AS VARCHAR))
                            ORDER BY listed_date, listing_id) AS nth_posting
  FROM scored)"""

_PSF = "price_aed_month * CAST(12 AS DOUBLE) / NULLIF(size_sqft, 0)"


def _prf(tp: str, fp: str, fn: str) -> str:
    """Precision, recall and F1 columns from three count expressions."""
    p = f"CASE WHEN {tp} + {fp} > 0 THEN {tp} / CAST({tp} + {fp} AS DOUBLE) ELSE 0 END"
    r = f"CASE WHEN {tp} + {fn} > 0 THEN {tp} / CAST({tp} + {fn} AS DOUBLE) ELSE 0 END"
    return (f"ROUND({p}, 4) AS precision, ROUND({r}, 4) AS recall, "
            f"ROUND(CASE WHEN {tp} > 0 THEN 2 * ({p}) * ({r}) / (({p}) + ({r})) ELSE 0 END, 4) AS f1")


def _flag_counts(flag: str, truth: str) -> str:
    return f"""CAST(SUM({flag}) AS BIGINT) AS flagged,
       COUNT(*) FILTER (WHERE {flag} = 1 AND {truth} = 1) AS tp,
       COUNT(*) FILTER (WHERE {flag} = 1 AND {truth} = 0) AS fp,
       COUNT(*) FILTER (WHERE {flag} = 0 AND {truth} = 1) AS fn"""


_COUNTED = "flagged, tp AS true_positives, fp AS false_positives, fn AS false_negatives"
_NAIVE = """
medians AS (
  SELECT area, property_type, MEDIAN(price_aed_month) AS median FROM listings GROUP BY area, property_type),
naive AS (
  SELECT l.listing_id, CAST(l.price_aed_month < m.median * CAST(0.65 AS DOUBLE) AS INT) AS flag
  FROM listings l JOIN medians m USING (area, property_type))"""

_CLEAN = """
clean AS (
  SELECT *, CAST('0x' || SUBSTR(MD5(CAST(listing_id AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 1000 < 200 AS test
  FROM (
    SELECT s.*, ROW_NUMBER() OVER (PARTITION BY COALESCE(s.dup_cluster_id, 'L' || CAST(s.listing_id AS VARCHAR))
                                   ORDER BY s.listed_date, s.listing_id) AS i
    FROM scored s JOIN naive n USING (listing_id) WHERE n.flag = 0)
  WHERE i = 1)"""

_BUCKET = "CAST('0x' || SUBSTR(MD5({key}), 1, 8) AS BIGINT)"


def _band(col: str) -> str:
    return (f"CASE WHEN {col} <= CAST(-0.30 AS DOUBLE) THEN 'underpriced' "
            f"WHEN {col} >= CAST(0.30 AS DOUBLE) THEN 'overpriced' ELSE 'fair' END")


def _listings(sql: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([_LISTINGS, *ctes]) + "\n" + sql


def _crowded_map(*gates: str) -> str:
    """Clusters of the hard listings from all pairs of a block; a place that is not known rejects no pair."""
    base = "base AS (" + LISTINGS_SQL.format(orders="orders", nation="nation", part="part") + ")"
    hard = "listings AS (" + CROWDED_SQL.format(listings="base") + ")"
    gated = f"gated AS ({_pairs(f'COALESCE({_GEO}, TRUE)', *gates)})"
    return ("WITH RECURSIVE " + ",\n".join([base, hard, gated]) + f",{_SCORED_PAIRS},\n{_MEMBERS}\n"
            "SELECT listing_id, dup_cluster_id FROM members")


def _json(column: str) -> str:
    """A staged value as JSON; doubles as Java prints them."""
    kind = STAGING_TYPES[column]
    if kind == "double":
        small = f"ABS({column}) < 0.001 AND {column} <> 0"
        tiny = f"CAST(CAST(ROUND({column} * 10000) AS INT) AS VARCHAR) || '.0E-4'"
        text = f"CASE WHEN {small} THEN {tiny} ELSE CAST({column} AS VARCHAR) END"
    elif kind in ("string", "date"):
        text = f"'\"' || CAST({column} AS VARCHAR) || '\"'"
    else:
        text = f"CAST({column} AS VARCHAR)"
    return f"'\"{column}\":' || COALESCE({text}, 'null')"


def _scored(sql: str, *ctes: str) -> str:
    return _listings(sql, _SCORED, *ctes)


def oracle_sql() -> dict[str, str]:
    unit = "COALESCE(dup_cluster_id, 'L' || CAST(listing_id AS VARCHAR))"
    return {
        "read_listings": _listings(
            "SELECT * REPLACE (CAST(listed_date AS VARCHAR) AS listed_date), 'active' AS status FROM listings"),
        "build_staging": _scored("""
SELECT listing_id, area, property_type, agent_name, CAST(listed_date AS VARCHAR) AS listed_date, title, bedrooms,
       size_sqft, furnished, building_age_years, floor, price_aed_month, predicted_price_aed_month,
       ROUND(residual_pct, 4) AS residual_pct, lat, lon, COALESCE(dup_cluster_id, '') AS dup_cluster_id,
       CAST(dup_cluster_id IS NOT NULL AS INT) AS is_duplicate,
       CAST(residual_pct <= CAST(-0.30 AS DOUBLE) AS INT) AS is_flagged_fraud
FROM scored"""),
        "warehouse_tables": _scored(_FACT_COLUMNS + "f", """
f AS (SELECT *, 1 AS is_active, '2026-01-01' AS first_loaded, '2026-01-01' AS last_updated FROM scored)"""),
        "write_records": _scored("""
SELECT listing_id, title, area, price_aed_month, ROUND(residual_pct, 4) AS residual_pct
FROM scored WHERE residual_pct <= CAST(-0.30 AS DOUBLE)"""),
        "run_all": _scored("""
SELECT 1 AS position, 'area_leaderboard' AS name, 'Area leaderboard' AS title, COUNT(DISTINCT area) AS n_rows
FROM nth WHERE nth_posting = 1
UNION ALL
SELECT 2, 'monthly_rent_index', 'Monthly rent index', COUNT(DISTINCT STRFTIME(listed_date, '%Y-%m')) FROM (
  SELECT listed_date, ROW_NUMBER() OVER (PARTITION BY """ + unit + """ ORDER BY listed_date, listing_id) AS n
  FROM scored WHERE residual_pct > CAST(-0.30 AS DOUBLE)) WHERE n = 1
UNION ALL
SELECT 3, 'agent_repost_rate', 'Agent repost rate', COUNT(DISTINCT agent_name) FROM scored
UNION ALL
SELECT 4, 'model_error_by_segment', 'Model error by segment', COUNT(DISTINCT property_type)
FROM scored WHERE residual_pct > CAST(-0.30 AS DOUBLE)""", _NTH),

        "listing_text": _listings(f"SELECT listing_id, {_TEXT} AS text FROM listings"),
        "flat_distance": _listings(f"""
SELECT l.listing_id, ROUND({_distance("l.", "f.")}, 2) AS distance_m,
       ROUND({_distance("l.", "f.", "111.0")}, 4) AS distance_km
FROM listings l JOIN listings f ON f.listing_id = l.dup_group_truth"""),
        "distance_to_center_km": _listings(f"""
SELECT listing_id, round_even({_distance("l.", "p.", "111.0")}, 2) AS distance_to_center_km
FROM listings l, (SELECT CAST(25.1972 AS DOUBLE) AS lat, CAST(55.2744 AS DOUBLE) AS lon) p"""),
        "ratio_similarity": _scored(
            f"SELECT listing_id, ROUND({_ratio('price_aed_month', 'predicted_price_aed_month')}, 6) AS similarity "
            "FROM scored"),
        "date_parts": _listings("""
SELECT listing_id, CAST(YEAR(listed_date) AS INT) AS year, CAST(MONTH(listed_date) AS INT) AS month,
       CAST(DAY(listed_date) AS INT) AS day, CAST(STRFTIME(listed_date, '%Y%m%d') AS INT) AS date_id FROM listings"""),
        "month_label": _listings("SELECT listing_id, STRFTIME(listed_date, '%Y-%m') AS month FROM listings"),
        "row_hash": _scored(f"""
SELECT listing_id, SHA1('{{' || {" || ',' || ".join(_json(c) for c in STAGING_COLUMNS)} || '}}') AS row_hash
FROM (SELECT *, CAST(dup_cluster_id IS NOT NULL AS INT) AS is_duplicate,
             CAST(residual_pct <= CAST(-0.30 AS DOUBLE) AS INT) AS is_flagged_fraud FROM scored)"""),
        "derive_flags": _scored("""
SELECT listing_id, COALESCE(dup_cluster_id, '') AS dup_cluster_id,
       CAST(dup_cluster_id IS NOT NULL AS INT) AS is_duplicate,
       CAST(residual_pct <= CAST(-0.30 AS DOUBLE) AS INT) AS is_flagged_fraud FROM scored"""),
        "price_band": _scored(f"SELECT listing_id, {_band('residual_pct')} AS band FROM scored"),
        "annual_price_per_sqft": _listings(f"SELECT listing_id, ROUND({_PSF}, 4) AS psf FROM listings"),
        "project_review_fields": _listings("""
SELECT listing_id, title, area, property_type, bedrooms, size_sqft, price_aed_month, agent_name,
       CAST(listed_date AS VARCHAR) AS listed_date FROM listings"""),
        "add_residuals": _scored("""
SELECT listing_id, round_even(predicted_price_aed_month + CAST(0.25 AS DOUBLE), 0) AS predicted_price_aed_month,
       price_aed_month - predicted_price_aed_month AS residual_aed,
       round_even((price_aed_month - predicted_price_aed_month) / predicted_price_aed_month, 4) AS residual_pct
FROM scored"""),
        "nan_to_null": _listings(
            "SELECT listing_id, CASE WHEN furnished = 1 THEN CAST(-1 AS DOUBLE) ELSE lat END AS lat, lon FROM listings"),
        "unit_key": _scored(f"SELECT listing_id, {unit} AS unit FROM scored"),

        "candidate_pairs": _listings("""
SELECT area, property_type, bedrooms, COUNT(*) AS n_listings, COUNT(*) * (COUNT(*) - 1) // 2 AS n_pairs
FROM listings GROUP BY area, property_type, bedrooms"""),
        **{
            name: _listings(f"""
SELECT id_a, id_b, ROUND(psim, 6) AS price_similarity, ROUND(ssim, 6) AS size_similarity FROM ({_pairs(*gates)})""")
            for name, gates in (("geo_gate", [_GEO]), ("price_gate", [_GEO, _PRICE]),
                                ("size_gate", [_GEO, _PRICE, _SIZE]))
        },
        "block_tfidf": _listings("SELECT listing_id, token, ROUND(weight, 4) AS weight FROM weights", _WEIGHTS),
        "block_tfidf_documents": "WITH " + _weights("documents", "doc_id", "lang", "text") + """
SELECT doc_id, token, ROUND(weight, 4) AS weight FROM weights""",
        "cosine_pairs": _listings(
            "SELECT id_a, id_b, ROUND(tsim, 4) AS text_similarity FROM likened", _SIMILAR),
        "score_pairs": _listings("SELECT id_a, id_b, ROUND(score, 4) AS score FROM matched", _SIMILAR),
        "connected_components": _listings("SELECT id, component FROM components", _CLUSTERS),
        "assign_clusters": _listings("""
SELECT m.listing_id, c.cluster_id, c.n_members, c.first_id, c.last_id
FROM members m JOIN clusters c ON c.cluster_id = m.dup_cluster_id""", _CLUSTERS),
        "find_duplicates_pairs": _listings("SELECT id_a, id_b, ROUND(score, 4) AS score FROM matched", _SIMILAR),
        "crowded_map": _crowded_map(_PRICE, _SIZE),
        "crowded_map_open_price": _crowded_map(_SIZE),
        "find_duplicates_map": _listings("SELECT listing_id, dup_cluster_id FROM members", _CLUSTERS),
        "cluster_review_members": _listings("""
SELECT c.cluster_id, c.n_members, l.listing_id, l.title, l.area, l.price_aed_month, l.size_sqft,
       CAST(l.listed_date AS VARCHAR) AS listed_date
FROM members m JOIN clusters c ON c.cluster_id = m.dup_cluster_id JOIN listings l ON l.listing_id = m.listing_id""",
                                            _CLUSTERS),
        "cluster_review_pairs": _listings("""
SELECT c.cluster_id, c.n_members, p.id_a, p.id_b, ROUND(p.score, 4) AS score
FROM matched p JOIN members m ON m.listing_id = p.id_a JOIN clusters c ON c.cluster_id = m.dup_cluster_id""",
                                          _CLUSTERS),
        "cluster_sample": _listings("""
SELECT s.cluster_id, s.n_members, (SELECT COUNT(*) FROM clusters) AS clusters_total,
       (SELECT COUNT(*) FROM matched p JOIN members q ON q.listing_id = p.id_a
        WHERE q.dup_cluster_id = s.cluster_id) AS n_pairs,
       l.listing_id, l.title, l.price_aed_month
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY n_members ORDER BY first_id) AS i FROM clusters) s
JOIN members m ON m.dup_cluster_id = s.cluster_id JOIN listings l ON l.listing_id = m.listing_id
WHERE (s.n_members = 3 AND s.i <= 12) OR (s.n_members = 2 AND s.i <= 38)""", _CLUSTERS),

        "truth_pairs": _listings("""
SELECT a.dup_group_truth, (SELECT COUNT(*) FROM listings c WHERE c.dup_group_truth = a.dup_group_truth) AS n_members,
       MIN(a.listing_id) AS first_id, MAX(b.listing_id) AS last_id, COUNT(*) AS n_pairs
FROM listings a JOIN listings b ON b.dup_group_truth = a.dup_group_truth AND a.listing_id < b.listing_id
GROUP BY a.dup_group_truth"""),
        "truth_links": _listings("""
SELECT f.first_id AS id_a, l.listing_id AS id_b
FROM listings l JOIN (SELECT dup_group_truth, MIN(listing_id) AS first_id FROM listings GROUP BY dup_group_truth) f
  USING (dup_group_truth)
WHERE l.listing_id > f.first_id"""),
        "cluster_pairs": _listings("""
SELECT a.dup_cluster_id, (SELECT n_members FROM clusters WHERE cluster_id = a.dup_cluster_id) AS n_members,
       MIN(a.listing_id) AS first_id, MAX(b.listing_id) AS last_id, COUNT(*) AS n_pairs
FROM members a JOIN members b ON b.dup_cluster_id = a.dup_cluster_id AND a.listing_id < b.listing_id
GROUP BY a.dup_cluster_id""", _CLUSTERS),
        "pair_metrics": _listings(f"""
SELECT t AS true_pairs, p AS predicted_pairs, tp AS true_positives, p - tp AS false_positives,
       t - tp AS false_negatives, {_prf("tp", "(p - tp)", "(t - tp)")},
       (SELECT COUNT(*) FROM clusters) AS clusters_found, (SELECT COUNT(*) FROM listings) AS listings_scored
FROM (SELECT (SELECT COUNT(*) FROM truth) AS t, (SELECT COUNT(*) FROM predicted) AS p,
             (SELECT COUNT(*) FROM (SELECT * FROM truth INTERSECT SELECT * FROM predicted)) AS tp)""", _CLUSTERS, """
truth AS (
  SELECT a.listing_id AS x, b.listing_id AS y
  FROM listings a JOIN listings b ON b.dup_group_truth = a.dup_group_truth AND a.listing_id < b.listing_id),
predicted AS (
  SELECT a.listing_id AS x, b.listing_id AS y
  FROM members a JOIN members b ON b.dup_cluster_id = a.dup_cluster_id AND a.listing_id < b.listing_id)"""),
        "naive_price_flag": _listings("SELECT listing_id, flag FROM naive", _NAIVE),
        "flag_metrics": _scored(f"""
SELECT {_COUNTED}, {_prf("tp", "fp", "fn")}
FROM (SELECT {_flag_counts("CAST(residual_pct <= CAST(-0.25 AS DOUBLE) AS INT)", "is_suspicious_truth")}
      FROM scored)"""),
        "compare_fraud_methods": _scored(f"""
SELECT method, {_COUNTED}, precision, recall, f1, (SELECT CAST(SUM(is_suspicious_truth) AS BIGINT) FROM scored)
         AS true_suspicious,
       ROUND((SELECT precision FROM both_methods WHERE method = 'model')
             - (SELECT precision FROM both_methods WHERE method = 'naive'), 4) AS precision_gain,
       ROUND((SELECT f1 FROM both_methods WHERE method = 'model')
             - (SELECT f1 FROM both_methods WHERE method = 'naive'), 4) AS f1_gain,
       CAST(-0.30 AS DOUBLE) AS model_threshold
FROM both_methods""", _NAIVE, f"""
both_methods AS (
  SELECT 'naive' AS method, *, {_prf("tp", "fp", "fn")}
  FROM (SELECT {_flag_counts("n.flag", "s.is_suspicious_truth")} FROM scored s JOIN naive n USING (listing_id))
  UNION ALL
  SELECT 'model', *, {_prf("tp", "fp", "fn")}
  FROM (SELECT {_flag_counts("CAST(residual_pct <= CAST(-0.30 AS DOUBLE) AS INT)", "is_suspicious_truth")}
        FROM scored))"""),
        "field_completeness": _listings("\nUNION ALL\n".join(
            f"SELECT '{f}' AS field, ROUND(AVG(CAST({f} IS NOT NULL AS INT)), 4) AS completeness FROM listings"
            for f in ("title", "area", "property_type", "price_aed_month", "size_sqft", "listed_date"))),
        "exact_duplicates": _listings("""
SELECT CAST(SUM(n - 1) AS BIGINT) AS exact_duplicate_rows
FROM (SELECT COUNT(*) AS n FROM listings GROUP BY title, area, price_aed_month)"""),
        "total_rows": _listings("SELECT COUNT(*) AS total_rows FROM listings"),
        "invalid_prices": _listings(
            "SELECT COUNT(*) AS invalid_price_rows FROM listings WHERE price_aed_month - 2000 <= 0"),

        "clean_training_set": _scored(f"""
SELECT listing_id, COALESCE(dup_cluster_id, '') AS dup_cluster_id FROM (
  SELECT s.*, ROW_NUMBER() OVER (PARTITION BY {unit} ORDER BY listed_date, listing_id) AS i
  FROM scored s JOIN naive n USING (listing_id) WHERE n.flag = 0)
WHERE i = 1""", _NAIVE),
        "train_test_split": _listings(f"""
SELECT listing_id, CASE WHEN {_BUCKET.format(key="CAST(listing_id AS VARCHAR) || ':42'")} % 1000 < 200
                        THEN 'test' ELSE 'train' END AS part FROM listings"""),
        "feature_pipeline": _scored(f"""
SELECT l.listing_id, (SELECT CAST(6 + COUNT(DISTINCT s.area) + COUNT(DISTINCT s.property_type) AS INT)
                      FROM scored s JOIN naive n USING (listing_id) WHERE n.flag = 0) AS n_features,
       2 AS n_hot, l.size_sqft
FROM listings l""", _NAIVE),
        "regression_metrics": _scored("""
SELECT ROUND(AVG(ABS(y - p)), 1) AS mae, ROUND(AVG(ABS(y - p) / ABS(y)), 4) AS mape,
       ROUND(1 - SUM((y - p) * (y - p)) / (VAR_POP(y) * COUNT(*)), 4) AS r2, COUNT(*) AS n_test
FROM (SELECT CAST(price_aed_month AS DOUBLE) AS y, predicted_price_aed_month AS p FROM scored)"""),
        "model_identities": _listings("""
SELECT listing_id, price_aed_month, TRUE AS absolute_holds, TRUE AS relative_holds, TRUE AS same_after_reload
FROM listings"""),
        "model_quality": _scored(f"""
SELECT COUNT(*) FILTER (WHERE NOT test) AS n_train, COUNT(*) FILTER (WHERE test) AS n_test, TRUE AS good FROM clean""",
                                 _NAIVE, _CLEAN),
        "heldout_rows": _scored("""
SELECT listing_id, price_aed_month AS actual, area, TRUE AS near FROM clean WHERE test""", _NAIVE, _CLEAN),
        "importance_summary": _listings("""
SELECT COUNT(*) AS n_features, TRUE AS sum_is_one, 'size_sqft' AS first
FROM (VALUES ('area'), ('property_type'), ('bedrooms'), ('size_sqft'), ('building_age_years'), ('floor'),
             ('furnished'), ('distance_to_center_km')) v(f)"""),
        "out_of_fold_units": _scored(f"""
SELECT fold, COUNT(*) AS n_rows, COUNT(DISTINCT unit) AS n_units, CAST(0 AS BIGINT) AS n_elsewhere, TRUE AS good
FROM (SELECT {_BUCKET.format(key=unit)} % 5 AS fold, {unit} AS unit FROM scored) GROUP BY fold"""),
        "grid_prices": _listings(
            "SELECT area, property_type, size_sqft, furnished, TRUE AS priced FROM grid", _GRID),
        "request_identities": _scored("""
SELECT listing_id, TRUE AS flag_holds, TRUE AS suspicion_holds FROM asked WHERE area <> 'Atlantis'""", _REQUESTS),
        "stream_is_batch": _listings("SELECT listing_id, TRUE AS same FROM listings"),
        "group_folds": _scored(f"SELECT listing_id, {_BUCKET.format(key=unit)} % 5 AS fold FROM scored"),
        "grid_points": _listings("SELECT * FROM grid", _GRID),
        "prepare_requests": _scored("""
SELECT listing_id, area, property_type, CASE WHEN reason <> '' THEN COALESCE(size_sqft, -1) ELSE size_sqft END AS size_sqft,
       CASE WHEN reason <> '' THEN -1 ELSE COALESCE(bedrooms, default_bedrooms) END AS bedrooms, furnished,
       CASE WHEN reason <> '' THEN -1 ELSE COALESCE(building_age_years, 8) END AS building_age_years,
       CASE WHEN reason <> '' THEN -1
            ELSE COALESCE(floor, CASE WHEN is_tower = 1 THEN 15 ELSE 0 END) END AS floor,
       CASE WHEN reason <> '' THEN -1 ELSE lat END AS lat, CASE WHEN reason <> '' THEN -1 ELSE lon END AS lon, reason
FROM (
  SELECT q.*, a.lat, a.lon, t.default_bedrooms, t.is_tower,
         CASE WHEN a.area IS NULL THEN 'unknown area' WHEN t.property_type IS NULL THEN 'unknown property_type'
              WHEN q.size_sqft IS NULL THEN 'size_sqft missing'
              WHEN q.size_sqft <= 100 OR q.size_sqft > 20000 THEN 'size_sqft out of range'
              WHEN q.bedrooms < 0 OR q.bedrooms > 10 THEN 'bedrooms out of range'
              WHEN q.building_age_years < 0 OR q.building_age_years > 100 THEN 'building_age_years out of range'
              WHEN q.floor < 0 OR q.floor > 200 THEN 'floor out of range'
              WHEN q.price_aed_month <= 0 OR q.price_aed_month IS NULL THEN 'price_aed_month not positive'
              ELSE '' END AS reason
  FROM broken q LEFT JOIN areas a ON a.area = q.area LEFT JOIN types t ON t.property_type = q.property_type)""",
                                    _REQUESTS, _AREAS, _TYPES, """
broken AS (
  SELECT listing_id, area, CASE WHEN listing_id % 101 = 1 THEN 'Castle' ELSE property_type END AS property_type,
         CASE WHEN listing_id % 107 = 3 THEN NULL WHEN listing_id % 103 = 2 THEN -5 ELSE size_sqft END AS size_sqft,
         CASE WHEN listing_id % 109 = 4 THEN 11 ELSE bedrooms END AS bedrooms, furnished,
         CASE WHEN listing_id % 113 = 5 THEN 101 END AS building_age_years,
         CASE WHEN listing_id % 127 = 6 THEN 201 ELSE floor END AS floor,
         CASE WHEN listing_id % 131 = 7 THEN 0 ELSE price_aed_month END AS price_aed_month
  FROM asked)"""),
        "judge_requests": _scored(f"""
SELECT listing_id, p AS predicted_price_aed_month, round_even(price - p, 1) AS residual_aed, gap AS residual_pct,
       {_band("gap")} AS flag, CAST(gap <= CAST(-0.30 AS DOUBLE) AS INT) AS suspicious
FROM (SELECT listing_id, price_aed_month AS price, predicted_price_aed_month AS p,
             round_even((price_aed_month - predicted_price_aed_month) / predicted_price_aed_month, 4) AS gap
      FROM scored)"""),
        "interpolate_grid": _listings("""
SELECT listing_id,
       ROUND(COALESCE(lo_price, hi_price)
             + CASE WHEN lo_size < hi_size THEN (size - lo_size) / CAST(hi_size - lo_size AS DOUBLE) ELSE 0 END
               * (COALESCE(hi_price, lo_price) - COALESCE(lo_price, hi_price)), 0) AS estimate
FROM (
  SELECT a.listing_id, a.size,
         MAX(g.size_sqft) FILTER (WHERE g.size_sqft <= a.size) AS lo_size,
         ARG_MAX(g.price, g.size_sqft) FILTER (WHERE g.size_sqft <= a.size) AS lo_price,
         MIN(g.size_sqft) FILTER (WHERE g.size_sqft >= a.size) AS hi_size,
         ARG_MIN(g.price, g.size_sqft) FILTER (WHERE g.size_sqft >= a.size) AS hi_price
  FROM (SELECT listing_id, area, property_type, furnished,
               size_sqft * CAST(1.1 AS DOUBLE) - 100 AS size FROM listings) a
  JOIN (SELECT *, round_even(size_sqft * CAST(7.5 AS DOUBLE) + LENGTH(area) * 100 + furnished * 250, 0) AS price
        FROM grid) g USING (area, property_type, furnished)
  GROUP BY a.listing_id, a.size)""", _GRID),
        "flagged_listings": _scored("""
SELECT listing_id, area, price_aed_month, ROUND(residual_pct, 4) AS residual_pct
FROM scored WHERE residual_pct <= CAST(-0.30 AS DOUBLE)"""),
        "flagged_listings_top": _scored("""
SELECT listing_id, area, price_aed_month, ROUND(residual_pct, 4) AS residual_pct
FROM scored WHERE residual_pct <= CAST(-0.30 AS DOUBLE) ORDER BY residual_pct, listing_id LIMIT 25"""),

        "upsert_dimension": _scored("""
SELECT dimension, CAST(ROW_NUMBER() OVER (PARTITION BY dimension ORDER BY first_batch, member) AS BIGINT) AS id, member
FROM (
  SELECT dimension, member, MIN(batch) AS first_batch
  FROM (
    SELECT batch, UNNEST(['dim_area', 'dim_property_type', 'dim_agent']) AS dimension,
           UNNEST([area, property_type, agent_name]) AS member
    FROM (SELECT 1 AS batch, * FROM batch1 UNION ALL SELECT 2, * FROM batch2))
  GROUP BY dimension, member)
UNION ALL
SELECT DISTINCT 'dim_date', CAST(STRFTIME(listed_date, '%Y%m%d') AS BIGINT), CAST(listed_date AS VARCHAR)
FROM (SELECT listed_date FROM batch1 UNION ALL SELECT listed_date FROM batch2)""", _BATCHES),
        "classify_changes": _scored("SELECT COALESCE(f_id, s_id) AS listing_id, change FROM merge2", _LOADS),
        "upsert_facts": _scored(_FACT_COLUMNS + "fact2", _LOADS),
        "soft_delete": _scored(
            "SELECT listing_id, agent_name, first_loaded, last_updated FROM fact2 WHERE is_active = 0", _LOADS),
        "reactivate": _scored(_FACT_COLUMNS + "fact3", _LOADS),
        "load_batch": _scored(_FACT_COLUMNS + "f", """
f AS (SELECT *, 1 AS is_active, '2026-01-01' AS first_loaded, '2026-01-01' AS last_updated FROM scored)"""),
        "load_part": _scored(_FACT_COLUMNS + "fact1", _LOADS),
        "audit_run": _scored("\nUNION ALL\n".join(f"""
SELECT CAST({n} AS BIGINT) AS run_id, '2026-01-0{n}' AS started, COUNT(s_id) AS rows_in_batch,
       COUNT(*) FILTER (WHERE change = 'inserted') AS rows_inserted,
       COUNT(*) FILTER (WHERE change = 'updated') AS rows_updated,
       COUNT(*) FILTER (WHERE change = 'unchanged') AS rows_unchanged,
       COUNT(*) FILTER (WHERE change = 'deactivated') AS rows_deactivated, CAST(0 AS BIGINT) AS rows_rejected
FROM merge{n}""" for n in (1, 2, 3, 4)), _LOADS),
        "table_counts": _scored("""
SELECT 'fact_listings' AS table_name, COUNT(*) AS n FROM fact4
UNION ALL SELECT 'dim_area', COUNT(DISTINCT area) FROM scored
UNION ALL SELECT 'dim_property_type', COUNT(DISTINCT property_type) FROM scored
UNION ALL SELECT 'dim_agent', COUNT(DISTINCT agent_name) FROM scored
UNION ALL SELECT 'dim_date', COUNT(DISTINCT listed_date) FROM scored
UNION ALL SELECT 'etl_runs', 4""", _LOADS),
        "ensure_version": _scored("""
SELECT table_name, CASE WHEN v = 3 THEN n ELSE 0 END AS n, CAST(v AS INT) AS schema_version
FROM (SELECT 'fact_listings' AS table_name, COUNT(*) AS n FROM scored
      UNION ALL SELECT 'dim_area', COUNT(DISTINCT area) FROM scored
      UNION ALL SELECT 'dim_property_type', COUNT(DISTINCT property_type) FROM scored
      UNION ALL SELECT 'dim_agent', COUNT(DISTINCT agent_name) FROM scored
      UNION ALL SELECT 'dim_date', COUNT(DISTINCT listed_date) FROM scored
      UNION ALL SELECT 'etl_runs', 1), (VALUES (3), (4)) versions(v)"""),

        "area_leaderboard": _scored(f"""
SELECT area, ROUND(AVG(CASE WHEN flagged = 0 THEN {_PSF} END), 1) AS avg_price_per_sqft_annual,
       COUNT(*) FILTER (WHERE flagged = 0) AS clean_units, CAST(SUM(flagged) AS BIGINT) AS flagged_fraud
FROM nth WHERE nth_posting = 1 GROUP BY area""", _NTH),
        "monthly_rent_index": _scored(f"""
SELECT month, new_units, ROUND(psf, 1) AS avg_price_per_sqft_annual,
       ROUND(100 * (psf - LAG(psf) OVER (ORDER BY month)) / LAG(psf) OVER (ORDER BY month), 1) AS mom_change_pct
FROM (
  SELECT STRFTIME(listed_date, '%Y-%m') AS month, COUNT(*) AS new_units, AVG({_PSF}) AS psf
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {unit} ORDER BY listed_date, listing_id) AS n
        FROM scored WHERE residual_pct > CAST(-0.30 AS DOUBLE))
  WHERE n = 1 GROUP BY ALL)"""),
        "agent_repost_rate": _scored("""
SELECT agent_name AS agent, COUNT(*) AS listings, COUNT(*) FILTER (WHERE nth_posting > 1) AS reposts,
       ROUND(CAST(100 AS DOUBLE) * COUNT(*) FILTER (WHERE nth_posting > 1) / COUNT(*), 1) AS repost_rate_pct,
       CAST(SUM(flagged) AS BIGINT) AS flagged_fraud
FROM nth GROUP BY agent_name""", _NTH),
        "model_error_by_segment": _scored("""
SELECT property_type, COUNT(*) AS listings, ROUND(AVG(ABS(residual_pct)) * 100, 1) AS avg_abs_gap_pct,
       ROUND(AVG(residual_pct) * 100, 1) AS bias_pct,
       ROUND(AVG(ABS(price_aed_month - predicted_price_aed_month)), 0) AS mae_aed
FROM scored WHERE residual_pct > CAST(-0.30 AS DOUBLE) GROUP BY property_type"""),

        "stream_progress": _scored(
            "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, TRUE AS all_timed, TRUE AS within_trigger, TRUE AS all_summed FROM scored"
        ),
        "stream_bands": _scored(f"""
SELECT listing_id, CAST(round_even(raw, 0) AS BIGINT) AS predicted_price_aed_month,
       round_even((price - raw) / raw, 4) AS residual_pct, {_band("(price - raw) / raw")} AS flag
FROM (SELECT listing_id, price_aed_month AS price, predicted_price_aed_month + CAST(0.4 AS DOUBLE) AS raw
      FROM scored)"""),
        "systematic_sample": """
SELECT position, event_id, event_type FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY ts, event_id) - 1 AS position, event_id, event_type,
         GREATEST(1, COUNT(*) OVER () // 60) AS step
  FROM events)
WHERE position % step = 0""",
        "systematic_sample_listings": _listings("""
SELECT position, listing_id, title FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY listed_date, listing_id) - 1 AS position, listing_id, title,
         GREATEST(1, COUNT(*) OVER () // 60) AS step
  FROM listings)
WHERE position % step = 0"""),
        "latency_summary": """
SELECT COUNT(*) AS events_scored, ROUND(AVG(value), 4) AS avg_latency,
       ROUND(MAX(value) FILTER (WHERE i = n // 2), 4) AS p50_latency,
       ROUND(MAX(value) FILTER (WHERE i = CAST(FLOOR(n * CAST(0.99 AS DOUBLE)) AS BIGINT)), 4) AS p99_latency,
       ROUND(MAX(value), 4) AS max_latency
FROM (SELECT value, ROW_NUMBER() OVER (ORDER BY value) - 1 AS i, COUNT(*) OVER () AS n
      FROM events WHERE value IS NOT NULL)""",
    }
