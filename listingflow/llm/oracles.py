"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from listingflow.llm.license_texts import SPELLINGS, TEXTS, notices

_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RULE_LEDGER = rf"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, doc_id, text, regexp_extract_all(text, '{_SPACED}') AS words FROM numbered),
windows AS (
    SELECT r, pos, array_to_string(words[pos:pos + 7], ' ') AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS pos FROM split WHERE len(words) >= 8)
),
twice AS (SELECT r, pos FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
repeated AS (
    SELECT r, count(DISTINCT pos + j) AS n FROM twice, (SELECT unnest(range(0, 8)) AS j) GROUP BY r
),
lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM split)
    WHERE regexp_matches(line, '{_SPACED}') GROUP BY r
),
measured AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0)::BIGINT AS n_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words
    FROM split LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)
),
judged AS (
    SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
        + CASE WHEN 2 * n_symbols > word_chars THEN 64 ELSE 0 END)::BIGINT AS fail_bits
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits,
    (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept
FROM judged
"""

DECONTAMINATE = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS words FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_ALNUM}') AS words
    FROM benchmark WHERE item_id IS NOT NULL
),
windows AS (
    SELECT DISTINCT item_id, least(len(words), 13) AS n, array_to_string(words[pos:pos + 12], ' ') AS w
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS pos FROM items WHERE len(words) > 0)
),
lengths AS (SELECT DISTINCT n FROM windows),
runs AS (
    SELECT r, n, pos, array_to_string(words[pos:pos + n - 1], ' ') AS w
    FROM (SELECT r, n, words, unnest(range(1, len(words) - n + 2)) AS pos FROM docs, lengths WHERE len(words) >= n)
),
found AS (SELECT r, pos, n, item_id FROM runs JOIN windows USING (n, w)),
hits AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(pos, pos + n)) AS p FROM (SELECT DISTINCT r, pos, n FROM found)) GROUP BY r
),
named AS (
    SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM found) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""


URL_LISTS = r"""
WITH captures AS (
    SELECT row_number() OVER () AS r, page_id,
        lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)) AS host,
        regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path,
        (DATE '2023-01-01' + ((page_id * 7919) % 730)::INT) AS fetched
    FROM pages
),
hosts AS (
    SELECT host, ('0x' || substr(md5(host), 1, 6))::INT AS number
    FROM (SELECT DISTINCT host FROM captures WHERE host <> '')
),
entries AS (
    SELECT ['host', 'domain', 'prefix'][number % 3 + 1] AS kind,
        CASE number % 3 WHEN 0 THEN host WHEN 1 THEN regexp_replace(host, '^(?:www|m|blog)\.', '') ELSE host || '/en/' END AS entry,
        DATE '2022-06-01' + number % 500 AS start, number
    FROM hosts WHERE number % 4 <> 0
),
events AS (
    SELECT kind, entry, 'add' AS action, start AS day FROM entries
    UNION ALL SELECT kind, entry, 'remove', start + (60 + number % 200) FROM entries
    UNION ALL SELECT kind, entry, 'add', start + (300 + number % 200) FROM entries
),
states AS (SELECT kind, entry, day, bool_or(action = 'remove') AS removed FROM events GROUP BY ALL),
matches AS (
    SELECT r, kind, entry, CASE kind WHEN 'prefix' THEN 0 WHEN 'host' THEN 1 ELSE 2 END AS rank,
        max_by(removed, day) AS removed
    FROM captures JOIN states ON day <= fetched AND host <> '' AND (
        kind = 'host' AND host = entry OR kind = 'domain' AND (host = entry OR ends_with(host, '.' || entry))
        OR kind = 'prefix' AND starts_with(host || path, entry))
    GROUP BY r, kind, entry
),
best AS (
    SELECT r, kind, entry FROM matches WHERE NOT removed
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY rank, length(entry) DESC, entry) = 1
),
spans AS (  -- begins of runs of "added"
    SELECT kind, entry, day, removed,
        coalesce(lag(removed) OVER (PARTITION BY kind, entry ORDER BY day), true) AS off_before FROM states
)
SELECT page_id, host, fetched, best.kind IS NOT NULL AS listed, best.kind, best.entry,
    (SELECT max(day) FROM spans s WHERE s.kind = best.kind AND s.entry = best.entry AND NOT s.removed AND s.off_before
        AND s.day <= fetched) AS since
FROM captures LEFT JOIN best USING (r)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_lines(text: str) -> str:
    stated = rf"regexp_replace(lower(coalesce({text}, '')), '(?m)^[\s/*#;!-]*(?:copyright|©|\(c\))[^\n]*$', '', 'g')"
    out = rf"regexp_replace({stated}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    for variant, usual in SPELLINGS:
        out = rf"regexp_replace({out}, '\b{variant}\b', {_quoted(usual)}, 'g')"
    return out


def _canonical(lines: str) -> str:
    return rf"trim(regexp_replace({lines}, '\s+', ' ', 'g'))"


def license_digests() -> str:
    texts, lines = (", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in rows) for rows in (TEXTS.items(), notices()))
    return rf"""
WITH texts AS (
    SELECT sha256({_canonical(_canonical_lines("t"))}) AS digest, min(l) AS licence FROM (VALUES {texts}) v(l, t) GROUP BY 1
),
notices AS (
    SELECT sha256({_canonical(_canonical_lines("t"))}) AS digest, min(l) AS licence FROM (VALUES {lines}) v(l, t) GROUP BY 1
),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_canonical_lines("text")} AS lines FROM documents),
found AS (
    SELECT r, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS listed
    FROM (SELECT r, unnest(string_split(lines, chr(10))) AS line FROM docs) JOIN notices ON sha256(trim(line)) = notices.digest
    GROUP BY r
)
SELECT doc_id, sha256({_canonical("lines")}) AS digest, licence, coalesce(n, 0)::BIGINT AS n_notices, coalesce(listed, '') AS notices
FROM docs LEFT JOIN texts ON sha256({_canonical("lines")}) = texts.digest LEFT JOIN found USING (r)
"""


PHRASES = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM split GROUP BY lang),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split),
spelled AS (SELECT lang, words, i, unnest(range(1, least(3, len(words) - i + 1) + 1)) AS k FROM starts),
counted AS (
    SELECT lang, words[i:i + k - 1] AS words, count(*) AS a FROM spelled GROUP BY ALL HAVING count(*) >= 10
),
cuts AS (SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM counted WHERE len(words) > 1),
scored AS (
    SELECT c.lang, c.words, c.a, k, l.a AS l, r.a AS r,
        (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS score
    FROM cuts c
    JOIN counted l ON l.lang = c.lang AND l.words = c.words[1:k]
    JOIN counted r ON r.lang = c.lang AND r.words = c.words[k + 1:]
),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inner_pairs AS (
    SELECT lang, words[i:i + 1] AS words, max(a) AS around
    FROM (SELECT lang, words, a, unnest([1, 2]) AS i FROM counted WHERE len(words) = 3) GROUP BY ALL
),
kept AS (
    SELECT w.lang, array_to_string(w.words, ' ') AS phrase, w.a, w.l, w.r, w.score
    FROM worst w LEFT JOIN inner_pairs p ON p.lang = w.lang AND p.words = w.words
    WHERE around IS NULL OR 100 * around < 50 * w.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase,
    a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_url_lists": URL_LISTS, "op7_rule_ledger": RULE_LEDGER, "op8_decontaminate": DECONTAMINATE,
        "op9_license_digests": license_digests(), "op12_collocations": PHRASES,
    }
