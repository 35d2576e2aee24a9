"""What the queries must return, as SQL on the driver's tables."""

from __future__ import annotations

# The line item that is the first record of its work id.
WORKS = """
WITH copies AS (
  SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_discount AS d,
         CAST(l_shipdate AS DATE) AS shipped, l_orderkey % 8 = 7 AS odd,
         row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber
           ORDER BY CAST(l_shipdate AS DATE),
                    (l_partkey * 10000000 + l_suppkey) * 100
                    + CAST(round(l_discount * 100) AS BIGINT)) AS place
  FROM lineitem),
w AS (SELECT *, 'W' || k || '-' || n AS id FROM copies WHERE place = 1)
"""

NAME = "CASE WHEN k % 7 IN (1, 2) THEN '{default}' ELSE {name} END"
COUNT = "CAST(CASE WHEN k % 9 IN (4, 5) THEN 0 ELSE {n} END AS BIGINT)"

WORKS_CITATIONS = WORKS + """
SELECT id AS work_id, unnest(['W' || p, 'W' || p, 'W' || s]) AS referenced_work_id FROM w
"""

WORKS_AUTHORSHIPS = WORKS + """
SELECT id AS work_id,
       CASE WHEN n = 1 THEN 'unknown' ELSE 'p' || n END AS author_position,
       'A' || s AS author_id,
       CASE WHEN n % 4 >= 2 THEN 'I' || (s % 25) END AS institution_id,
       CAST(NULL AS VARCHAR) AS raw_affiliation_string
FROM w
UNION ALL
SELECT id, 'last', 'A' || p, NULL, 'R' || n FROM w
"""

AUTHORS_IDS = """
SELECT 'A' || c_custkey AS author_id,
       CASE WHEN c_custkey % 5 <> 1 THEN 'A' || c_custkey END AS openalex,
       CASE WHEN c_custkey % 5 <> 1 THEN '0-' || c_nationkey END AS orcid,
       CAST(NULL AS VARCHAR) AS scopus, CAST(NULL AS VARCHAR) AS twitter,
       CAST(NULL AS VARCHAR) AS wikipedia, CAST(NULL AS VARCHAR) AS mag
FROM customer WHERE c_custkey % 5 <> 0
"""

ORACLES: dict[str, str] = {
    "works_citations": WORKS_CITATIONS,
    "works_topics": WORKS + """
SELECT id AS work_id, 'T' || s AS topic_id, CAST(NULL AS DOUBLE) AS score FROM w
UNION ALL SELECT id, 'T' || p, d FROM w
UNION ALL SELECT id, 'T' || s, CAST(n AS DOUBLE) FROM w
""",
    "works_authorships": WORKS_AUTHORSHIPS,
    "works_parent": WORKS + """
SELECT id,
       CASE WHEN n % 3 = 2 THEN '10.1/' || k END AS doi,
       CASE WHEN NOT odd THEN 'Title ' || p END AS title,
       CASE WHEN p % 7 IN (1, 2) THEN '' ELSE 'Work ' || k END AS display_name,
       CAST(CASE WHEN k % 3 < 2 OR NOT odd THEN year(shipped) END AS INTEGER) AS publication_year,
       CAST(shipped AS VARCHAR) AS publication_date,
       'type' || n AS type,
       CAST(CASE WHEN NOT odd THEN p WHEN p % 4 = 3 THEN -p ELSE 0 END AS BIGINT)
         AS cited_by_count,
       k % 4 = 0 AS is_retracted,
       CASE k % 4 WHEN 0 THEN false WHEN 1 THEN true END AS is_paratext,
       CASE WHEN k % 5 <> 0 THEN 'http://c/' || k END AS cited_by_api_url,
       CASE p % 4 WHEN 0 THEN NULL WHEN 1 THEN 'null'
            ELSE '{"Alpha":[0,2],"zeta":[' || p || ']}' END AS abstract_inverted_index,
       CASE WHEN NOT odd THEN 'en' END AS language
FROM w
""",
    "works_locations": WORKS + """
SELECT id AS work_id, 'S' || s AS source_id, 'http://l/' || p AS landing_page_url,
       CASE WHEN p % 3 <> 0 THEN 'http://f/' || k END AS pdf_url,
       CASE WHEN p % 2 = 0 THEN true END AS is_oa,
       'v' || n AS version,
       CASE WHEN n % 2 <> 0 THEN 'by' END AS license,
       'primary' AS location_type
FROM w WHERE k % 6 >= 3
""",
    "works_open_access": WORKS + """
SELECT id AS work_id,
       CASE WHEN k % 9 >= 3 THEN p % 2 = 0 END AS is_oa,
       CASE WHEN k % 9 >= 3 THEN 'gold' END AS oa_status,
       CASE WHEN k % 9 >= 3 AND NOT odd THEN 'http://o/' || p END AS oa_url,
       CASE WHEN k % 9 >= 3 AND s % 2 = 0 THEN true END AS any_repository_has_fulltext
FROM w WHERE k % 9 <> 0
""",
    "authors_parent": f"""
WITH a AS (
  SELECT c.*, c_custkey AS k, coalesce(orders, 0) AS orders
  FROM customer c
  LEFT JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) o
    ON c_custkey = o_custkey)
SELECT 'A' || k AS id,
       CASE WHEN k % 3 = 0 THEN 'https://o/' || k END AS orcid,
       {NAME.format(default="Unknown", name="c_name")} AS display_name,
       CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 'null'
            ELSE '["' || c_mktsegment || '","x"]' END AS display_name_alternatives,
       {COUNT.format(n="orders")} AS works_count,
       CAST(CASE k % 4 WHEN 0 THEN -k WHEN 1 THEN 0 ELSE k END AS BIGINT) AS cited_by_count,
       CASE WHEN k % 6 >= 2 THEN 'I' || c_nationkey END AS last_known_institution,
       'https://api/A' || k AS works_api_url,
       CASE WHEN k % 8 <> 0 THEN 'd' || k END AS updated_date
FROM a
""",
    "authors_ids": AUTHORS_IDS,
    "authors_counts_by_year": """
SELECT 'A' || o_custkey AS author_id, CAST(year(o_orderdate) AS INTEGER) AS year,
       count(*) AS works_count, CAST(0 AS BIGINT) AS cited_by_count,
       CAST(0 AS BIGINT) AS oa_works_count
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)
GROUP BY o_custkey, year(o_orderdate)
""",
    "institutions_parent": f"""
WITH i AS (
  SELECT *, s_suppkey AS k FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT 'I' || k AS id,
       CASE WHEN k % 3 <> 0 THEN 'ror/' || k END AS ror,
       {NAME.format(default="Unknown", name="s_name")} AS display_name,
       CASE WHEN k % 2 = 0 THEN 'N' || s_nationkey END AS country_code,
       r_name AS type,
       'http://h/' || k AS homepage_url,
       CASE WHEN k % 4 >= 2 THEN 'http://i/' || k END AS image_url,
       CAST(NULL AS VARCHAR) AS image_thumbnail_url,
       CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN '[]' ELSE '["S' || k || '",1]' END
         AS display_name_acronyms,
       CASE WHEN k % 3 = 0 THEN 'true' ELSE '[["' || k || '"]]' END AS display_name_alternatives,
       {COUNT.format(n="k")} AS works_count,
       CAST(k * 10 AS BIGINT) AS cited_by_count,
       'http://w/' || k AS works_api_url,
       'u' || k AS updated_date
FROM i
""",
    "institutions_geo": """
WITH i AS (
  SELECT *, s_suppkey AS k, s_suppkey % 5 <> 1 AS filled FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT 'I' || k AS institution_id,
       CASE WHEN filled THEN n_name END AS city,
       CAST(NULL AS VARCHAR) AS geonames_city_id,
       CASE WHEN filled THEN r_name END AS region,
       CAST(NULL AS VARCHAR) AS country_code,
       CAST(NULL AS VARCHAR) AS country,
       CASE WHEN NOT filled OR k % 4 = 0 THEN NULL
            WHEN k % 4 = 1 THEN trunc(s_acctbal) ELSE s_acctbal END AS latitude,
       CASE WHEN filled THEN CAST(-k AS DOUBLE) END AS longitude
FROM i WHERE k % 5 <> 0
""",
    "publishers_parent": f"""
WITH b AS (SELECT *, page_id AS k FROM pages)
SELECT 'P' || k AS id,
       {NAME.format(default="Unknown", name="url")} AS display_name,
       '[' || CAST(to_json(html) AS VARCHAR) || ']' AS alternate_titles,
       CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN 'null' ELSE '["C' || (k % 25) || '"]' END
         AS country_codes,
       CAST(CASE k % 4 WHEN 2 THEN k % 3 WHEN 3 THEN k END AS INTEGER) AS hierarchy_level,
       CASE WHEN k % 2 <> 0 THEN 'P0' END AS parent_publisher,
       {COUNT.format(n="k")} AS works_count,
       CAST(length(html) AS BIGINT) AS cited_by_count,
       'http://s/' || k AS sources_api_url,
       CASE WHEN k % 6 <> 0 THEN 'u' || k END AS updated_date
FROM b
""",
    "topics_parent": f"""
WITH t AS (SELECT *, p_partkey AS k FROM part)
SELECT 'T' || k AS id,
       {NAME.format(default="Unknown", name="p_name")} AS display_name,
       CASE WHEN k % 3 = 0 THEN 'Unknown' ELSE p_brand END AS subfield_id,
       'Unknown' AS subfield_display_name,
       'Unknown' AS field_id,
       CASE WHEN k % 4 >= 2 THEN p_type ELSE 'Unknown' END AS field_display_name,
       'Unknown' AS domain_id,
       'D' || p_size AS domain_display_name,
       CASE WHEN k % 2 = 0 THEN 'about ' || p_name END AS description,
       CASE k % 5 WHEN 1 THEN '' WHEN 3 THEN p_brand || '; ' || p_type
            WHEN 4 THEN p_type || '; ' || p_name END AS keywords,
       'http://t/' || k AS works_api_url,
       CASE WHEN k % 2 = 0 THEN 'wiki/' || k END AS wikipedia_id,
       {COUNT.format(n="p_size")} AS works_count,
       CAST(p_size * 100 AS BIGINT) AS cited_by_count,
       'u' || k AS updated_date,
       CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 'null'
            ELSE '[{{"a":[1,2],"id":"T' || (k + 1) || '"}}]' END AS siblings
FROM t
""",
    "document_works": """
SELECT 'W' || doc_id AS id, text AS title, '' AS display_name, lang AS language,
       '{"chars":[' || n_chars || '],"text":' || CAST(to_json(text) AS VARCHAR) || '}'
         AS abstract_inverted_index
FROM documents
""",
    "document_references": """
SELECT 'W' || doc_id AS work_id, unnest(string_split(text, ' ')) AS referenced_work_id
FROM documents
""",
    "dedup_first_per_id": """
SELECT 'U' || user_id AS id, event_id, event_type
FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY CAST(ts AS DATE), event_id) AS place FROM events) AS e
WHERE place = 1
""",
    "blank_and_bad_id_filter": """
SELECT 'O' || o_orderkey AS id FROM orders
UNION SELECT 'R' || o_orderkey FROM orders
""",
    "malformed_line_report": """
WITH kinds AS (
  SELECT unnest(range(12)) AS kind, 'not one JSON value' AS reason
  UNION ALL VALUES (12, 'half a surrogate pair'), (13, 'a number beyond double range'),
    (14, 'a number beyond double range'), (21, 'bytes that are not UTF-8'))
SELECT o_orderkey * 100 + kind AS line_no, reason FROM orders, kinds
""",
    "strict_scalars": """
WITH e AS (
  SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events)
SELECT event_id, CAST(NULL AS VARCHAR) AS integer_text, k AS integer_whole,
       CAST(k AS INTEGER) AS integer_whole32, CAST(k AS DOUBLE) AS integer_number,
       CAST(NULL AS BOOLEAN) AS integer_truth, CAST(k AS VARCHAR) AS integer_json,
       CAST(NULL AS BIGINT) AS decimal_whole, value AS decimal_number,
       event_type AS string_text, CAST(NULL AS BIGINT) AS string_whole,
       CAST(NULL AS DOUBLE) AS string_number, '"' || event_type || '"' AS string_json,
       CAST(NULL AS VARCHAR) AS object_text, '{"k":' || k || '}' AS object_json,
       false AS absent_present
FROM e
""",
    "json_text_sorted_keys": """
SELECT 'C' || c_custkey AS id,
       '{"M":{"k":' || c_custkey || ',"k2":[],"é":true},"a":"' || c_mktsegment || '","a0":'
       || c_nationkey || ',"n":[5.0,100.0,0.1,' || c_custkey || '.5,-0.0,1e30,1' || c_nationkey
       || '000000.0,2e-7,0.0001,1.8446744073709552e19,"7.0,1E9"]' || ',"z":[1,{"b":null,"y":"' || c_name || '"}]}'
         AS display_name_alternatives
FROM customer
""",
    "entity_counts": """
SELECT 'authors' AS counted, count(*) AS n FROM customer
UNION ALL SELECT 'institutions', count(*) FROM supplier
UNION ALL SELECT 'publishers', count(*) FROM pages
UNION ALL SELECT 'topics', count(*) FROM part
UNION ALL SELECT 'works', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) AS w
UNION ALL SELECT 'works_citations', 3 * count(*)
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) AS w
""",
    "file_scan_limit": """
SELECT 'O' || o_orderkey AS id, o_orderstatus AS type FROM orders
WHERE o_orderkey // 5000 IN (
  SELECT DISTINCT o_orderkey // 5000 AS file FROM orders ORDER BY file LIMIT 2)
""",
    "job_table_counts": """
WITH w AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem),
c AS (
  SELECT 'authors' AS table_name, count(*) AS n FROM customer
  UNION ALL SELECT 'authors_ids', count(*) FROM customer WHERE c_custkey % 5 <> 0
  UNION ALL SELECT 'authors_counts_by_year', count(*) FROM (
    SELECT DISTINCT o_custkey, year(o_orderdate) FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer)) AS y
  UNION ALL SELECT 'institutions', count(*) FROM supplier
  UNION ALL SELECT 'institutions_geo', count(*) FROM supplier WHERE s_suppkey % 5 <> 0
  UNION ALL SELECT 'publishers', count(*) FROM pages
  UNION ALL SELECT 'topics', count(*) FROM part
  UNION ALL SELECT 'works', count(*) FROM w
  UNION ALL SELECT 'works_locations', count(*) FROM w WHERE k % 6 >= 3
  UNION ALL SELECT 'works_authorships', 2 * count(*) FROM w
  UNION ALL SELECT 'works_topics', 3 * count(*) FROM w
  UNION ALL SELECT 'works_open_access', count(*) FROM w WHERE k % 9 <> 0
  UNION ALL SELECT 'works_citations', 3 * count(*) FROM w)
SELECT table_name, n, n AS reported FROM c
""",
    "job_twice": """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1),
f AS (SELECT 1 AS run, count(*) AS files, CAST(sum(n) AS BIGINT) AS n FROM m
      UNION ALL SELECT 2, 1, (SELECT n FROM m ORDER BY month LIMIT 1))
SELECT run, 'files' AS what, files AS reported, CAST(NULL AS BIGINT) AS found FROM f
UNION ALL SELECT run, 'publishers', n, n FROM f
UNION ALL SELECT run, unnest(['authors', 'authors_ids', 'authors_counts_by_year']), 0, 0 FROM f
""",
    "job_file_sizes": """
WITH w AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem),
c AS (
  SELECT 'works_locations' AS table_name, count(*) AS n FROM w WHERE k % 6 >= 3
  UNION ALL SELECT 'works_authorships', 2 * count(*) FROM w
  UNION ALL SELECT 'works_topics', 3 * count(*) FROM w
  UNION ALL SELECT 'works_open_access', count(*) FROM w WHERE k % 9 <> 0
  UNION ALL SELECT 'works_citations', 3 * count(*) FROM w)
SELECT table_name, n, CAST(0 AS BIGINT) AS oversized, false AS too_many FROM c
""",
    "job_works_citations": WORKS_CITATIONS,
    "job_works_authorships": WORKS_AUTHORSHIPS,
    "job_authors_ids": AUTHORS_IDS,
}
