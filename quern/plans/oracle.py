"""DuckDB SQL for each registered query, over the driver's parquet tables as views.

Column names and types match ``quern.plans.queries``. Regular expressions
here are RE2 (DuckDB), so Java's ``\\s`` is spelled out as the class
``[ \\t\\n\\v\\f\\r]`` (RE2's ``\\s`` has no vertical tab), and ``$`` means the
end of the text. Null ordering is written out where Spark sorts nulls first.
"""

from __future__ import annotations

_WS = r"[ \t\n\v\f\r]"

_TOKEN_COUNT = r"""
SELECT word, count(*) AS cnt
FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents) t
WHERE word <> ''
GROUP BY word
"""

_SPACE_SPLIT_COUNT = r"""
WITH l AS (SELECT replace(text, chr(10), '  ') AS v FROM documents),
s AS (
  SELECT CASE WHEN v = '' THEN ['']
              WHEN rtrim(v, ' ') = '' THEN []::VARCHAR[]
              ELSE string_split(rtrim(v, ' '), ' ') END AS arr
  FROM l)
SELECT word, count(*) AS cnt FROM (SELECT unnest(arr) AS word FROM s) t GROUP BY word
"""

_FIELD_ARITY = r"""
WITH l AS (
  SELECT doc_id,
         unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                     ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')
                END) AS v
  FROM documents),
f AS (
  SELECT doc_id,
         CASE WHEN v = '' THEN ['']
              WHEN regexp_replace(v, '@WS+$', '') = '' THEN []::VARCHAR[]
              ELSE regexp_split_to_array(regexp_replace(v, '@WS+$', ''), '@WS+') END AS a
  FROM l)
SELECT doc_id, a[1] AS f0, a[2] AS f1, a[3] AS f2, a[4] AS f3, a[5] AS f4
FROM f WHERE len(a) = 5
""".replace("@WS", _WS)

_NONEMPTY_LINES = r"""
SELECT doc_id, v AS line FROM (
  SELECT doc_id,
         unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                     ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')
                END) AS v
  FROM documents) t
WHERE v <> ''
"""

_BLOOM_SIZING = """
SELECT n_keys, bits, CAST(greatest(1, round(ln(2) * bits / n_keys)) AS INTEGER) AS hashes FROM (
  SELECT n_keys, CAST(greatest(64, ceil(ceil(log2(exp(1)) * greatest(n_keys, 1) * log2(100)) / 64) * 64) AS BIGINT) AS bits
  FROM (SELECT count(DISTINCT o_custkey) AS n_keys FROM orders) t) u
"""

_FIELD_ARITY_COUNTS = r"""
WITH l AS (
  SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                     ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')
                END) AS v
  FROM documents),
f AS (
  SELECT CASE WHEN v = '' THEN ['']
              WHEN regexp_replace(v, '@WS+$', '') = '' THEN []::VARCHAR[]
              ELSE regexp_split_to_array(regexp_replace(v, '@WS+$', ''), '@WS+') END AS a
  FROM l)
SELECT count(*) AS rows_in, count(*) FILTER (WHERE len(a) <> 5) AS rows_rejected FROM f
""".replace("@WS", _WS)

_LIMIT3 = r"(?s)^([^ \t\n\v\f\r]*)@WS+([^ \t\n\v\f\r]+)@WS+(.*)$".replace("@WS", _WS)

_FIELDS_LIMIT = f"""
SELECT doc_id,
       regexp_extract(text, '{_LIMIT3}', 1) AS first,
       regexp_extract(text, '{_LIMIT3}', 2) AS second,
       regexp_extract(text, '{_LIMIT3}', 3) AS rest
FROM documents
WHERE regexp_matches(text, '{_LIMIT3}')
"""

_PARSE_PAIRS = """
SELECT l_partkey AS first_num, l_suppkey AS second_num
FROM lineitem
WHERE (l_linenumber IS NULL OR l_linenumber NOT IN (6, 7))
  AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL
"""

_PAIRS = "SELECT l_partkey AS first_num, l_suppkey AS second_num FROM lineitem"

_FIRST_PER_KEY = """
SELECT o_custkey, o_orderkey FROM (
  SELECT o_custkey, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey
                            ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC NULLS FIRST) AS rn
  FROM orders) t
WHERE rn = 1
"""

_FIRST_OF_RUN_BY_USER = """
SELECT user_id, event_id, event_type FROM (
  SELECT user_id, event_id, event_type,
         lag(event_type) OVER w AS prev,
         row_number() OVER w AS rn
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST)) t
WHERE rn = 1 OR prev IS DISTINCT FROM event_type
"""

_FIRST_OF_RUN_GLOBAL = """
SELECT event_id, event_type FROM (
  SELECT event_id, event_type,
         lag(event_type) OVER w AS prev,
         row_number() OVER w AS rn
  FROM events
  WINDOW w AS (ORDER BY event_id ASC NULLS FIRST)) t
WHERE rn = 1 OR prev IS DISTINCT FROM event_type
"""

_BUILDING_JOIN = """
SELECT c_custkey, c_name, o_orderkey, o_totalprice
FROM customer JOIN orders ON c_custkey = o_custkey
WHERE c_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
"""

_SECONDARY_SORT_LAYOUT = """
SELECT c_custkey AS key, 0 AS tag, c_name, CAST(NULL AS BIGINT) AS o_orderkey
FROM customer
UNION ALL
SELECT o_custkey AS key, 1 AS tag, CAST(NULL AS VARCHAR) AS c_name, o_orderkey FROM orders
"""

_COGROUP = """
WITH flow AS (
  SELECT c_nationkey AS nationkey, 0 AS side, c_custkey AS row_key, c_name AS row_name FROM customer
  UNION ALL
  SELECT s_nationkey, 1, s_suppkey, s_name FROM supplier)
SELECT nationkey, side, row_key, row_name,
       count(*) FILTER (side = 0) OVER (PARTITION BY nationkey) AS n_customers,
       count(*) FILTER (side = 1) OVER (PARTITION BY nationkey) AS n_suppliers
FROM flow
"""

_COGROUP_LISTS = """
WITH flow AS (
  SELECT c_nationkey AS nationkey, 0 AS side, c_custkey AS row_key, c_name AS row_name,
         (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 25 AS chunk FROM customer
  UNION ALL
  SELECT s_nationkey, 1, s_suppkey, s_name,
         (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) // 25 FROM supplier),
n AS (
  SELECT nationkey, count(*) FILTER (side = 0) AS n_customers, count(*) FILTER (side = 1) AS n_suppliers
  FROM flow GROUP BY nationkey)
SELECT nationkey, chunk, n_customers, n_suppliers,
       coalesce(string_agg(row_key || ':' || row_name, ',' ORDER BY row_key) FILTER (side = 0), '') AS customers,
       coalesce(string_agg(row_key || ':' || row_name, ',' ORDER BY row_key) FILTER (side = 1), '') AS suppliers
FROM flow JOIN n USING (nationkey) GROUP BY nationkey, chunk, n_customers, n_suppliers
"""

_TOKEN_STAGE_COUNTS = r"""
WITH l AS (
  SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                     ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n')
                END) AS v
  FROM documents),
s AS (
  SELECT CASE WHEN v = '' THEN ['']
              WHEN rtrim(v, ' ') = '' THEN []::VARCHAR[]
              ELSE string_split(rtrim(v, ' '), ' ') END AS arr
  FROM l),
w AS (SELECT unnest(arr) AS word FROM s)
SELECT 'map' AS stage, 'lines_in' AS metric, count(*) AS value FROM l
UNION ALL SELECT 'reduce', 'groups_out', count(DISTINCT word) FROM w
UNION ALL SELECT 'reduce', 'tokens', count(*) FROM w
"""

_LOOKUP = """
SELECT c_custkey, c_name, c_nationkey, d.s_name
FROM customer JOIN (SELECT s_nationkey, arg_max(s_name, (s_suppkey, s_name)) AS s_name FROM supplier GROUP BY s_nationkey) d
  ON c_nationkey = d.s_nationkey
"""

ORACLE_SQL: dict[str, str] = {
    "token_count": _TOKEN_COUNT,
    "space_split_count": _SPACE_SPLIT_COUNT,
    "merge_counts": _TOKEN_COUNT,
    "token_count_layout": _TOKEN_COUNT,
    "field_arity_filter": _FIELD_ARITY,
    "field_arity_counts": _FIELD_ARITY_COUNTS,
    "nonempty_lines": _NONEMPTY_LINES,
    "fields_limit": _FIELDS_LIMIT,
    "parse_pairs": _PARSE_PAIRS,
    "parse_pairs_strict": _PAIRS,
    "sorted_pairs": _PAIRS + " ORDER BY first_num",
    "sorted_pairs_by_two": _PAIRS + " ORDER BY first_num, second_num",
    "distinct_pairs": "SELECT DISTINCT l_partkey AS first_num, l_suppkey AS second_num FROM lineitem ORDER BY 1, 2",
    "min_per_key": "SELECT l_partkey AS first_num, min(l_suppkey) AS second_num FROM lineitem GROUP BY l_partkey",
    "first_per_key": _FIRST_PER_KEY,
    "first_of_run_by_user": _FIRST_OF_RUN_BY_USER,
    "first_of_run_global": _FIRST_OF_RUN_GLOBAL,
    "join_keys": "SELECT DISTINCT o_custkey AS join_key FROM orders",
    "inner_join": "SELECT o_orderkey, o_custkey, l_linenumber, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
    "left_outer_join": """
SELECT c_custkey, c_name, o_orderkey, o_totalprice
FROM customer LEFT JOIN orders o ON c_custkey = o.o_custkey
""",
    "left_outer_join_tsv": """
SELECT coalesce(CAST(c_custkey AS VARCHAR), 'null') || chr(9) || coalesce(c_name, 'null') || chr(9) ||
       CASE WHEN o.o_orderkey IS NULL THEN 'null'
            ELSE coalesce(CAST(o.o_orderkey AS VARCHAR), 'null') || chr(9) || coalesce(o.o_orderstatus, 'null')
       END AS value
FROM customer LEFT JOIN orders o ON c_custkey = o.o_custkey
""",
    "lookup_join": _LOOKUP,
    "lookup_join_sorted": _LOOKUP + " ORDER BY c_nationkey",
    "prefiltered_join": _BUILDING_JOIN,
    "bloom_join": _BUILDING_JOIN,
    "secondary_sort_join": _BUILDING_JOIN,
    "secondary_sort_layout": _SECONDARY_SORT_LAYOUT,
    "cogroup": _COGROUP,
    "cogroup_lists": _COGROUP_LISTS,
    "token_stage_counts": _TOKEN_STAGE_COUNTS,
    "bloom_sizing": _BLOOM_SIZING,
    "secondary_sort_routed": _SECONDARY_SORT_LAYOUT,
}
