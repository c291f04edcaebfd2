"""DuckDB SQL equivalents of the driver queries (same column names)."""

from __future__ import annotations

# The media view over lineitem, as in ledgerline.plans.catalogue.media_rows.
MEDIA_CTE = """
media AS (
    SELECT
        CASE WHEN l_linenumber = 1 AND l_returnflag = 'N' AND l_linestatus = 'O'
             THEN NULL ELSE l_orderkey END AS title_key,
        CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'accepted'
             WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'rejected'
             WHEN l_returnflag = 'A' AND l_linestatus = 'O' AND l_quantity > 45 THEN 'override'
             WHEN l_returnflag = 'N' AND l_linestatus = 'F' AND l_quantity <= 5 THEN NULL
             ELSE 'unfiltered' END AS status,
        CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'part ' || CAST(l_partkey AS VARCHAR) END AS title,
        l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus, l_shipdate,
        [l_returnflag, CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' AND l_quantity <= 5
                            THEN NULL ELSE l_linestatus END] AS tags
    FROM lineitem
)"""

# Enum max of the return flag, declaration order R < A < N.
FLAG_RANK = "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 WHEN 'N' THEN 3 END"
FLAG_OF_RANK = "CASE {r} WHEN 1 THEN 'R' WHEN 2 THEN 'A' WHEN 3 THEN 'N' END"

# The rule in terms of counts: any favoured row; else nothing but rows without a verdict; else the rest.
JUDGED = """
tally AS (
    SELECT title_key AS k, count(*) AS n,
           count(*) FILTER (status IN ('accepted', 'override')) AS favoured,
           count(*) FILTER (status = 'unfiltered') AS open
    FROM media WHERE title_key IS NOT NULL GROUP BY ALL
),
judged AS (
    SELECT k, if(favoured > 0, 'would_watch', 'would_not_watch') AS label
    FROM tally WHERE favoured > 0 OR open < n
)"""

TAGS_TEXT = "array_to_string(list_transform({c}, lambda x: coalesce(x, '~')), '|')"

SYNC_NEW_ROWS = f"""
WITH {MEDIA_CTE},
{JUDGED}
SELECT m.title_key, any_value(j.label) AS label, coalesce(max(m.title), '') AS title,
       max(m.l_partkey) AS l_partkey, max(m.l_suppkey) AS l_suppkey, max(m.l_linenumber) AS l_linenumber,
       max(m.l_quantity) AS l_quantity, max(m.l_extendedprice) AS l_extendedprice,
       max(m.l_discount) AS l_discount, max(m.l_tax) AS l_tax,
       {FLAG_OF_RANK.format(r=f"max({FLAG_RANK})")} AS l_returnflag,
       max(m.l_linestatus) AS l_linestatus, max(m.l_shipdate) AS l_shipdate,
       {TAGS_TEXT.format(c="max(m.tags)")} AS tags
FROM media m JOIN judged j ON m.title_key = j.k
WHERE NOT EXISTS (FROM orders WHERE o_orderstatus = 'F' AND o_orderkey = m.title_key)
GROUP BY m.title_key
"""

ORACLE = {
    "sync_new_rows": SYNC_NEW_ROWS,
}

MEDIA_COLS = ("title_key, status, title, l_partkey, l_suppkey, l_linenumber, l_quantity, "
              "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")

PRIORITY_RANK = ("CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '4-NOT SPECIFIED' THEN 2 "
                 "WHEN '3-MEDIUM' THEN 3 WHEN '2-HIGH' THEN 4 WHEN '1-URGENT' THEN 5 END")
PRIORITY_OF_RANK = ("CASE {r} WHEN 1 THEN '5-LOW' WHEN 2 THEN '4-NOT SPECIFIED' WHEN 3 THEN '3-MEDIUM' "
                    "WHEN 4 THEN '2-HIGH' WHEN 5 THEN '1-URGENT' END")
STATUS_RANK = "CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'F' THEN 3 END"
STATUS_OF_RANK = "CASE {r} WHEN 1 THEN 'O' WHEN 2 THEN 'P' WHEN 3 THEN 'F' END"

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

LINEITEM_RULES_SQL = (
    ("quantity_range", "l_quantity BETWEEN 1 AND 50"),
    ("quantity_whole", "l_quantity = floor(l_quantity)"),
    ("discount_range", "l_discount BETWEEN 0 AND 0.05"),
    ("tax_nonnegative", "l_tax >= 0"),
    ("price_positive", "l_extendedprice > 0"),
    ("flag_code", "regexp_matches(l_returnflag, '^[AR]$')"),
)
PART_RULES_SQL = (
    ("size_range", "p_size BETWEEN 1 AND 40"),
    ("price_at_least_1000", "p_retailprice >= 1000"),
    ("brand_format", "regexp_matches(p_brand, '^Brand#[0-9]{1,2}$')"),
    ("name_two_words", "length(p_name) - length(replace(p_name, ' ', '')) = 1"),
)


def _rules_sql(table: str, rules) -> list[str]:
    return [f"SELECT '{table}' AS table_name, '{n}' AS rule, "
            f"count(*) FILTER (WHERE NOT ({t})) AS violations FROM {table}" for n, t in rules]


ORACLE.update({
    "keyed_rows": f"""
WITH {MEDIA_CTE}
SELECT {MEDIA_COLS}, {TAGS_TEXT.format(c="tags")} AS tags FROM media WHERE title_key IS NOT NULL
""",
    "consolidate_max": f"""
WITH {MEDIA_CTE}
SELECT title_key, max(title) AS title, max(l_partkey) AS l_partkey, max(l_quantity) AS l_quantity,
       max(l_extendedprice) AS l_extendedprice, max(l_linestatus) AS l_linestatus,
       max(l_shipdate) AS l_shipdate
FROM media WHERE title_key IS NOT NULL GROUP BY title_key
""",
    "consolidate_enum": f"""
SELECT o_custkey,
       {PRIORITY_OF_RANK.format(r=f"max({PRIORITY_RANK})")} AS o_orderpriority,
       {STATUS_OF_RANK.format(r=f"max({STATUS_RANK})")} AS o_orderstatus
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey
""",
    "consolidate_array": f"""
SELECT p_brand,
       {TAGS_TEXT.format(c="max(list_transform(string_split(p_name, ' '), lambda x: nullif(x, 'red')))")} AS words
FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
""",
    "collect_statuses": f"""
WITH {MEDIA_CTE},
each AS (SELECT title_key, status, count(*) AS n FROM media WHERE title_key IS NOT NULL GROUP BY ALL)
SELECT title_key, CAST(sum(n) AS BIGINT) AS n_statuses,
       CAST(coalesce(sum(n) FILTER (status IS NULL), 0) AS BIGINT) AS n_null_statuses,
       string_agg(coalesce(status, '~') || '=' || n, '|' ORDER BY coalesce(status, '~') || '=' || n) AS statuses
FROM each GROUP BY title_key
""",
    "derive_label": f"""
WITH {MEDIA_CTE},
{JUDGED}
SELECT DISTINCT title_key, (SELECT label FROM judged WHERE k = title_key) AS label
FROM media WHERE title_key IS NOT NULL
""",
    "new_keys_only": """
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""",
    "labelled_only": f"""
WITH {MEDIA_CTE},
{JUDGED}
SELECT k AS title_key, label FROM judged
""",
    "fill_title": f"""
WITH {MEDIA_CTE}
SELECT title_key, l_partkey, l_linenumber, coalesce(title, '') AS title FROM media
""",
    "stamp_utc": f"""
WITH {MEDIA_CTE},
{JUDGED}
SELECT k AS title_key, label, TIMESTAMP '2025-01-01 00:00:00' AS created_at,
       TIMESTAMP '2025-01-01 00:00:00' AS updated_at
FROM judged
""",
    "append_by_name": f"""
SELECT {ORDERS_COLS}, false AS reviewed FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR), false
FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'
""",
    "set_flag_all": "SELECT *, true AS reviewed FROM orders",
    "snapshot_copy": "SELECT * FROM orders",
    "snapshot_mapping": """
SELECT column_name AS source_column_name, column_name AS bak_column_name,
       CASE column_name WHEN 'o_orderpriority' THEN 'order_priority' WHEN 'o_orderstatus' THEN 'order_status' ELSE t END
           AS source_data_type,
       t AS bak_data_type,
       CASE column_name WHEN 'o_orderpriority' THEN 'order_priority' WHEN 'o_orderstatus' THEN 'order_status' END AS enum_name
FROM (SELECT column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
             WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS t FROM (DESCRIBE orders))
""",
    "snapshot_metadata": """
SELECT DATE '2025-01-01' AS backup_date, 'atp' AS source_schema, 'orders' AS source_table,
       'atp_orders_20250101' AS backup_table, TIMESTAMP '2025-01-01 00:00:00' AS created_at, count(*) AS snapshot_rows
FROM orders
""",
    "latest_snapshot": """
WITH s AS (SELECT *, strftime(o_orderdate, '%Y%m01') AS snapshot_date FROM orders)
SELECT * FROM s WHERE snapshot_date = (SELECT max(snapshot_date) FROM s)
""",
    "reconcile_columns": "SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus FROM orders",
    "restore_enums": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, CAST(NULL AS VARCHAR) AS o_comment
FROM orders
""",
    "reload_round_trip": """
WITH o AS (SELECT o_orderkey % 7 <> 0 AS stays, o_custkey % 11 = 0 AS twice FROM orders)
SELECT 'restored' AS compared, count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS lost,
       CAST(0 AS BIGINT) AS added, count(*) AS rows_inserted FROM o
UNION ALL
SELECT 'changed', count(*), count(*) FILTER (stays) + count(*) FILTER (twice),
       count(*) FILTER (NOT stays AND NOT twice), count(*) FILTER (stays AND twice), count(*) FROM o
UNION ALL
SELECT 'by key', count(*), count(*) FILTER (stays OR twice), count(*) FILTER (NOT stays AND NOT twice), 0, count(*) FROM o
UNION ALL
SELECT 'by digest', count(*), count(*) FILTER (stays) + count(*) FILTER (twice),
       count(*) FILTER (NOT stays AND NOT twice), count(*) FILTER (stays AND twice), count(*) FROM o
UNION ALL
SELECT 'a microsecond, by ' || how, count(*), count(*), count(*) FILTER (o_orderkey % 13 = 0), count(*) FILTER (o_orderkey % 13 = 0), count(*)
FROM orders, (VALUES ('key'), ('digest')) AS t(how) GROUP BY how
""",
    "check_violations": "\nUNION ALL\n".join(_rules_sql("lineitem", LINEITEM_RULES_SQL)
                                          + _rules_sql("part", PART_RULES_SQL)),
    "key_violations": f"""
WITH {MEDIA_CTE},
k AS (SELECT title_key, count(*) AS n FROM media WHERE title_key IS NOT NULL GROUP BY ALL HAVING count(*) > 1)
SELECT 'duplicate_key' AS check_name, 'title_key' AS column_name, count(*) AS violations FROM k
UNION ALL SELECT 'duplicate_row', 'title_key', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM k
UNION ALL SELECT 'not_null', 'title_key', count(*) FILTER (WHERE title_key IS NULL) FROM media
UNION ALL SELECT 'not_null', 'title', count(*) FILTER (WHERE title IS NULL) FROM media
UNION ALL SELECT 'not_null', 'status', count(*) FILTER (WHERE status IS NULL) FROM media
UNION ALL SELECT 'not_null', 'l_shipdate', count(*) FILTER (WHERE l_shipdate IS NULL) FROM media
UNION ALL SELECT 'enum_domain', 'l_returnflag',
    count(*) FILTER (WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('R', 'A')) FROM media
UNION ALL SELECT 'enum_domain', 'l_linestatus',
    count(*) FILTER (WHERE l_linestatus IS NOT NULL AND l_linestatus NOT IN ('O', 'F')) FROM media
""",
    "apply_defaults": """
SELECT * REPLACE (if(value >= 5, value, NULL) AS value), 'ingested' AS status, false AS error_status, CAST(1 AS INTEGER) AS weight,
       CAST(NULL AS VARCHAR) AS note
FROM events
""",
    "table_stats": "\nUNION ALL\n".join(
        [f"SELECT '{t}' AS table_name, true AS table_exists, count(*) AS row_count FROM {t}"
         for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                   "documents", "embeddings", "pages", "benchmark", "labels", "conversations")]
        + ["SELECT 'media', false, CAST(NULL AS BIGINT)"]),
    "flag_distribution": "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY quality, toxic",
    "null_pattern": """
SELECT l.quality IS NULL AS quality_is_null, l.toxic IS NULL AS toxic_is_null, count(*) AS n
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
GROUP BY ALL
""",
})


ORACLE["backup_reload_all"] = """
WITH t AS (
    SELECT 'orders' AS name, count(*) AS rows FROM orders
    UNION ALL SELECT 'customer', count(*) FROM customer
    UNION ALL SELECT 'part', count(*) FROM part
)
SELECT 'backup' AS action, 'atp.' || name AS source, 'success' AS status, rows, CAST(NULL AS VARCHAR) AS error,
       'bak.atp_' || name || '_20250101' AS target, CAST(NULL AS VARCHAR) AS skipped FROM t
UNION ALL
SELECT 'reload', 'bak.atp_' || name || '_20250101', 'success', rows, NULL, 'atp.' || name,
       CASE name WHEN 'part' THEN 'p_size: the target has no such column' END FROM t
UNION ALL
SELECT 'backup', 'atp.absent', 'failed', NULL, 'TableNotFound: no table atp.absent to back up', NULL, NULL
UNION ALL
SELECT 'reload', 'atp.absent', 'failed', NULL, 'SnapshotNotFound: bak holds no snapshot of atp.absent', NULL, NULL
"""

ORACLE["append_unique"] = """
WITH f AS (SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS keys, CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders WHERE o_orderstatus = 'F'),
a AS (SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS keys, CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders)
SELECT 'finished' AS step, 'appended' AS outcome, * FROM f
UNION ALL SELECT 'all', 'repeats the table', * FROM f
UNION ALL SELECT 'others', 'appended', * FROM a
UNION ALL SELECT 'again', 'repeats itself', * FROM a
"""

# Whoever came first: titles judged by the first two lines keep their values, all others have those of every line.
ORACLE["sync_concurrent"] = f"""
WITH {MEDIA_CTE},
first_lines AS (SELECT * FROM media WHERE l_linenumber <= 2),
seen AS (SELECT title_key AS k, true AS early, * EXCLUDE (title_key) FROM first_lines UNION ALL SELECT title_key, false, * EXCLUDE (title_key) FROM media),
tally AS (
    SELECT k, early, count(*) FILTER (status IN ('accepted', 'override')) AS favoured,
           count(*) FILTER (status = 'unfiltered') AS open, count(*) AS n
    FROM seen WHERE k IS NOT NULL GROUP BY ALL
),
judged AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY early DESC) AS turn FROM tally WHERE favoured > 0 OR open < n)
SELECT j.k AS title_key, if(any_value(j.favoured) > 0, 'would_watch', 'would_not_watch') AS label, coalesce(max(m.title), '') AS title,
       max(m.l_partkey) AS l_partkey, max(m.l_suppkey) AS l_suppkey, max(m.l_linenumber) AS l_linenumber,
       max(m.l_quantity) AS l_quantity, max(m.l_extendedprice) AS l_extendedprice,
       max(m.l_discount) AS l_discount, max(m.l_tax) AS l_tax,
       {FLAG_OF_RANK.format(r=f"max({FLAG_RANK})")} AS l_returnflag,
       max(m.l_linestatus) AS l_linestatus, max(m.l_shipdate) AS l_shipdate,
       {TAGS_TEXT.format(c="max(m.tags)")} AS tags
FROM seen m JOIN judged j ON m.k = j.k AND m.early = j.early AND j.turn = 1
GROUP BY j.k
"""

ORACLE["append_elements"] = f"""
WITH w AS (SELECT p_partkey, list_transform(string_split(p_name, ' '), lambda x: nullif(x, 'red')) AS words FROM part)
SELECT p_partkey, {TAGS_TEXT.format(c="list_transform(words, lambda x: (x || '   ')[1:5])")} AS words
FROM w WHERE len(list_filter(words, lambda x: length(x) > 5)) = 0
"""

ORACLE["consolidate_char"] = """
SELECT rpad(c_mktsegment, 12, ' ') AS segment, rpad(c_mktsegment, 12, ' ') AS greatest, max(c_acctbal) AS c_acctbal,
       CAST(length(c_mktsegment) AS INTEGER) AS letters
FROM customer c
WHERE NOT EXISTS (FROM customer o WHERE o.c_nationkey = 3 AND o.c_mktsegment LIKE 'B%' AND o.c_mktsegment = c.c_mktsegment)
GROUP BY c_mktsegment
"""

ORACLE["consolidate_collated"] = """
WITH n AS (SELECT p_brand, if(p_partkey % 3 = 0, upper(p_name), p_name) AS name FROM part),
k AS (
    SELECT p_brand, {'k': lower(name), 'v': name} AS t,
           list_transform(string_split(name, ' '), lambda x: {'n': x = 'red', 'k': if(x = 'red', '', lower(x)), 'v': if(x = 'red', '~', x)}) AS w
    FROM n WHERE p_brand IS NOT NULL
)
SELECT p_brand, max(t).v AS name, array_to_string(list_transform(max(w), lambda x: x.v), '|') AS words FROM k GROUP BY p_brand
"""

ORACLE["restore_newest"] = "SELECT *, '20250103' AS day FROM orders WHERE o_orderkey % 3 <= 1"
ORACLE["spec_json_load"] = "SELECT *, 'none' AS o_comment FROM orders"
