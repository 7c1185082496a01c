"""The same queries in DuckDB's SQL, over views named like the tables."""

from __future__ import annotations

MART_LINEITEMS = """
WITH li AS (
  SELECT *, l_shipdate + to_days(CAST(1 + (l_orderkey * 7 + l_linenumber * 3) % 30 AS INT)) AS l_receiptdate
  FROM lineitem)
SELECT l_orderkey AS "L_ORDERKEY", count(l_partkey) AS "count",
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_extendprice,
  CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(l_discount) AS mean_discount,
  CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / count(l_tax) AS mean_tax,
  avg(date_diff('day', CAST(l_shipdate AS DATE), CAST(l_receiptdate AS DATE))) AS delivery_days,
  CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS "A_return_flags",
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS "R_return_flags",
  CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS "N_return_flags"
FROM li GROUP BY l_orderkey
"""

MART_LINEITEMS_CORE = """
SELECT l_orderkey AS "L_ORDERKEY", count(l_partkey) AS "count",
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_extendprice,
  CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(l_discount) AS mean_discount,
  CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / count(l_tax) AS mean_tax,
  CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS "A_return_flags",
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS "R_return_flags",
  CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS "N_return_flags"
FROM lineitem GROUP BY l_orderkey
"""

MART_ORDERS = """
SELECT strftime(o_orderdate, '%Y-%m') AS "O_MONTH", n_name AS "N_NAME", o_orderpriority AS "O_ORDERPRIORITY",
  count(o_orderkey) AS orders_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_order_price,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_order_price,
  min(o_totalprice) AS min_order_price, max(o_totalprice) AS max_order_price,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS f_order_status,
  CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS o_order_status,
  CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS p_order_status
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
GROUP BY strftime(o_orderdate, '%Y-%m'), n_name, o_orderpriority
"""

MART_CUSTOMERS = """
SELECT r_name AS "R_NAME", n_name AS "N_NAME", c_mktsegment AS "C_MKTSEGMENT",
  count(c_custkey) AS unique_customers_count,
  CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS avg_acctbal,
  CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS mean_acctbal,
  min(c_acctbal) AS min_acctbal, max(c_acctbal) AS max_acctbal
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, n_name, c_mktsegment
"""

MART_SUPPLIERS = """
SELECT r_name AS "R_NAME", n_name AS "N_NAME", count(s_suppkey) AS unique_supplers_count,
  CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(s_acctbal) AS avg_acctbal,
  CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(s_acctbal) AS mean_acctbal,
  min(s_acctbal) AS min_acctbal, max(s_acctbal) AS max_acctbal
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, n_name
"""

MART_PARTS = """
WITH px AS (
  SELECT *, (['SM','MED','LG','JUMBO','WRAP'])[p_partkey % 5 + 1] || ' ' ||
    (['CASE','BOX','BAG','JAR','PKG','PACK','CAN','DRUM'])[(p_partkey // 5) % 8 + 1] AS p_container
  FROM part),
ps AS (
  SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey,
    CAST(100 + (l_partkey * 31 + l_suppkey * 17) % 99901 AS DOUBLE) / 100 AS ps_supplycost
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))
SELECT n_name AS "N_NAME", p_type AS "P_TYPE", p_container AS "P_CONTAINER", count(p_partkey) AS parts_count,
  CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(p_retailprice) AS avg_retailprice,
  CAST(sum(p_size) AS BIGINT) AS "size",
  CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(p_retailprice) AS mean_retailprice,
  min(p_retailprice) AS min_retailprice, max(p_retailprice) AS max_retailprice,
  CAST(sum(CAST(ps_supplycost AS DECIMAL(18,2))) AS DOUBLE) / count(ps_supplycost) AS avg_supplycost,
  CAST(sum(CAST(ps_supplycost AS DECIMAL(18,2))) AS DOUBLE) / count(ps_supplycost) AS mean_supplycost,
  min(ps_supplycost) AS min_supplycost, max(ps_supplycost) AS max_supplycost
FROM px JOIN ps ON p_partkey = ps_partkey JOIN supplier ON ps_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
GROUP BY n_name, p_type, p_container
"""

MARTS = {
    "lineitems": MART_LINEITEMS,
    "orders": MART_ORDERS,
    "customers": MART_CUSTOMERS,
    "suppliers": MART_SUPPLIERS,
    "parts": MART_PARTS,
}

DOUBLED_NATIONS = (
    "(SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_nationkey < 3) n"
)


DAMAGED_LINES = """
SELECT l_linenumber,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN -l_orderkey ELSE l_orderkey END
    AS l_orderkey,
  CASE WHEN l_linenumber = 5 THEN 'X' ELSE l_returnflag END AS l_returnflag
FROM lineitem"""

URL_NUMBERS = """
SELECT page_id, CASE WHEN page_id % 5 = 0 THEN regexp_extract(url, '([0-9]+)', 1) || 'x'
  ELSE regexp_extract(url, '([0-9]+)', 1) END AS n
FROM pages"""

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"
TRIMMED = f"""
SELECT doc_id, nullif(trim(CASE WHEN doc_id % 7 = 0 THEN ' ' || chr(9) || chr(10)
    WHEN doc_id % 3 = 0 THEN chr(9) || chr(10) || ' ' || text || ' ' || chr(13) || chr(10)
    ELSE text END, {_WHITE}), '') AS text
FROM documents"""


def oracle_sql() -> dict[str, str]:
    tables = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    return {
        **{f"scan_{t}": f"SELECT * FROM {t}" for t in tables},
        "scan_partsupp": """
SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey,
  CAST(100 + (l_partkey * 31 + l_suppkey * 17) % 99901 AS DOUBLE) / 100 AS ps_supplycost
FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)""",
        "project_lineitem_flags": """
SELECT l_orderkey, l_partkey, l_extendedprice, l_discount, l_tax,
  CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS a_flag,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS r_flag,
  CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS n_flag
FROM lineitem""",
        "derive_order_columns": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS o_month,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS f_order_status,
  CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS o_order_status,
  CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS p_order_status
FROM orders""",
        "join_left": """
SELECT o_orderkey, c_custkey, c_nationkey
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
        "join_inner": """
SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
        "join_star_3way": """
SELECT s_suppkey, n_name, r_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
        "join_left_orphans": """
SELECT r_name AS "R_NAME", n_name AS "N_NAME", c_mktsegment AS "C_MKTSEGMENT",
  count(c_custkey) AS unique_customers_count
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) r ON n_regionkey = r_regionkey
GROUP BY r_name, n_name, c_mktsegment""",
        "join_inner_orphans": """
SELECT r_name AS "R_NAME", n_name AS "N_NAME", count(s_suppkey) AS unique_supplers_count
FROM supplier JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n ON s_nationkey = n_nationkey
  JOIN (SELECT * FROM region WHERE r_regionkey <> 2) r ON n_regionkey = r_regionkey
GROUP BY r_name, n_name""",
        "join_fanout": f"""
SELECT n_name AS "N_NAME", count(c_custkey) AS n_count
FROM customer JOIN {DOUBLED_NATIONS} ON c_nationkey = n_nationkey
GROUP BY n_name""",
        "agg_count": """
SELECT l_orderkey, count(p) AS cnt
FROM (SELECT l_orderkey, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_partkey END AS p FROM lineitem)
GROUP BY l_orderkey""",
        "agg_sum": """
SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_order_price
FROM orders GROUP BY o_orderpriority""",
        "agg_sum_scale4": """
SELECT l_returnflag, CAST(sum(
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) AS DECIMAL(18,4))
  ) AS DOUBLE) AS sum_amount
FROM lineitem GROUP BY l_returnflag""",
        "agg_sum_doubles": """
SELECT l_returnflag, round(fsum(net), 2) AS sum_net, round(fsum(net) / count(net), 2) AS avg_net
FROM (SELECT l_returnflag, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS net FROM lineitem)
GROUP BY l_returnflag
""",
        "agg_sum_int": """
SELECT p_type, CAST(sum(p_size) AS BIGINT) AS total_size FROM part GROUP BY p_type""",
        "agg_conditional_count": """
SELECT l_orderkey, CAST(sum(CASE WHEN f = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS a_flags,
  CAST(sum(CASE WHEN f = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS r_flags
FROM (SELECT l_orderkey, nullif(l_returnflag, 'A') AS f FROM lineitem)
GROUP BY l_orderkey""",
        "agg_avg_mean": """
SELECT c_mktsegment,
  CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS avg_acctbal,
  CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS mean_acctbal
FROM customer GROUP BY c_mktsegment""",
        "agg_min_max": """
SELECT p_type, min(p_retailprice) AS min_retailprice, max(p_retailprice) AS max_retailprice
FROM part GROUP BY p_type""",
        "agg_count_vs_distinct": f"""
SELECT n_name AS "N_NAME", count(c_custkey) AS n_count, count(DISTINCT c_custkey) AS n_distinct
FROM customer JOIN {DOUBLED_NATIONS} ON c_nationkey = n_nationkey
GROUP BY n_name""",
        "fn_to_date": "SELECT event_id, CAST(ts AS DATE) AS event_date FROM events",
        "fn_datediff": """
SELECT l_orderkey, l_linenumber,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS ship_lag_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "fn_month_label": "SELECT event_id, strftime(ts, '%Y-%m') AS event_month FROM events",
        "fn_case_flag": """
SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'F') = 'F' THEN 1 ELSE 0 END AS f_flag,
  CASE WHEN nullif(o_orderstatus, 'F') = 'O' THEN 1 ELSE 0 END AS o_flag
FROM orders""",
        **{f"mart_{name}": sql for name, sql in MARTS.items()},
        "mart_lineitems_core": MART_LINEITEMS_CORE,
        "sink_overwrite_roundtrip": MART_ORDERS,
        "sink_coalesce_roundtrip": f"SELECT *, CAST(4 AS BIGINT) AS n_files FROM ({MART_ORDERS})",
        "sink_sized_roundtrip": """
SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(1 AS BIGINT) AS files_fit FROM lineitem
""",
        "sink_recovered_roundtrip": f"SELECT *, CAST(1 AS BIGINT) AS recovered FROM ({MART_SUPPLIERS})",
        **{f"serve_{name}": sql for name, sql in MARTS.items()},
        "serve_repointed": f"""
SELECT *, CAST(1 AS BIGINT) AS repointed, CAST(1 AS BIGINT) AS old_run_removed FROM ({MART_ORDERS})
""",
        "validate_rules": f"""
WITH lineitem AS ({DAMAGED_LINES})
SELECT 'lineitem_key_null' AS rule, count(*) FILTER (WHERE l_orderkey IS NULL) AS violations FROM lineitem
UNION ALL
SELECT 'lineitem_key_duplicate', count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL
SELECT 'lineitem_orphan_order', count(*) FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
UNION ALL
SELECT 'returnflag_domain', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'R', 'N')) FROM lineitem
UNION ALL
SELECT unnest(['schema_missing', 'schema_extra', 'schema_type']), unnest([1, 1, 1])""",
        "parse_typed": f"""
SELECT page_id, TRY_CAST(n AS BIGINT) AS url_number FROM ({URL_NUMBERS})""",
        "parse_rejects": f"""
SELECT page_id, 'url_number' AS column_name, n AS bad_text FROM ({URL_NUMBERS})
WHERE n IS NOT NULL AND TRY_CAST(n AS BIGINT) IS NULL""",
        "clean_rows": f"""
SELECT doc_id, text FROM ({TRIMMED}) WHERE text IS NOT NULL""",
        "clean_quarantine": f"""
SELECT doc_id, text FROM ({TRIMMED}) WHERE text IS NULL""",
        "dedup_latest": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)
WHERE rn = 1""",
    }
