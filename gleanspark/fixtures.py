"""Views derived from the test tables, in SQL that Spark and DuckDB both run.

The same text is registered as a temporary view on the Spark side and inlined
as a common table expression in the oracle SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

VIEWS = {
    "fx_resources": """
SELECT l_orderkey AS package_id,
  CASE WHEN l_suppkey % 17 = 0 THEN NULL WHEN l_suppkey % 17 = 1 THEN ''
       ELSE concat(CAST(l_orderkey AS STRING),
                   CASE l_linenumber % 3 WHEN 0 THEN '/' WHEN 1 THEN '__' ELSE '-' END,
                   CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-',
                   CAST(l_suppkey AS STRING)) END AS id,
  CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN concat('v', CAST(p_partkey AS STRING))
       WHEN p_size = 3 THEN concat('Contracts Finder ', p_name)
       WHEN p_size = 4 THEN concat(p_name, ' (CSV Version)')
       WHEN p_size = 5 THEN concat(p_name, '__', p_type)
       ELSE concat(' ', p_name, ': ', p_type, ' ') END AS name,
  CASE l_returnflag WHEN 'A' THEN 'CSV' WHEN 'N' THEN 'json' ELSE 'XLS' END AS format,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'O' THEN 'en' ELSE 'fr' END AS language,
  CASE WHEN l_partkey % 19 = 0 THEN NULL WHEN l_partkey % 19 = 1 THEN ''
       WHEN l_linenumber % 4 = 0 THEN concat('dataset/', CAST(l_partkey AS STRING))
       ELSE concat('https://data.example.org/', CAST(l_orderkey AS STRING), '/', CAST(l_partkey AS STRING)) END AS url
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "fx_responses": """
SELECT doc_id, concat('https://data.example.org/d/', CAST(doc_id AS STRING)) AS url,
  CASE doc_id % 11 WHEN 0 THEN 404 WHEN 1 THEN 500 WHEN 2 THEN 302 ELSE 200 END AS status,
  CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 23 = 1 THEN 'abc' ELSE CAST(n_chars AS STRING) END AS content_length,
  CASE doc_id % 6 WHEN 0 THEN 'application/zip' WHEN 1 THEN 'application/vnd.ms-excel'
       WHEN 2 THEN 'application/csv' WHEN 3 THEN 'text/csv; charset=utf-8' WHEN 4 THEN NULL ELSE 'text/html' END AS content_type
FROM documents""",
    "fx_cells": """
SELECT event_id, event_type AS kind,
  CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE CAST(user_id AS STRING) END AS int_cell,
  CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(event_id % 1000 AS STRING) END AS num_cell,
  CASE WHEN event_id % 19 = 0 THEN 'bad' ELSE concat('2024-0', CAST(1 + event_id % 9 AS STRING), '-15') END AS ymd_cell,
  concat('2024-0', CAST(1 + event_id % 9 AS STRING)) AS my_cell,
  CAST(2000 + event_id % 25 AS STRING) AS y_cell
FROM events""",
    "fx_tree_edges": """
SELECT concat('r', CAST(r_regionkey AS STRING)) AS node_id, CAST(NULL AS STRING) AS parent_id, r_name AS title FROM region
UNION ALL
SELECT concat('n', CAST(n_nationkey AS STRING)), concat('r', CAST(n_regionkey AS STRING)), n_name FROM nation
UNION ALL
SELECT concat('s', CAST(s_suppkey AS STRING)), concat('n', CAST(s_nationkey AS STRING)), s_name FROM supplier
UNION ALL
SELECT concat('c', CAST(c_custkey AS STRING)), concat('n', CAST(c_nationkey AS STRING)), c_name FROM customer
UNION ALL
SELECT concat('o', CAST(o_orderkey AS STRING)), concat('c', CAST(o_custkey AS STRING)), o_orderpriority FROM orders""",
    # Customers in groups of ten: chains, cycles with a tail, stars; orders below them.
    "fx_linked_edges": """
SELECT concat('c', lpad(CAST(k AS STRING), 9, '0')) AS node_id,
  CASE WHEN g % 3 <> 1 AND i = 0 THEN NULL
       ELSE concat('c', lpad(CAST(CASE WHEN g % 3 = 2 THEN g * 10 WHEN g % 3 = 1 AND i <= g % 4 THEN g * 10 + (i + 1) % (g % 4 + 1) ELSE k - 1 END AS STRING), 9, '0')) END AS parent_id,
  c_name AS title
FROM (SELECT c_name, c_custkey AS k, CAST(floor(c_custkey / 10) AS BIGINT) AS g, c_custkey % 10 AS i FROM customer) AS numbered
UNION ALL
SELECT concat('o', CAST(o_orderkey AS STRING)), concat('c', lpad(CAST(o_custkey AS STRING), 9, '0')), o_orderpriority FROM orders""",
    # Two harvests of one catalogue, a package per order; in the second, packages stand on the next page again.
    "fx_harvest_before": """
SELECT o_orderpriority AS portal, CAST(o_orderkey AS STRING) AS id, o_orderkey AS page_no, o_orderstatus AS title, o_custkey AS owner
FROM orders WHERE o_orderkey % 10 <> 3""",
    "fx_harvest_after": """
SELECT o_orderpriority AS portal, CAST(o_orderkey AS STRING) AS id, o_orderkey AS page_no,
  CASE WHEN o_orderkey % 6 = 0 THEN concat('new ', o_orderstatus) ELSE o_orderstatus END AS title,
  CASE WHEN o_orderkey % 50 = 1 THEN NULL ELSE o_custkey END AS owner
FROM orders WHERE o_orderkey % 10 <> 7
UNION ALL
SELECT o_orderpriority, CAST(o_orderkey AS STRING), o_orderkey + 1, CASE WHEN o_orderkey % 50 = 0 THEN 'late' ELSE o_orderstatus END, o_custkey
FROM orders WHERE o_orderkey % 25 = 0""",
    "fx_tree_nodes": """
SELECT concat('c', CAST(c_custkey AS STRING)) AS node_id,
  concat('<b><span class="node"> ', c_name, '/', CAST(c_custkey AS STRING), ' </span></b>') AS label,
  CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN concat('docID:', CAST(c_custkey AS STRING))
       ELSE concat('series:', CAST(c_custkey AS STRING)) END AS data_filter,
  concat('m', CAST(c_nationkey AS STRING)) AS mart_id
FROM customer""",
    "fx_runs": """
SELECT event_type AS portal, concat('run_', lpad(CAST(event_id AS STRING), 12, '0')) AS run_name
FROM events""",
    "fx_search_hits": """
SELECT o_orderkey AS hit_id,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 9 = 1 THEN ''
       ELSE concat('DB_', o_orderpriority) END AS database_id
FROM orders""",
    # One reply per order: a page of indicator ids, failed for one status.
    "fx_indicator_pages": """
SELECT concat('DB_', o_orderpriority) AS database_id,
  CASE o_orderstatus WHEN 'F' THEN 500 ELSE 200 END AS status,
  concat('["C', CAST(o_custkey AS STRING), '","O', CAST(o_orderkey AS STRING), '"]') AS body
FROM orders""",
    # Requests for rows, one per order: pages that leave gaps and that overlap.
    "fx_row_pages": """
SELECT o_orderpriority AS dataset_id, o_orderkey * 10 AS page_offset, 6 + o_custkey % 9 AS page_rows FROM orders""",
    "fx_places": """
SELECT event_id, event_type, value, (event_id * 7919) % 180001 / 1000.0e0 - 90 AS lat, (event_id * 104729) % 359999 / 1000.0e0 - 180 AS lon
FROM events""",
    "fx_circles": """
SELECT c_custkey, (c_custkey * 6007) % 180001 / 1000.0e0 - 90 AS center_lat, (c_custkey * 15013) % 359999 / 1000.0e0 - 180 AS center_lon,
  50000.0e0 * (1 + c_custkey % 9) AS radius
FROM customer""",
    # Dates as five portals write them, by kind of event: day first, month first, either, both, and with other layouts.
    "fx_mixed_dates": """
SELECT event_id, event_type AS kind, d, m, y, CASE CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 ELSE 4 END
  WHEN 0 THEN concat(CAST(d AS STRING), '/', CAST(m AS STRING), '/', CAST(y AS STRING))
  WHEN 1 THEN concat(CAST(m AS STRING), '/', CAST(d AS STRING), '/', CAST(y AS STRING))
  WHEN 2 THEN concat(CAST(1 + d % 12 AS STRING), '-', CAST(m AS STRING), '-', CAST(y AS STRING))
  WHEN 3 THEN CASE WHEN event_id % 11 = 0 THEN 'n/a' WHEN event_id % 2 = 0 THEN concat(CAST(d AS STRING), '/', CAST(m AS STRING), '/', CAST(y AS STRING))
    ELSE concat(CAST(m AS STRING), '/', CAST(d AS STRING), '/', CAST(y AS STRING)) END
  ELSE CASE WHEN event_id % 3 = 0 THEN concat(CAST(y AS STRING), '-', CAST(m AS STRING), '-', CAST(d AS STRING))
    ELSE concat(' ', CAST(d AS STRING), '.', CAST(m AS STRING), '.', CAST(y AS STRING)) END END AS cell
FROM (SELECT event_id, event_type, 1 + event_id % 28 AS d, 1 + (event_id * 7) % 12 AS m, 2000 + event_id % 25 AS y FROM events)""",
    # Catalogue entries of tabular datasets, one per part.
    "fx_entries": """
SELECT concat('ds-', CAST(p_partkey AS STRING)) AS dataset_id, p_size,
  CASE p_size % 3 WHEN 0 THEN 'Text' WHEN 1 THEN 'Calendar date' ELSE 'Number' END AS data_type,
  CASE p_size % 7 WHEN 0 THEN 'view' WHEN 1 THEN 'noCommas' WHEN 2 THEN 'align' ELSE NULL END AS format_key,
  CASE p_size % 5 WHEN 0 THEN 'date_ymd' WHEN 1 THEN 'true' WHEN 2 THEN 'false' WHEN 3 THEN 'date_y' ELSE 'odd' END AS format_value
FROM part""",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, or a derived view over the tables it names."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for table in set(re.findall(r"(?:FROM|JOIN) (\w+)", VIEWS[name])):
        load(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(VIEWS[name])


def with_views(sql: str, *names: str) -> str:
    """Oracle SQL with the derived views it uses as common table expressions."""
    ctes = ", ".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    return f"WITH {ctes} {sql.strip()}" if names else sql.strip()
