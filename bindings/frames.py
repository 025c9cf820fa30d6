"""Operational tables imitated from the test tables, in SQL that both engines accept.

Nulls, deletes, stale copies and faults come from natural column values, over all rows.
"""

from bindings.base import frame

# Business entities (the operational system). Times come from the entity's orders.
frame("entity", """
SELECT c.c_custkey AS id, c.c_name AS name, c.c_nationkey AS parent_id, c.c_mktsegment AS segment,
  CAST(c.c_acctbal AS DECIMAL(12,2)) AS balance,
  CASE WHEN c.c_acctbal < 0 THEN 'DELETED' WHEN c.c_mktsegment = 'FURNITURE' THEN 'DISABLED' ELSE 'ACTIVE' END AS status,
  CASE WHEN c.c_mktsegment = 'MACHINERY' AND c.c_acctbal > 8000 THEN NULL
       WHEN c.c_mktsegment = 'BUILDING' AND c.c_acctbal > 9000 THEN 'XXXXXXXXXXXXXXX'
       ELSE 'K-' || CAST(c.c_nationkey AS STRING) || '-' || CAST(CAST(floor(c.c_acctbal / 500) AS INT) AS STRING) END AS sync_key,
  a.inserted_at, a.updated_at, COALESCE(a.units, 0) AS units
FROM customer c
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS inserted_at, max(o_orderdate) AS updated_at,
                  CAST(count(*) AS INT) AS units FROM orders GROUP BY o_custkey) a ON a.o_custkey = c.c_custkey
""")

frame("parent", """
SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region_id, n_regionkey = 4 AS is_deleted FROM nation
""")

# Feature changes per entity: one row per order, code = priority, state = order status.
frame("feature_log", """
SELECT o_orderkey AS log_id, o_custkey AS entity_id, o_orderpriority AS code,
  CASE o_orderstatus WHEN 'O' THEN 'enabled' WHEN 'F' THEN 'disabled' ELSE 'pending' END AS state,
  o_orderdate AS changed_at, CAST(o_totalprice AS DECIMAL(12,2)) AS amount
FROM orders
""")

# Wide flags of one entity: two of the five codes as the flags, with time stamps.
frame("feature_wide", """
SELECT o_orderkey AS row_id, o_custkey AS entity_id,
  o_orderstatus = 'O' AS a_enabled, o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH' AS b_enabled,
  CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS a_updated_at,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS b_updated_at
FROM orders
""")

# Records of the target system: some segments are missing, several records share a key, some are deleted.
frame("target", """
SELECT 'T' || CAST(id AS STRING) AS target_id, sync_key, id AS source_id, name,
  CASE WHEN segment = 'AUTOMOBILE' THEN NULL WHEN balance > 5000 THEN name || ' Inc' ELSE name END AS target_name,
  CASE WHEN segment = 'HOUSEHOLD' AND balance > 7000 THEN TRUE ELSE FALSE END AS is_deleted,
  updated_at AS last_modified,
  CASE WHEN segment = 'AUTOMOBILE' THEN NULL ELSE balance > 3000 END AS a_enabled,
  units > 10 AS b_enabled, parent_id
FROM entity WHERE segment <> 'MACHINERY'
""")

# Checks with a result, linked to entities.
frame("checks", """
SELECT event_id AS id, user_id AS entity_id, ts AS inserted_at,
  CASE event_type WHEN 'purchase' THEN 'PASS' WHEN 'error' THEN 'FAIL' WHEN 'click' THEN 'NEEDS REVIEW' ELSE 'PENDING' END AS status,
  CASE WHEN event_type = 'signup' THEN NULL ELSE ts END AS results_at,
  CASE WHEN value < 20 THEN 'north' WHEN value < 60 THEN 'south' ELSE 'inhouse' END AS provider,
  CAST(replace(replace(props, '{"k": ', ''), '}', '') AS INT) AS level, props, CAST(value AS DECIMAL(12,2)) AS value
FROM events
""")

frame("checked", """
SELECT k.id, k.entity_id, k.inserted_at, k.status, k.results_at, k.provider, k.level, k.props, k.value,
  e.name AS entity_name, e.segment, e.parent_id, p.name AS parent_name, p.region_id
FROM checks k JOIN entity e ON k.entity_id = e.id JOIN parent p ON e.parent_id = p.id
WHERE k.results_at IS NOT NULL
""")

# Status log of work items: one item per user, ordered by time.
frame("status_log", """
SELECT event_id AS log_id, user_id AS item_id, event_type AS status, ts AS changed_at,
  CAST(value AS DECIMAL(12,2)) AS value FROM events
""")

# Catalogue texts with series markers, for text rules.
frame("item", """
SELECT p_partkey AS id, p_name || CASE WHEN p_size <= 9 THEN ' Phase ' || CAST(p_size AS STRING)
    WHEN p_size <= 12 THEN ' phase ii' WHEN p_size <= 14 THEN ' test' WHEN p_size <= 16 THEN '-demo' ELSE '' END AS name,
  p_brand AS brand, p_type AS kind, p_size AS size, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
  CASE WHEN p_type = 'PROMO' THEN 'DISABLED' ELSE 'ACTIVE' END AS status
FROM part
""")

# Two systems holding addresses. A source row may store the target's id; a target row may carry an override.
frame("src_site", """
SELECT p_partkey AS source_id, p_name AS name, CASE WHEN p_size > 25 THEN 'T' || CAST(p_partkey AS STRING) END AS target_ref,
  CASE WHEN p_size = 50 THEN NULL ELSE ' ' || p_name END AS street, p_brand AS city, p_type AS state,
  CASE WHEN p_size < 10 THEN '0123' ELSE '90210-11' END AS zip,
  CAST(substr(p_brand, 7) AS INT) AS owner_id, 'ACTIVE' AS status, p_size AS size
FROM part
""")

frame("tgt_site", """
SELECT 'T' || CAST(p_partkey AS STRING) AS target_id, p_name AS name, upper(p_name) AS street, upper(p_brand) || ' ' AS city,
  lower(p_type) AS state, CASE WHEN p_size < 10 THEN '123' ELSE '90210' END AS zip,
  CASE WHEN p_size = 7 OR p_size = 30 THEN p_partkey END AS override_id, p_type = 'PROMO' AS is_deleted
FROM part
""")

frame("owner", """
SELECT CAST(s_suppkey AS INT) AS owner_id, s_name AS owner_name, s_acctbal > 4000 AS is_partner FROM supplier
""")

# People with comparable identity fields.
frame("person", """
SELECT p_partkey AS id, upper(p_name) AS full_name,
  lower(replace(p_type, 'E', 'e.')) || '+x@' || lower(replace(p_brand, '#', '')) || '.com' AS email,
  '(555) 12-' || CAST(p_size AS STRING) AS phone, p_brand AS site
FROM part
""")

# Applicants, their submissions by channel with review results, and identity checks.
frame("applicant", """
SELECT o.o_orderkey AS applicant_id, o.o_custkey AS entity_id, c.c_nationkey AS place_id, o.o_orderdate AS submitted_at, o.o_orderdate AS created_at
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
""")

frame("submission", """
SELECT l_orderkey AS applicant_id, l_partkey AS submission_id, l_shipdate AS created_at, l_suppkey AS check_id,
  CASE l_returnflag WHEN 'A' THEN 'BANK_LINKING' WHEN 'R' THEN 'CONNECTED_PAYROLL' ELSE 'DOCUMENT_UPLOAD' END AS source_type,
  CASE WHEN l_quantity > 40 THEN 'ACCEPTED' WHEN l_quantity < 10 THEN 'REJECTED' ELSE 'PENDING' END AS income_status,
  CASE WHEN l_quantity < 10 THEN 'income reason ' || CAST(l_linenumber AS STRING) END AS income_reason,
  CASE WHEN l_extendedprice > 80000 THEN 'ACCEPTED' WHEN l_extendedprice < 20000 THEN 'REJECTED' ELSE 'PENDING' END AS asset_status,
  CASE WHEN l_extendedprice < 20000 THEN 'asset reason ' || l_linestatus END AS asset_reason
FROM lineitem
""")

frame("identity_check", """
SELECT user_id AS applicant_id, event_id AS check_id, CASE event_type WHEN 'purchase' THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM events
""")

# The daily log of a sync, one row per day, made from the event stream.
frame("audit_log", """
SELECT 'run-' || CAST(CAST(ts AS DATE) AS STRING) AS audit_id, 'sync' AS sync_name, 'UPDATE' AS sync_type, max(ts) AS execution_timestamp,
  CAST(count(*) AS INT) AS records_processed, CAST(sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS INT) AS records_succeeded
FROM events GROUP BY CAST(ts AS DATE)
""")

# Statements that name tables, as text with the user and time of execution.
frame("statement", """
SELECT e.event_id AS id, 'user ' || CAST(e.user_id AS STRING) AS executed_by, e.ts AS start_time,
  CASE e.event_type WHEN 'purchase' THEN 'INSERT' WHEN 'signup' THEN 'UPDATE' ELSE 'SELECT' END AS kind,
  CASE e.event_type WHEN 'purchase' THEN 'insert into app.core.t' || replace(replace(e.props, '{"k": ', ''), '}', '') || ' select * FROM app.core.t1 a JOIN `app.core.t1` b'
    WHEN 'signup' THEN 'update app.core.t' || replace(replace(e.props, '{"k": ', ''), '}', '') || ' set x = 1'
    WHEN 'view' THEN 'SELECT 1' ELSE 'select * from app.core.t' || replace(replace(e.props, '{"k": ', ''), '}', '') || ' where x in (select y from other.core.t2)' END AS statement_text
FROM events e
""")

# A change feed: inserts, updates and deletes of entities with a version that is not the order of arrival.
frame("change_feed", """
SELECT user_id AS id, event_type AS status, CAST(value AS DECIMAL(12,2)) AS amount,
  CASE WHEN event_type = 'error' AND value > 60 THEN 'delete' WHEN event_type = 'signup' THEN 'insert' ELSE 'update' END AS _change_type,
  event_id AS _commit_version, ts AS _change_timestamp
FROM events
""")
