"""A19-A21, A25-A39, A42-A48."""

from pyspark.sql import functions as F

from bindings.base import AS_OF_EVENTS, AS_OF_ORDERS, query
from crosswalk.operators import aggregates as A
from crosswalk.operators.filters import relative_time
from crosswalk.plans import inventory

SENTINEL = ["XXXXXXXXXXXXXXX"]
VALID = "sync_key IS NOT NULL AND sync_key <> 'XXXXXXXXXXXXXXX'"


@query("a19_duplicate_groups", f"""
SELECT sync_key, count(*) AS copies, min(inserted_at) AS oldest, max(inserted_at) AS newest FROM entity WHERE {VALID} GROUP BY sync_key HAVING count(*) > 1
""")
def a19(i):
    return A.duplicate_groups(i.entity, "sync_key", "inserted_at", SENTINEL)


@query("a20_duplicate_rows", f"""
SELECT * FROM (SELECT id, name, sync_key, status, count(*) OVER (PARTITION BY sync_key) AS copies FROM entity WHERE {VALID}) WHERE copies > 1
""")
def a20(i):
    return A.duplicate_rows(i.entity, "sync_key", SENTINEL).select("id", "name", "sync_key", "status", "copies")


@query("a20_duplicate_status", f"""
WITH g AS (SELECT sync_key, count(*) AS n, count(*) FILTER (WHERE status = 'ACTIVE') AS a, count(*) FILTER (WHERE status = 'DISABLED') AS d FROM entity WHERE {VALID} GROUP BY sync_key HAVING count(*) > 1),
m AS (SELECT e.* FROM entity e JOIN g ON g.sync_key = e.sync_key WHERE e.status = 'DISABLED')
SELECT (SELECT count(*) FROM m) AS disabled_rows, (SELECT count(DISTINCT sync_key) FROM m) AS groups_with_disabled, (SELECT min(inserted_at) FROM m) AS oldest, (SELECT max(inserted_at) FROM m) AS newest,
  (SELECT count(*) FROM g WHERE a = 0) AS groups_without_active, (SELECT CAST(COALESCE(sum(n), 0) AS BIGINT) FROM g WHERE a = 0) AS rows_in_those_groups
""")
def a20_status(i):
    return A.duplicate_status(i.entity, "sync_key", "status", "inserted_at", SENTINEL)


@query("a21_duplicate_name_class", """
SELECT brand, count(*) AS copies, CASE WHEN count(DISTINCT regexp_replace(lower(kind), '[^a-z0-9]', '', 'g')) = 1 THEN 'LIKELY_MIGRATION' ELSE 'DIFFERENT_NAMES' END AS issue_category FROM (
  SELECT brand || '/' || CAST(size AS STRING) AS brand, kind FROM item) GROUP BY brand HAVING count(*) > 1
""")
def a21_class(i):
    rows = i.item.select(F.concat_ws("/", "brand", F.col("size").cast("string")).alias("brand"), "kind")
    return A.duplicate_name_class(rows, "brand", "kind")


@query("a21_duplicate_triage", f"""
WITH m AS (SELECT * FROM (SELECT id, sync_key, count(*) OVER (PARTITION BY sync_key) AS copies FROM entity WHERE {VALID} AND status = 'ACTIVE') WHERE copies > 1),
f AS (SELECT entity_id, count(DISTINCT code) AS n FROM feature_log WHERE state = 'enabled' GROUP BY entity_id)
SELECT m.id, m.sync_key, m.copies, COALESCE(f.n, 0) AS features_enabled, t.source_id IS NOT NULL AS in_target, COALESCE(f.n, 0) * 10 + CASE WHEN t.source_id IS NULL THEN 5 ELSE 0 END AS priority_score,
  CASE WHEN COALESCE(f.n, 0) > 0 AND t.source_id IS NULL THEN 'P1 - URGENT' WHEN COALESCE(f.n, 0) > 0 THEN 'P2 - HIGH' WHEN t.source_id IS NULL THEN 'P3 - MEDIUM' ELSE 'P4 - LOW' END AS priority_level
FROM m LEFT JOIN f ON f.entity_id = m.id LEFT JOIN target t ON t.source_id = m.id
""")
def a21(i):
    members = A.duplicate_rows(i.entity.filter("status = 'ACTIVE'"), "sync_key", SENTINEL).select("id", "sync_key", "copies")
    features = i.feature_log.filter("state = 'enabled'").groupBy(F.col("entity_id").alias("id")).agg(F.count_distinct("code").alias("features_enabled"))
    known = i.target.select(F.col("source_id").alias("id"), F.lit(True).alias("known")).distinct()
    rows = members.join(features, "id", "left").join(known, "id", "left").fillna(0, ["features_enabled"])
    return A.duplicate_triage(rows, "features_enabled", F.col("known")).drop("known")


@query("a25_period_share_monthly", """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority, o_orderstatus FROM orders)
SELECT period, count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P", count(*) AS total,
  round(100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'O') / count(*), 1) AS "O_pct", round(100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 1) AS "F_pct",
  round(100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'P') / count(*), 1) AS "P_pct" FROM m GROUP BY period
""")
def a25(i):
    return A.period_share_pivot(i.orders, "o_orderdate", "o_orderstatus", ["O", "F", "P"], F.lit(1))


@query("a25_period_share_weekly", """
SELECT CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS STRING) AS period, CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS "O", count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
  count(*) FILTER (WHERE o_orderstatus IN ('O', 'F')) AS total, round(100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'O') / count(*), 1) AS "O_pct",
  round(100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 1) AS "F_pct" FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 ORDER BY 1 DESC LIMIT 8
""")
def a25_weekly(i):
    rows = i.orders.filter("o_orderstatus <> 'P'")
    return A.period_share_pivot(rows, "o_orderdate", "o_orderstatus", ["O", "F"], F.lit(1), "week", 8)


@query("a26_duration_stats", """
SELECT event_type, count(*) AS runs, round(CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(*), 4) AS avg_minutes, round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.95), 4) AS p95,
  min(value) AS min_minutes, max(value) AS max_minutes, count(*) FILTER (WHERE value < 100) AS successful, count(*) FILTER (WHERE NOT value < 100) AS failed,
  round(CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) * 30.0::DOUBLE / 30, 4) AS minutes_per_month, round(CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) * 30.0::DOUBLE / 30 * 0.1::DOUBLE * 0.15::DOUBLE, 4) AS monthly_cost
FROM events GROUP BY event_type
""")
def a26(i):
    rows = i.events.withColumn("minutes", F.col("value").cast("decimal(12,2)"))
    return A.duration_stats(rows, ["event_type"], "minutes", F.col("value") < 100, 30, 0.1, 0.15)


@query("a26_price_percentiles", """
SELECT round(quantile_cont(l_extendedprice, 0.5), 2) AS median, round(quantile_cont(l_extendedprice, 0.95), 2) AS p95,
  round(quantile_cont(l_extendedprice, 0.01), 2) AS p01 FROM lineitem
""")
def a26_percentiles(i):
    from crosswalk.functions.scale import percentiles

    rows = i.lineitem.select(F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))
    out = percentiles(rows, [], "price", {"median": 0.5, "p95": 0.95, "p01": 0.01})
    return out.select(*[F.round(c, 2).alias(c) for c in out.columns])


OPENED = "AND ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 DAYS AND ts < TIMESTAMP '2024-01-31 00:00:00'"


@query("a27_age_distribution", f"""
WITH h AS (SELECT (epoch_us(TIMESTAMP '{AS_OF_EVENTS}') - epoch_us(ts))::DOUBLE / 3600000000 AS hours FROM events WHERE event_type = 'error' {OPENED}),
b AS (SELECT CASE WHEN hours < 24 THEN '< 24 hours' WHEN hours < 48 THEN '24-48 hours' WHEN hours < 168 THEN '2-7 days' ELSE '> 7 days' END AS age_bucket FROM h)
SELECT age_bucket, count(*) AS row_count, CASE age_bucket WHEN '< 24 hours' THEN 1 WHEN '24-48 hours' THEN 2 WHEN '2-7 days' THEN 3 ELSE 4 END AS sort_order FROM b GROUP BY 1
""")
def a27(i):
    rows = i.events.filter("event_type = 'error'").filter(relative_time("ts", 30, "DAYS", AS_OF_EVENTS))
    return A.age_distribution(rows, "ts", AS_OF_EVENTS)


@query("a27_open_hours", f"""
SELECT event_type, count(*) AS open_rows, round(CAST(sum(epoch_us(TIMESTAMP '{AS_OF_EVENTS}') - epoch_us(ts)) AS DOUBLE) / count(*) / 3600000000, 4) AS avg_hours_open FROM events GROUP BY event_type
""")
def a27_hours(i):
    return A.open_hours_by(i.events, "event_type", "ts", AS_OF_EVENTS)


@query("a27_case_rate", """
SELECT n_name, CAST(sum(n) AS BIGINT) AS case_count, count(*) AS base_count, round(100.0::DOUBLE * sum(n) / count(*), 2) AS case_rate FROM (
  SELECT n.n_name, (SELECT count(*) FROM events e WHERE e.user_id = c.c_custkey AND e.event_type = 'error') AS n FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey)
GROUP BY n_name HAVING count(*) > 10 ORDER BY case_rate DESC, n_name LIMIT 20
""")
def a27_rate(i):
    base = i.customer.join(i.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return A.case_rate(base, i.events.filter("event_type = 'error'"), "c_custkey", "n_name", "user_id", top=20)


@query("a28_category_share", """
SELECT n.n_name, count(s.s_suppkey) AS row_count, round(100.0::DOUBLE * count(s.s_suppkey) / sum(count(s.s_suppkey)) OVER (), 2) AS percentage
FROM nation n LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey AND s.s_acctbal > 7000 GROUP BY n.n_name
""")
def a28(i):
    counted = A.category_share(i.nation.select("n_nationkey", "n_name"), i.supplier.filter("s_acctbal > 7000"), "n_nationkey", "s_nationkey")
    return counted.drop("n_nationkey")


@query("a28_category_trend", "SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, count(*) AS row_count FROM orders GROUP BY 1, 2")
def a28_trend(i):
    return A.category_trend(i.orders, "o_orderdate", "o_orderpriority")


FIRST = """
o AS (SELECT user_id AS case_id, min(ts) AS opened_at FROM events WHERE event_type = 'error' GROUP BY user_id),
r AS (SELECT e.user_id AS case_id, e.ts AS reply_at, 'agent ' || CAST(CAST(floor(e.value / 50) AS INT) AS STRING) AS agent, e.event_id FROM events e JOIN o ON o.case_id = e.user_id AND e.ts > o.opened_at WHERE e.event_type = 'view'),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY reply_at, event_id) AS rn FROM r) WHERE rn = 1)
"""


def first(i):
    opened = i.events.filter("event_type = 'error'").groupBy(F.col("user_id").alias("case_id")).agg(F.min("ts").alias("opened_at"))
    agent = F.concat(F.lit("agent "), F.floor(F.col("value") / 50).cast("int").cast("string")).alias("agent")
    replies = i.events.filter("event_type = 'view'").select(F.col("user_id").alias("case_id"), F.col("ts").alias("reply_at"), agent, "event_id")
    replies = replies.join(opened, "case_id").filter("reply_at > opened_at").drop("opened_at")
    return A.first_response(opened, replies, "case_id", "opened_at", "reply_at", "agent", "event_id")


@query("a29_first_response", f"""
WITH {FIRST} SELECT o.case_id, o.opened_at, f.reply_at AS first_response_at, f.agent, round((epoch_us(f.reply_at) - epoch_us(o.opened_at))::DOUBLE / 3600000000, 4) AS response_hours FROM o JOIN f ON f.case_id = o.case_id
""")
def a29(i):
    return first(i)


@query("a29_response_by_agent", f"""
WITH {FIRST} SELECT f.agent, count(*) AS handled, round(CAST(sum(epoch_us(f.reply_at) - epoch_us(o.opened_at)) AS DOUBLE) / count(*) / 3600000000, 4) AS avg_response_hours FROM o JOIN f ON f.case_id = o.case_id GROUP BY f.agent
""")
def a29_agent(i):
    return A.response_by_agent(first(i), "opened_at")


STATES = {"successful": "F", "failed": "P", "pending": "O", "retrying": "R"}


@query("a30_status_rates", """
SELECT o_orderpriority, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS successful, count(*) FILTER (WHERE o_orderstatus = 'P') AS failed, count(*) FILTER (WHERE o_orderstatus = 'O') AS pending,
  count(*) FILTER (WHERE o_orderstatus = 'R') AS retrying, round(100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 2) AS success_pct FROM orders GROUP BY 1
""")
def a30(i):
    return A.status_rates(i.orders, ["o_orderpriority"], "o_orderstatus", STATES, "successful")


@query("a30_failures_only", """
SELECT o_custkey, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS successful, count(*) FILTER (WHERE o_orderstatus = 'P') AS failed, count(*) FILTER (WHERE o_orderstatus = 'O') AS pending,
  count(*) FILTER (WHERE o_orderstatus = 'R') AS retrying, round(100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 2) AS success_pct FROM orders GROUP BY 1 HAVING count(*) FILTER (WHERE o_orderstatus = 'P') > 0
""")
def a30_failures(i):
    return A.failures_only(A.status_rates(i.orders, ["o_custkey"], "o_orderstatus", STATES, "successful"), "failed")


@query("a31_service_health", """
SELECT 'orders' AS service, count(DISTINCT o_orderkey) AS total_processed, count(DISTINCT o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS successful,
  count(DISTINCT o_orderkey) FILTER (WHERE o_orderstatus <> 'F') AS failed, NULL::DOUBLE AS avg_minutes FROM orders
UNION ALL SELECT 'lines', count(DISTINCT l_orderkey), count(DISTINCT l_orderkey) FILTER (WHERE l_returnflag <> 'R'), count(DISTINCT l_orderkey) FILTER (WHERE l_returnflag = 'R'),
  round(CAST(sum(epoch_us(l_shipdate) - epoch_us(o_orderdate)) AS DOUBLE) / count(*) / 60000000, 4) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
UNION ALL SELECT 'events', count(DISTINCT event_id), count(DISTINCT event_id) FILTER (WHERE event_type <> 'error'), count(DISTINCT event_id) FILTER (WHERE event_type = 'error'), NULL FROM events
""")
def a31(i):
    lines = i.lineitem.join(i.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    spent = F.unix_micros(F.col("l_shipdate").cast("timestamp")) - F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    return A.service_health({
        "orders": (i.orders, "o_orderkey", F.col("o_orderstatus") == "F", None),
        "lines": (lines, "l_orderkey", F.col("l_returnflag") != "R", spent),
        "events": (i.events, "event_id", F.col("event_type") != "error", None),
    })


@query("a32_json_key_stats", """
SELECT json_extract_string(props, '$.k') AS json_value, count(*) AS row_count, round(CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / count(*), 4) AS avg_score FROM events GROUP BY 1 ORDER BY avg_score DESC, json_value LIMIT 20
""")
def a32(i):
    rows = i.events.select("props", F.col("value").cast("decimal(12,2)").alias("value"))
    return A.json_key_stats(rows, "props", "$.k", "value", 20)


@query("a33_error_rollup", """
SELECT o_custkey, count(*) AS error_count, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS error_types FROM orders WHERE o_orderstatus = 'P' GROUP BY 1 HAVING count(*) > 1
""")
def a33(i):
    return A.error_rollup(i.orders.filter("o_orderstatus = 'P'"), "o_custkey", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


@query("a33_error_kinds", "SELECT o_custkey, o_orderpriority, count(*) AS error_count FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2")
def a33_kinds(i):
    return A.error_kinds(i.orders.filter("o_orderstatus = 'P'"), "o_custkey", "o_orderpriority")


@query("a34_token_cost", """
SELECT l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS input_tokens, CAST(sum(l_linenumber) AS BIGINT) AS output_tokens, round(CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 1000.0::DOUBLE * 0.03::DOUBLE, 4) AS input_cost,
  round(CAST(sum(l_linenumber) AS DOUBLE) / 1000.0::DOUBLE * 0.06::DOUBLE, 4) AS output_cost,
  round(CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 1000.0::DOUBLE * 0.03::DOUBLE + CAST(sum(l_linenumber) AS DOUBLE) / 1000.0::DOUBLE * 0.06::DOUBLE, 4) AS total_cost FROM lineitem GROUP BY 1
""")
def a34(i):
    return A.token_cost(i.lineitem.withColumn("quantity", F.col("l_quantity").cast("bigint")), "l_returnflag", "quantity", "l_linenumber")


def reviews(i):
    lines = i.lineitem.join(i.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    ends = F.when(F.col("l_returnflag") != "N", F.col("l_shipdate") + F.expr("INTERVAL 90 MINUTES"))
    return lines.select("l_linestatus", "o_orderpriority", F.col("o_orderdate").alias("ready_at"), F.col("l_shipdate").alias("assigned_at"), ends.alias("completed_at"))


REVIEWS = """
v AS (SELECT l_linestatus, o_orderpriority, o_orderdate AS ready_at, l_shipdate AS assigned_at, CASE WHEN l_returnflag <> 'N' THEN l_shipdate + INTERVAL 90 MINUTES END AS completed_at FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""


def avg_span(a, b, unit):
    return f"round(CAST(sum(epoch_us({b}) - epoch_us({a})) AS DOUBLE) / count(*) / {unit}, 4)"


@query("a35_review_times", f"""
WITH {REVIEWS} SELECT l_linestatus, o_orderpriority, count(*) AS reviews, {avg_span('ready_at', 'assigned_at', 3600000000)} AS queue_hours, {avg_span('assigned_at', 'completed_at', 3600000000)} AS work_hours,
  {avg_span('ready_at', 'completed_at', 3600000000)} AS total_hours FROM v WHERE completed_at IS NOT NULL AND assigned_at IS NOT NULL GROUP BY 1, 2
""")
def a35(i):
    return A.review_times(reviews(i), ["l_linestatus", "o_orderpriority"], "ready_at", "assigned_at", "completed_at")


@query("a36_feature_adoption", """
WITH codes AS (SELECT DISTINCT o_orderpriority AS code FROM orders UNION ALL SELECT 'never used')
SELECT c.code, count(f.log_id) AS enabled, round(100.0::DOUBLE * count(f.log_id) / (SELECT count(*) FROM entity), 2) AS adoption_pct FROM codes c LEFT JOIN feature_log f ON f.code = c.code AND f.state = 'enabled' GROUP BY c.code
""")
def a36(i):
    codes = i.orders.select(F.col("o_orderpriority").alias("code")).distinct()
    codes = codes.unionByName(i.spark.createDataFrame([("never used",)], "code string"))
    return A.feature_adoption(codes, i.feature_log.withColumnRenamed("code", "f_code"), i.entity, "code", "f_code", F.col("state") == "enabled")


@query("a36_feature_churn", f"""
SELECT code, count(DISTINCT entity_id) AS entities_disabled FROM feature_log WHERE state = 'disabled' AND changed_at > TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL 30 DAYS GROUP BY code
""")
def a36_churn(i):
    return A.feature_churn(i.feature_log, "code", "entity_id", F.col("state") == "disabled", "changed_at", 30, AS_OF_ORDERS)


@query("a37_ab_compare", """
WITH d AS (SELECT o_custkey AS id, o_orderdate, l_shipdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey), f AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND value > 100)
SELECT CASE WHEN f.user_id IS NOT NULL THEN 'Auto' ELSE 'Manual' END AS arm, count(*) AS row_count, round(CAST(sum(epoch_us(l_shipdate) - epoch_us(o_orderdate)) AS DOUBLE) / count(*) / 60000000, 4) AS avg_minutes
FROM d LEFT JOIN f ON f.user_id = d.id GROUP BY 1
""")
def a37(i):
    rows = i.lineitem.join(i.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("id"), "o_orderdate", "l_shipdate")
    flagged = i.events.filter("event_type = 'signup' AND value > 100").select(F.col("user_id").alias("id"))
    return A.ab_compare(rows, "id", flagged, "o_orderdate", "l_shipdate", "Auto", "Manual")


TABLES_SQL = """
inv AS (SELECT 'sales' AS catalog, 'orders' AS table_name, count(*) AS row_count, max(o_orderdate) AS last_run FROM orders UNION ALL SELECT 'sales', 'lineitem', count(*), max(l_shipdate) FROM lineitem
  UNION ALL SELECT 'sales', 'customer', count(*), NULL FROM customer UNION ALL SELECT 'logs', 'events', count(*), max(ts) FROM events UNION ALL SELECT 'logs', 'pages', count(*), NULL FROM pages)
"""


def tables(i):
    return inventory.table_stats({
        ("sales", "orders"): (i.orders, "o_orderdate"), ("sales", "lineitem"): (i.lineitem, "l_shipdate"), ("sales", "customer"): (i.customer, None),
        ("logs", "events"): (i.events, "ts"), ("logs", "pages"): (i.pages, None),
    })


@query("a38_table_inventory", f"""
WITH {TABLES_SQL} SELECT catalog, table_name, row_count, round(100.0::DOUBLE * row_count / (SELECT sum(row_count) FROM inv), 2) AS size_pct FROM inv ORDER BY row_count DESC, table_name LIMIT 3
""")
def a38(i):
    return A.table_inventory(tables(i), "catalog", "row_count", "row_count", "table_name", 3).drop("last_run")


@query("a38_storage_inventory")
def a38_storage(i):
    """Tables ranked by bytes, with files and rows; storage is not known to the comparison SQL, so a test holds it against the files."""
    stored = inventory.storage_stats(i.spark, i.folder).join(tables(i).select("catalog", "table_name", "row_count"), "table_name")
    ranked = A.table_inventory(stored, "catalog", "row_count", "bytes", "table_name")
    return ranked.select("catalog", "table_name", "files", "bytes", "row_count", "size_pct")


@query("a38_inventory_totals", f"WITH {TABLES_SQL} SELECT catalog, count(*) AS tables, CAST(sum(row_count) AS BIGINT) AS total_rows, CAST(sum(row_count) AS BIGINT) AS total_size FROM inv GROUP BY catalog")
def a38_totals(i):
    return A.inventory_totals(tables(i), "catalog", "row_count", "row_count")


@query("a39_activity_status", f"""
WITH {TABLES_SQL} SELECT catalog, table_name, CASE WHEN last_run IS NULL THEN 'Never Run' WHEN last_run > TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 90 DAYS THEN 'Active' ELSE 'Inactive' END AS activity FROM inv
""")
def a39(i):
    return A.activity_status(tables(i), "last_run", AS_OF_EVENTS).select("catalog", "table_name", "activity")


@query("a39_customer_activity", f"""
SELECT activity, count(*) AS row_count FROM (SELECT CASE WHEN updated_at IS NULL THEN 'Never Run' WHEN updated_at > TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL 90 DAYS THEN 'Active' ELSE 'Inactive' END AS activity FROM entity) GROUP BY 1
""")
def a39_customers(i):
    return A.activity_status(i.entity, "updated_at", AS_OF_ORDERS).groupBy("activity").agg(F.count(F.lit(1)).alias("row_count"))


@query("a42_conversion_rate", """
SELECT o_orderstatus, count(*) AS total, count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) AS converted,
  round(100.0::DOUBLE * count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) / count(*), 2) AS conversion_pct FROM orders GROUP BY 1
""")
def a42(i):
    return A.conversion_rate(i.orders, "o_orderkey", i.lineitem.filter("l_returnflag = 'R'"), "l_orderkey", ["o_orderstatus"])


@query("a43_overdue", f"""
WITH p AS (SELECT user_id, max(ts) AS last_run, CAST(round(max(value)) AS INT) AS poll_minutes FROM events GROUP BY user_id)
SELECT user_id, last_run, poll_minutes, round((epoch_us(TIMESTAMP '{AS_OF_EVENTS}') - epoch_us(last_run))::DOUBLE / 60000000, 4) AS minutes_since FROM p
WHERE epoch_us(TIMESTAMP '{AS_OF_EVENTS}') - epoch_us(last_run) > CAST(poll_minutes AS BIGINT) * 2 * 60000000
""")
def a43(i):
    polls = i.events.groupBy("user_id").agg(F.max("ts").alias("last_run"), F.round(F.max("value")).cast("int").alias("poll_minutes"))
    return A.overdue(polls, "last_run", "poll_minutes", AS_OF_EVENTS)


@query("a43_expired", f"""
SELECT event_id, round((epoch_us(TIMESTAMP '{AS_OF_EVENTS}') - epoch_us(ts))::DOUBLE / 3600000000, 4) AS age_hours FROM events WHERE event_type = 'signup' AND value < 50 AND ts < TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 48 HOURS
""")
def a43_expired(i):
    return A.expired(i.events, "ts", (F.col("event_type") == "signup") & (F.col("value") < 50), 48, AS_OF_EVENTS).select("event_id", "age_hours")


def tier_sql(c):
    return f"CASE WHEN {c} <= 20 THEN 'Very Low (0-20)' WHEN {c} <= 40 THEN 'Low (21-40)' WHEN {c} <= 60 THEN 'Medium (41-60)' WHEN {c} <= 80 THEN 'High (61-80)' ELSE 'Very High (81-100)' END"


@query("a44_risk_tiers", f"SELECT {tier_sql('level')} AS tier, count(*) AS row_count, round(CAST(sum(level) AS DOUBLE) / count(*), 4) AS avg_score FROM checks GROUP BY 1")
def a44(i):
    return A.score_tiers(i.checks, "level", A.risk_tier(F.col("level")))


@query("a44_confidence_tiers", """
SELECT provider, CASE WHEN level >= 90 THEN 'High (90-100)' WHEN level >= 70 THEN 'Medium (70-89)' WHEN level >= 50 THEN 'Low (50-69)' ELSE 'Very Low (<50)' END AS tier, count(*) AS row_count,
  round(CAST(sum(level) AS DOUBLE) / count(*), 4) AS avg_score FROM checks GROUP BY 1, 2
""")
def a44_confidence(i):
    return A.score_tiers(i.checks, "level", A.confidence_tier(F.col("level")), ["provider"])


@query("a44_version_compare", """
SELECT provider, status, count(*) AS row_count, round(CAST(sum(level) AS DOUBLE) / count(*), 4) AS avg_score, min(inserted_at) AS first_used, max(inserted_at) AS last_used,
  round(100.0::DOUBLE * count(*) FILTER (WHERE value < 30) / count(*), 2) AS success_pct FROM checks GROUP BY 1, 2
""")
def a44_versions(i):
    return A.version_compare(i.checks, ["provider", "status"], "level", "inserted_at", F.col("value") < 30)


JOBS = """
jobs AS (SELECT event_id AS id, CASE WHEN value < 30 THEN 'default' ELSE 'slow' END AS queue, CASE event_type WHEN 'view' THEN 'available' WHEN 'click' THEN 'executing' WHEN 'signup' THEN 'scheduled' WHEN 'error' THEN 'retryable'
  ELSE 'completed' END AS state, 'worker ' || CAST(CAST(floor(value / 40) AS INT) AS STRING) AS worker, CAST(floor(value / 10) AS INT) AS attempt, CAST(floor(value / 25) AS INT) - 1 AS priority, ts AS inserted_at,
  ts + INTERVAL 45 SECONDS AS ended_at, props FROM events)
"""


def jobs(i):
    state = (
        F.when(F.col("event_type") == "view", "available").when(F.col("event_type") == "click", "executing").when(F.col("event_type") == "signup", "scheduled")
        .when(F.col("event_type") == "error", "retryable").otherwise("completed")
    )
    return i.events.select(
        F.col("event_id").alias("id"), F.when(F.col("value") < 30, "default").otherwise("slow").alias("queue"), state.alias("state"),
        F.concat(F.lit("worker "), F.floor(F.col("value") / 40).cast("int").cast("string")).alias("worker"), F.floor(F.col("value") / 10).cast("int").alias("attempt"),
        (F.floor(F.col("value") / 25).cast("int") - 1).alias("priority"), F.col("ts").alias("inserted_at"), (F.col("ts") + F.expr("INTERVAL 45 SECONDS")).alias("ended_at"),
        F.array(F.lit("first"), F.col("props")).alias("errors"),
    )


@query("a45_queue_stats", f"WITH {JOBS} SELECT queue, state, count(*) AS job_count, min(inserted_at) AS oldest FROM jobs WHERE state IN ('available', 'executing', 'scheduled') GROUP BY 1, 2")
def a45(i):
    return A.queue_stats(jobs(i), "queue", "state", "inserted_at", ["available", "executing", "scheduled"])


@query("a45_worker_stats", f"""
WITH {JOBS} SELECT worker, count(*) AS total_jobs, count(*) FILTER (WHERE state = 'completed') AS completed, count(*) FILTER (WHERE state = 'retryable') AS failed,
  round(CAST(sum(epoch_us(ended_at) - epoch_us(inserted_at)) AS DOUBLE) / count(*) / 1000000, 4) AS avg_seconds FROM jobs GROUP BY worker
""")
def a45_worker(i):
    return A.worker_stats(jobs(i), "worker", "state", "completed", "retryable", "inserted_at", "ended_at")


@query("a45_repeated_failures", f"WITH {JOBS} SELECT id, worker, attempt, props AS last_error FROM jobs WHERE state = 'retryable' AND attempt >= 5")
def a45_failures(i):
    return A.repeated_failures(jobs(i), F.col("state") == "retryable", "attempt", "errors").select("id", "worker", "attempt", "last_error")


@query("a45_waiting_by_priority", f"""
WITH {JOBS} SELECT id, priority, round((epoch_us(TIMESTAMP '{AS_OF_EVENTS}') - epoch_us(inserted_at))::DOUBLE / 3600000000, 4) AS waiting_hours FROM jobs WHERE state = 'available' AND priority < 0
""")
def a45_waiting(i):
    return A.waiting_by_priority(jobs(i), F.col("state") == "available", "priority", "inserted_at", AS_OF_EVENTS).select("id", "priority", "waiting_hours")


@query("a46_consistency_rating", """
WITH c AS (SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS active_days, CAST(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) AS INT) + 1 AS total_days FROM events WHERE value > 20 GROUP BY user_id)
SELECT user_id, active_days, total_days, round(active_days::DOUBLE / total_days::DOUBLE * 100, 2) AS consistency_pct, CASE WHEN active_days = total_days THEN 'Consistent' WHEN active_days::DOUBLE / total_days >= 0.8 THEN 'Mostly Consistent'
  WHEN active_days::DOUBLE / total_days >= 0.5 THEN 'Some Gaps' ELSE 'Inconsistent' END AS stability FROM c
""")
def a46(i):
    days = i.events.filter("value > 20").groupBy("user_id").agg(
        F.count_distinct(F.col("ts").cast("date")).alias("active_days"), (F.datediff(F.max("ts").cast("date"), F.min("ts").cast("date")) + 1).alias("total_days")
    )
    return A.consistency_rating(days, "active_days", "total_days")


@query("a46_sufficiency_rating", """
SELECT id, CASE WHEN balance >= 10000 THEN 'Excellent (6+ months)' WHEN balance >= 5000 THEN 'Good (3-6 months)' WHEN balance >= 3000 THEN 'Borderline (2-3 months)' ELSE 'Insufficient (<2 months)' END AS rating FROM entity
""")
def a46_rating(i):
    return i.entity.select("id", A.sufficiency_rating(F.col("balance")).alias("rating"))


@query("a46_amount_by_source", """
SELECT entity_id, code, count(*) AS documents, CAST(sum(amount) AS DOUBLE) AS total_amount, round(CAST(sum(amount) AS DOUBLE) / count(*), 4) AS avg_amount FROM feature_log GROUP BY 1, 2
""")
def a46_amount(i):
    return A.amount_by_source(i.feature_log, ["entity_id", "code"], "amount")


@query("a47_exposure_metrics", """
WITH v AS (SELECT l_partkey, o_custkey, l_shipdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'),
i2 AS (SELECT p_partkey, p_brand, TIMESTAMP '1995-01-01 00:00:00' AS published FROM part)
SELECT i2.p_partkey, i2.p_brand, count(v.l_partkey) AS views, count(DISTINCT v.o_custkey) AS unique_users, round(CAST(sum(epoch_us(v.l_shipdate) - epoch_us(i2.published)) AS DOUBLE) / NULLIF(count(v.l_partkey), 0) / 3600000000, 4) AS avg_hours_to_view
FROM i2 LEFT JOIN v ON v.l_partkey = i2.p_partkey GROUP BY 1, 2
""")
def a47(i):
    views = i.lineitem.filter("l_returnflag = 'R'").join(i.orders, F.col("o_orderkey") == F.col("l_orderkey")).select("l_partkey", "o_custkey", "l_shipdate")
    items = i.part.select("p_partkey", "p_brand", F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("published"))
    return A.exposure_metrics(items, views, "p_partkey", "l_partkey", "o_custkey", "published", "l_shipdate").drop("published")


@query("a47_coverage_per_role", """
SELECT n.n_name, count(DISTINCT CASE WHEN s.s_acctbal > 8000 THEN s.s_suppkey END) AS active_items FROM nation n LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name
""")
def a47_roles(i):
    out = A.coverage_per_role(i.nation.select("n_nationkey", "n_name"), "n_nationkey", i.supplier, "s_nationkey", "s_suppkey", F.col("s_acctbal") > 8000)
    return out.drop("n_nationkey")


@query("a48_integration_status", f"""
WITH integ AS (SELECT source_id AS id, CASE WHEN is_deleted THEN last_modified END AS ended_at, last_modified AS last_run FROM target),
vol AS (SELECT o_custkey, count(*) AS total_entries, count(*) FILTER (WHERE o_orderstatus = 'F') AS clean, count(*) FILTER (WHERE o_orderstatus = 'P') AS fraud FROM orders WHERE o_orderdate > TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL 90 DAYS GROUP BY 1)
SELECT e.id, CASE WHEN i.id IS NULL THEN 'None' WHEN i.ended_at IS NULL THEN 'Active' ELSE 'Inactive' END AS integration_status, round((epoch_us(TIMESTAMP '{AS_OF_ORDERS}') - epoch_us(i.last_run))::DOUBLE / 3600000000, 4) AS hours_since_run,
  COALESCE(v.total_entries, 0) AS total_entries, COALESCE(v.clean, 0) AS clean, COALESCE(v.fraud, 0) AS fraud FROM entity e LEFT JOIN integ i ON i.id = e.id LEFT JOIN vol v ON v.o_custkey = e.id
""")
def a48(i):
    links = i.target.select(F.col("source_id").alias("id"), F.when(F.col("is_deleted"), F.col("last_modified")).alias("ended_at"), F.col("last_modified").alias("last_run"))
    out = A.integration_status(i.entity.select("id"), "id", links, i.orders, "o_custkey", "o_orderdate", "o_orderstatus", {"clean": "F", "fraud": "P"}, 90, AS_OF_ORDERS)
    return out.drop("last_run")
