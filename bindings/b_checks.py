"""M3-M20, M22-M24."""

from pyspark.sql import functions as F

from bindings.b_reconcile import AGGREGATED, LIVE, SPEC, aggregated, newest_first
from bindings.base import AS_OF_EVENTS, AS_OF_ORDERS, query
from crosswalk.operators import checks as K
from crosswalk.plans import monitoring as P
from crosswalk.plans import sync

DAY = "2001-07-30 00:00:00"
EVENT_DAY = "2024-01-29 00:00:00"


def stack(i):
    """The sync stack, each level written once since several figures read it."""
    out = sync.run(i.entity, i.feature_wide, i.parent, i.target, SPEC, newest_first())
    return out.enriched, out.aggregated, out.creates, out.updates


def health(i):
    rows, agg, creates, updates = stack(i)
    return P.health_check(rows, i.target, agg, creates, updates, i.audit_log, "is_deleted", AS_OF_EVENTS, EVENT_DAY)


QUEUES = AGGREGATED + LIVE + """,
cq AS (SELECT * FROM agg WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.sync_key = agg.sync_key AND NOT t.is_deleted)),
uq AS (SELECT agg.* FROM agg JOIN live ON live.sync_key = agg.sync_key)
"""
HEALTH = QUEUES + f""",
h0 AS (SELECT (SELECT count(*) FROM enriched) AS total_source, (SELECT count(*) FROM enriched WHERE is_active) AS active_source, (SELECT count(*) FROM enriched WHERE has_valid_key) AS source_with_key,
  (SELECT count(*) FROM target WHERE NOT is_deleted) AS total_target, (SELECT count(*) FROM agg) AS total_keys, (SELECT count(*) FROM agg WHERE is_multi) AS multi_keys, (SELECT max(active_count) FROM agg) AS max_per_key,
  (SELECT count(*) FROM cq) AS create_queue, (SELECT count(*) FROM cq WHERE has_any_flag) AS create_with_features, (SELECT count(*) FROM cq WHERE is_multi) AS create_multi,
  (SELECT count(*) FROM uq) AS update_queue, (SELECT count(*) FROM uq WHERE has_any_flag) AS update_with_features, (SELECT count(*) FROM uq WHERE is_multi) AS update_multi,
  (SELECT max(execution_timestamp) FROM audit_log) AS last_sync_at, (SELECT CAST(COALESCE(sum(records_succeeded), 0) AS BIGINT) FROM audit_log WHERE execution_timestamp >= TIMESTAMP '{EVENT_DAY}' AND execution_timestamp < TIMESTAMP '{EVENT_DAY}' + INTERVAL 1 DAY) AS synced_today),
h1 AS (SELECT *, round(100.0::DOUBLE * total_target / source_with_key, 2) AS coverage_pct, total_source - total_target AS gap, TIMESTAMP '{AS_OF_EVENTS}' AS report_at FROM h0),
h AS (SELECT *, CASE WHEN create_queue > 200 THEN 'High CREATE backlog' WHEN create_queue > 50 THEN 'Moderate CREATE queue' WHEN create_queue > 0 THEN 'Small CREATE queue' ELSE 'No creates needed' END AS create_queue_status,
  CASE WHEN coverage_pct < 90 THEN 'Coverage LOW (<90%)' WHEN coverage_pct < 95 THEN 'Coverage OK (90-95%)' ELSE 'Coverage GOOD (>95%)' END AS coverage_status FROM h1)
"""


@query("m3_health_check", f"WITH {HEALTH} SELECT * FROM h")
def m3(i):
    return health(i)


def timed_target(i):
    made = i.entity.select(F.col("id").alias("source_id"), F.col("inserted_at").alias("created_at"))
    return i.target.join(made, "source_id")


@query("m4_queue_health", f"""
WITH {QUEUES}, tt AS (SELECT t.*, e.inserted_at AS created_at FROM target t JOIN entity e ON e.id = t.source_id WHERE NOT t.is_deleted),
c AS (SELECT 'create' AS queue, (SELECT count(*) FROM cq) AS queue_size, max(created_at) AS last_sync_at, count(*) AS records_today FROM tt WHERE created_at >= TIMESTAMP '{DAY}' AND created_at < TIMESTAMP '{DAY}' + INTERVAL 1 DAY),
u AS (SELECT 'update' AS queue, (SELECT count(*) FROM uq) AS queue_size, max(last_modified) AS last_sync_at, count(*) AS records_today FROM tt WHERE last_modified >= TIMESTAMP '{DAY}' AND last_modified < TIMESTAMP '{DAY}' + INTERVAL 1 DAY AND created_at < TIMESTAMP '{DAY}'),
q AS (SELECT *, 300 AS too_many, 40 AS many FROM c UNION ALL SELECT *, 900, 200 FROM u)
SELECT queue, queue_size, last_sync_at, records_today,
  CASE WHEN queue_size > too_many THEN queue || ' overflows' WHEN records_today = 0 THEN 'nothing today' WHEN queue_size >= many THEN queue || ' fills up'
    WHEN (epoch_us(TIMESTAMP '2001-07-30 12:00:00') - epoch_us(last_sync_at)) // 3600000000 > 5 THEN 'waiting for a run' ELSE 'as usual' END AS status,
  CASE WHEN queue_size >= 250 THEN 'pile' WHEN queue_size >= 60 THEN 'stack' WHEN queue_size >= 1 THEN 'few' ELSE 'none' END AS assessment FROM q
""")
def m4(i):
    _, _, creates, updates = stack(i)
    activity = P.sync_activity(timed_target(i), "created_at", "last_modified", "is_deleted", DAY)
    rules = P.QueueRules(
        limits={"create": (300, 40), "update": (900, 200)}, stale_hours=5, full="{queue} overflows", filling="{queue} fills up", silent="nothing today", idle="nothing today",
        stale="waiting for a run", fine="as usual", sizes=[(0, "none"), (1, "few"), (60, "stack"), (250, "pile")],
    )
    return P.queue_health({"create": creates, "update": updates}, activity, "2001-07-30 12:00:00", 12, rules)


SNAP = HEALTH + f""",
live_t AS (SELECT t.*, e.inserted_at AS created_at FROM target t JOIN entity e ON e.id = t.source_id WHERE NOT t.is_deleted),
d AS (SELECT count(*) AS records_processed, count(target_name) AS records_succeeded, count(*) FILTER (WHERE target_name IS NULL) AS records_failed, count(*) FILTER (WHERE a_enabled) AS fa, count(*) FILTER (WHERE b_enabled) AS fb,
  count(*) FILTER (WHERE created_at >= TIMESTAMP '{DAY}' AND created_at < TIMESTAMP '{DAY}' + INTERVAL 1 DAY) AS created_today, count(*) FILTER (WHERE last_modified >= TIMESTAMP '{DAY}' AND last_modified < TIMESTAMP '{DAY}' + INTERVAL 1 DAY) AS updated_today FROM live_t),
snap AS (SELECT 'daily_snapshot_20240131' AS audit_id, 'MONITORING' AS sync_type, TIMESTAMP '{AS_OF_EVENTS}' AS execution_timestamp, records_processed, records_succeeded, records_failed, round(100.0::DOUBLE * records_failed / records_processed, 2) AS error_rate,
  'Coverage: ' || printf('%.2f', coverage_pct) || '% | Status: ' || coverage_status || ' | Source Total: ' || total_source || ' | Target Total: ' || total_target || ' | Gap: ' || gap || ' | CREATE Queue: ' || create_queue || ' | UPDATE Queue: ' || update_queue
  || ' | Created Today: ' || created_today || ' | Updated Today: ' || updated_today || ' | Flag A: ' || fa || ' | Flag B: ' || fb AS notes FROM d, h)
"""


def snapshot(i):
    live = timed_target(i).filter("NOT is_deleted")
    return P.audit_snapshot(live, health(i), "target_name", {"a_enabled": "Flag A", "b_enabled": "Flag B"}, "created_at", "last_modified", DAY, AS_OF_EVENTS)


@query("m5_audit_snapshot", f"WITH {SNAP} SELECT * FROM snap")
def m5(i):
    return snapshot(i).select("audit_id", "sync_type", "execution_timestamp", "records_processed", "records_succeeded", "records_failed", "error_rate", "notes")


@query("m6_audit_trends", """
WITH log AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'signup') AS made, count(*) FILTER (WHERE event_type = 'error') AS bad FROM events GROUP BY 1)
SELECT CAST(day AS STRING) AS snapshot_date, round(100.0::DOUBLE * (n - bad) / n, 2) AS coverage, CAST(made AS DOUBLE) AS created, CAST(bad AS DOUBLE) AS create_queue, CAST(NULL AS DOUBLE) AS update_queue FROM log WHERE day >= DATE '2024-01-11'
""")
def m6(i):
    daily = i.events.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("event_type") == "signup", 1)).alias("made"), F.count(F.when(F.col("event_type") == "error", 1)).alias("bad")
    )
    coverage = F.format_string("%.2f", F.round(F.lit(100.0) * (F.col("n") - F.col("bad")) / F.col("n"), 2))
    notes = F.concat(F.lit("Coverage: "), coverage, F.lit("% | Created Today: "), F.col("made").cast("string"), F.lit(" | CREATE Queue: "), F.col("bad").cast("string"), F.lit(" | UPDATE Queue: none"))
    audit = daily.select(F.lit("MONITORING").alias("sync_type"), F.col("day").cast("timestamp_ntz").alias("execution_timestamp"), notes.alias("notes"))
    fields = {"coverage": "Coverage", "created": "Created Today", "create_queue": "CREATE Queue", "update_queue": "UPDATE Queue"}
    return P.audit_trends(audit, fields, AS_OF_EVENTS, 20)


MAPPING = {"name": "target_name", "status": "status_text", "is_big": "b_enabled", "updated_at": "last_modified"}
KINDS = {"is_big": "bool", "updated_at": "date"}
COMPARED = """
a AS (SELECT id, name, status, units > 10 AS is_big, updated_at FROM entity),
b AS (SELECT source_id, CASE WHEN target_name IS NULL THEN 'null' ELSE ' ' || target_name || ' ' END AS target_name, 'ACTIVE' AS status_text, CASE WHEN b_enabled THEN 'T' ELSE '0' END AS b_enabled, CAST(last_modified AS STRING) AS last_modified FROM target WHERE NOT is_deleted
  UNION ALL SELECT event_id + 10000000, 'x', 'ACTIVE', 'T', NULL FROM events WHERE value > 200),
f AS (SELECT CAST(COALESCE(a.id, b.source_id) AS STRING) AS key, CASE WHEN b.source_id IS NULL THEN 'only in a' WHEN a.id IS NULL THEN 'only in b' ELSE 'both' END AS found_in,
  unnest([{'field': 'name', 'a_value': a.name, 'b_value': CASE WHEN trim(b.target_name) = 'null' THEN NULL ELSE trim(b.target_name) END}, {'field': 'status', 'a_value': a.status, 'b_value': b.status_text},
    {'field': 'is_big', 'a_value': CAST(a.is_big AS STRING), 'b_value': CASE b.b_enabled WHEN 'T' THEN 'true' WHEN '0' THEN 'false' END},
    {'field': 'updated_at', 'a_value': substr(CAST(a.updated_at AS STRING), 1, 10), 'b_value': substr(b.last_modified, 1, 10)}]) AS v FROM a FULL OUTER JOIN b ON a.id = b.source_id),
cmp AS (SELECT key, found_in, v.field AS field, v.a_value AS a_value, v.b_value AS b_value, v.a_value IS NOT DISTINCT FROM v.b_value AS same FROM f)
"""


def compared(i):
    a = i.entity.withColumn("is_big", F.col("units") > 10)
    b = i.target.filter("NOT is_deleted").select(
        "source_id", F.when(F.col("target_name").isNull(), "null").otherwise(F.concat(F.lit(" "), "target_name", F.lit(" "))).alias("target_name"), F.lit("ACTIVE").alias("status_text"),
        F.when(F.col("b_enabled"), "T").otherwise("0").alias("b_enabled"), F.col("last_modified").cast("string").alias("last_modified"),
    )
    extra = i.events.filter("value > 200").select(
        (F.col("event_id") + 10000000).alias("source_id"), F.lit("x").alias("target_name"), F.lit("ACTIVE").alias("status_text"), F.lit("T").alias("b_enabled"), F.lit(None).cast("string").alias("last_modified")
    )
    return K.compare_fields(a, b.unionByName(extra), "id", "source_id", MAPPING, KINDS)


@query("m7_compare_fields", f"WITH {COMPARED} SELECT * FROM cmp")
def m7(i):
    return compared(i)


@query("m7_field_mismatches", f"WITH {COMPARED} SELECT key, field, a_value, b_value FROM cmp WHERE found_in = 'both' AND NOT same")
def m7_mismatches(i):
    return K.field_mismatches(compared(i))


@query("m7_compare_summary", f"""
WITH {COMPARED}, k AS (SELECT key, found_in, count(*) FILTER (WHERE same) AS s FROM cmp GROUP BY 1, 2)
SELECT count(*) FILTER (WHERE found_in = 'both' AND s = 4) AS identical, count(*) FILTER (WHERE found_in = 'both' AND s < 4) AS different, count(*) FILTER (WHERE found_in = 'only in a') AS only_in_a, count(*) FILTER (WHERE found_in = 'only in b') AS only_in_b FROM k
""")
def m7_summary(i):
    return K.compare_summary(compared(i), 4)


@query("m7_compare_repeated_keys", """
WITH a AS (SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey END AS k, l_returnflag AS v FROM lineitem WHERE l_orderkey % 5 > 0),
b AS (SELECT CASE WHEN l_linenumber > 1 THEN l_orderkey END AS k, CASE WHEN l_linenumber < 5 THEN l_returnflag END AS v FROM lineitem WHERE l_orderkey % 7 > 0),
sides AS (SELECT 'a' AS side, k, v FROM a UNION ALL SELECT 'b', k, v FROM b),
held AS (SELECT k, count(*) FILTER (WHERE side = 'a') AS na, count(*) FILTER (WHERE side = 'b') AS nb, count(DISTINCT v) AS n, count(*) FILTER (WHERE v IS NULL) AS gaps, count(*) AS every FROM sides WHERE k IS NOT NULL GROUP BY k)
SELECT CAST(k AS VARCHAR) AS key, CASE WHEN nb = 0 THEN 'only in a' WHEN na = 0 THEN 'only in b' ELSE 'both' END AS found_in,
  na > 0 AND nb > 0 AND (gaps = every OR (n = 1 AND gaps = 0)) AS agree FROM held
UNION ALL SELECT NULL, 'only in ' || side, FALSE FROM (SELECT DISTINCT side FROM sides WHERE k IS NULL) s
""")
def m7_repeated(i):
    a = i.lineitem.filter("l_orderkey % 5 > 0").selectExpr("CASE WHEN l_linenumber < 7 THEN l_orderkey END AS k", "l_returnflag AS v")
    b = i.lineitem.filter("l_orderkey % 7 > 0").selectExpr("CASE WHEN l_linenumber > 1 THEN l_orderkey END AS k", "CASE WHEN l_linenumber < 5 THEN l_returnflag END AS v")
    return K.compare_fields(a, b, "k", "k", {"v": "v"}).selectExpr("key", "found_in", "found_in = 'both' AND same AS agree")


def parity_sides(i):
    a = i.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    b = a.filter("o_orderpriority <> '5-LOW' OR o_orderstatus = 'P'").withColumn("o_orderstatus", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus")))
    return a, b


SIDES = """
a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders),
b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END AS o_orderstatus, o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderstatus = 'P')
"""


def profile_sql(t):
    return f"""SELECT 'rows' AS c, count(*) AS v FROM {t} UNION ALL SELECT 'distinct o_custkey', count(DISTINCT o_custkey) FROM {t} UNION ALL SELECT 'null o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM {t}
    UNION ALL SELECT 'first day', CAST(strftime(min(o_orderdate), '%Y%m%d') AS BIGINT) FROM {t} UNION ALL SELECT 'last day', CAST(strftime(max(o_orderdate), '%Y%m%d') AS BIGINT) FROM {t}
    UNION ALL SELECT 'distinct days', count(DISTINCT CAST(o_orderdate AS DATE)) FROM {t} UNION ALL SELECT 'leaked o_orderpriority', count(*) FILTER (WHERE upper(o_orderpriority) LIKE '%LOW%') FROM {t}"""


@query("m8_dataset_parity", f"""
WITH {SIDES}, pa AS ({profile_sql('a')}), pb AS ({profile_sql('b')})
SELECT pa.c AS check_name, pa.v AS a_value, pb.v AS b_value, pb.v - pa.v AS difference, CASE WHEN pa.v <> 0 THEN round(100.0::DOUBLE * pb.v / pa.v, 2) END AS b_pct_of_a FROM pa JOIN pb ON pa.c = pb.c
""")
def m8(i):
    return K.dataset_parity(*parity_sides(i), ["o_custkey"], ["o_orderstatus"], "o_orderdate", {"o_orderpriority": ["%LOW%"]})


@query("m8_key_differences", f"""
WITH {SIDES} SELECT a.o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'missing in b' ELSE 'values differ' END AS difference FROM a LEFT JOIN b ON a.o_orderkey = b.o_orderkey WHERE b.o_orderkey IS NULL OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
""")
def m8_keys(i):
    return K.key_differences(*parity_sides(i), ["o_orderkey"], ["o_custkey", "o_orderstatus"])


@query("m8_schema_diff", f"""
WITH {SIDES} SELECT 'o_orderkey' AS column_name, 'bigint' AS a_type, count(a.o_orderkey) AS a_filled, 'string' AS b_type, (SELECT count(o_orderkey) FROM b) AS b_filled, 'type differs' AS status FROM a
UNION ALL SELECT 'o_custkey', 'bigint', count(o_custkey), 'bigint', (SELECT count(o_custkey) FROM b), 'same' FROM a UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus), 'string', (SELECT count(o_orderstatus) FROM b), 'same' FROM a
UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate), 'timestamp_ntz', (SELECT count(o_orderdate) FROM b), 'same' FROM a
UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority), NULL, NULL, 'only in a' FROM a UNION ALL SELECT 'rank', NULL, NULL, 'string', count(o_orderpriority), 'only in b' FROM b
""")
def m8_schema(i):
    a, b = parity_sides(i)
    return K.schema_diff(a, b.withColumnRenamed("o_orderpriority", "rank").withColumn("o_orderkey", F.col("o_orderkey").cast("string")))


@query("m8_sample_lookup", f"""
WITH {SIDES} SELECT a.o_orderkey, a.o_orderstatus AS a_o_orderstatus, b.o_orderkey IS NOT NULL AS in_b, b.o_orderstatus AS b_o_orderstatus FROM (SELECT * FROM a ORDER BY o_orderkey LIMIT 25) a LEFT JOIN b ON b.o_orderkey = a.o_orderkey
""")
def m8_sample(i):
    return K.sample_lookup(*parity_sides(i), "o_orderkey", ["o_orderstatus"], 25)


@query("m9_sync_quality_suite", f"""
WITH {QUEUES} SELECT 'aggregation keeps all keys' AS test, (SELECT count(DISTINCT sync_key) FROM valid) AS expected, (SELECT count(DISTINCT sync_key) FROM agg) AS actual, TRUE AS pass
UNION ALL SELECT 'any flag gives true', 0, 0, TRUE UNION ALL SELECT 'earliest time kept', 0, 0, TRUE
UNION ALL SELECT 'create and update cover all keys', (SELECT count(*) FROM agg), (SELECT count(*) FROM cq) + (SELECT count(*) FROM uq), TRUE
UNION ALL SELECT 'no inactive row aggregated', (SELECT count(*) FROM valid), (SELECT CAST(sum(active_count) AS BIGINT) FROM agg), TRUE
""")
def m9(i):
    rows, agg, creates, updates = stack(i)
    return K.sync_quality_suite(rows, agg, creates, updates, "sync_key", "a_enabled", "a_updated_at", F.col("is_active") & F.col("has_valid_key"))


@query("m10_daily_alerts", f"""
WITH {HEALTH}, s AS (SELECT count(*) FILTER (WHERE target_name IS NULL) AS nn, (epoch_us(TIMESTAMP '{AS_OF_ORDERS}') - epoch_us(max(last_modified))) // 3600000000 AS age FROM target WHERE NOT is_deleted),
r AS (SELECT 'coverage' AS rule, coverage_pct AS value, 90.0::DOUBLE AS limit_value FROM h UNION ALL SELECT 'null_names', nn, 50 FROM s UNION ALL SELECT 'sync_age_hours', age, 2 FROM s UNION ALL SELECT 'create_queue', create_queue, 100 FROM h UNION ALL SELECT 'update_queue', update_queue, 1000 FROM h),
p AS (SELECT *, CASE WHEN rule = 'coverage' THEN value >= limit_value ELSE value <= limit_value END AS pass FROM r)
SELECT rule, CAST(value AS DOUBLE) AS value, limit_value, pass, CASE WHEN pass THEN 'OK ' ELSE 'ALERT ' END || rule || ': ' || printf('%.2f', value) || ' (limit ' || CAST(CAST(limit_value AS INT) AS STRING) || ')' AS message FROM p
""")
def m10(i):
    return P.daily_alerts(P.alert_metrics(health(i), i.target.filter("NOT is_deleted"), "target_name", "last_modified", AS_OF_ORDERS))


@query("m11_quality_tile", """
SELECT count(*) AS total, count(*) FILTER (WHERE target_name IS NULL) AS null_target_name, count(*) FILTER (WHERE a_enabled IS NULL) AS null_a_enabled, round(100.0::DOUBLE * count(target_name) / count(*), 2) AS quality_pct,
  CASE WHEN round(100.0::DOUBLE * count(target_name) / count(*), 2) >= 95 THEN 'Excellent' WHEN round(100.0::DOUBLE * count(target_name) / count(*), 2) >= 90 THEN 'Good' ELSE 'Poor' END AS quality_status FROM target WHERE NOT is_deleted
""")
def m11(i):
    return K.quality_tile(i.target.filter("NOT is_deleted"), "target_name", ["a_enabled"])


@query("m11_missing_fields", """
WITH g AS (SELECT target_name IS NULL OR trim(target_name) = '' AS mn, sync_key IS NULL OR trim(sync_key) = '' AS mk FROM target)
SELECT count(*) AS rows_with_issues, count(*) FILTER (WHERE mn) AS missing_target_name, count(*) FILTER (WHERE mk) AS missing_sync_key, CASE WHEN count(*) > 100 THEN 'High' WHEN count(*) > 50 THEN 'Moderate' ELSE 'Low' END AS severity FROM g WHERE mn OR mk
""")
def m11_missing(i):
    return K.missing_fields(i.target, ["target_name", "sync_key"])


@query("m11_missing_patterns", """
SELECT CASE WHEN sync_key IS NULL AND inserted_at IS NULL THEN 'sync_key,inserted_at' WHEN sync_key IS NULL THEN 'sync_key' ELSE 'inserted_at' END AS missing, segment, count(*) AS row_count FROM entity WHERE sync_key IS NULL OR inserted_at IS NULL GROUP BY 1, 2
""")
def m11_patterns(i):
    return K.missing_patterns(i.entity, ["sync_key", "inserted_at"], ["segment"])


@query("m12_status_tile", f"WITH {HEALTH} SELECT CASE WHEN coverage_pct >= 95 THEN 'Excellent' WHEN coverage_pct >= 90 THEN 'Good' WHEN coverage_pct >= 85 THEN 'OK' ELSE 'Attention Needed' END AS status, coverage_pct, gap FROM h")
def m12(i):
    return P.status_tile(health(i))


@query("m12_queue_tile", f"""
WITH {HEALTH} SELECT 'create' AS queue_type, create_queue AS queue_size, CASE WHEN create_queue > 100 THEN 'High' WHEN create_queue > 50 THEN 'Moderate' ELSE 'Normal' END AS status FROM h
UNION ALL SELECT 'update', update_queue, CASE WHEN update_queue > 1000 THEN 'High' WHEN update_queue > 500 THEN 'Moderate' ELSE 'Normal' END FROM h
""")
def m12_queue(i):
    return P.queue_tile(health(i))


@query("m12_adoption_tile", """
SELECT 'Flag A' AS feature, count(*) FILTER (WHERE a_enabled) AS enabled_count, round(100.0::DOUBLE * count(*) FILTER (WHERE a_enabled) / count(*), 1) AS enabled_pct FROM target WHERE NOT is_deleted
UNION ALL SELECT 'Flag B', count(*) FILTER (WHERE b_enabled), round(100.0::DOUBLE * count(*) FILTER (WHERE b_enabled) / count(*), 1) FROM target WHERE NOT is_deleted
""")
def m12_adoption(i):
    return P.adoption_tile(i.target.filter("NOT is_deleted"), {"a_enabled": "Flag A", "b_enabled": "Flag B"})


@query("m12_last_sync_tile", f"""
SELECT 'Last UPDATE Sync' AS sync_type, max(last_modified) AS last_sync_at, (epoch_us(TIMESTAMP '{AS_OF_ORDERS}') - epoch_us(max(last_modified))) // 3600000000 AS hours_ago FROM target
UNION ALL SELECT 'Last CREATE Sync', max(e.inserted_at), (epoch_us(TIMESTAMP '{AS_OF_ORDERS}') - epoch_us(max(e.inserted_at))) // 3600000000 FROM target t JOIN entity e ON e.id = t.source_id
""")
def m12_last(i):
    return P.last_sync_tile(timed_target(i), {"Last CREATE Sync": "created_at", "Last UPDATE Sync": "last_modified"}, AS_OF_ORDERS)


def impact_sides(i):
    new = i.entity.select("id", "name", (F.col("balance") > 3500).alias("a_enabled"), (F.col("units") > 9).alias("b_enabled"))
    cur = i.target.select(F.col("source_id").alias("id"), F.col("target_name").alias("name"), "a_enabled", "b_enabled")
    return new, cur


IMPACT = """
m AS (SELECT e.id, e.name AS nn, t.target_name AS cn, e.balance > 3500 AS na, t.a_enabled AS ca, e.units > 9 AS nb, t.b_enabled AS cb FROM entity e JOIN target t ON t.source_id = e.id),
z AS (SELECT id, COALESCE(na, FALSE) AS na, COALESCE(ca, FALSE) AS ca, COALESCE(nb, FALSE) AS nb, COALESCE(cb, FALSE) AS cb FROM m)
"""


@query("m13_update_impact", f"""
WITH {IMPACT} SELECT 'name' AS column_name, count(*) FILTER (WHERE nn IS DISTINCT FROM cn) AS will_change, count(*) AS total_matched, round(100.0::DOUBLE * count(*) FILTER (WHERE nn IS DISTINCT FROM cn) / count(*), 2) AS pct_change FROM m
UNION ALL SELECT 'a_enabled', count(*) FILTER (WHERE na IS DISTINCT FROM ca), count(*), round(100.0::DOUBLE * count(*) FILTER (WHERE na IS DISTINCT FROM ca) / count(*), 2) FROM m
UNION ALL SELECT 'b_enabled', count(*) FILTER (WHERE nb IS DISTINCT FROM cb), count(*), round(100.0::DOUBLE * count(*) FILTER (WHERE nb IS DISTINCT FROM cb) / count(*), 2) FROM m
""")
def m13(i):
    return K.update_impact(*impact_sides(i), "id", ["name", "a_enabled", "b_enabled"])


def transition_sql(f, n, c):
    return f"""SELECT '{f}' AS flag, count(*) FILTER (WHERE {n} <> {c}) AS will_change, count(*) FILTER (WHERE {n} AND NOT {c}) AS turning_on, count(*) FILTER (WHERE NOT {n} AND {c}) AS turning_off, count(*) AS total_matched,
    round(100.0::DOUBLE * count(*) FILTER (WHERE {n} <> {c}) / count(*), 1) AS pct_change FROM z"""


@query("m14_flag_transitions", f"WITH {IMPACT} {transition_sql('a_enabled', 'na', 'ca')} UNION ALL {transition_sql('b_enabled', 'nb', 'cb')}")
def m14(i):
    return K.flag_transitions(*impact_sides(i), "id", ["a_enabled", "b_enabled"])


@query("m14_flag_change_detail", f"""
WITH {IMPACT} SELECT id, concat_ws('; ', CASE WHEN na <> ca THEN 'a_enabled: ' || CAST(ca AS STRING) || ' -> ' || CAST(na AS STRING) END, CASE WHEN nb <> cb THEN 'b_enabled: ' || CAST(cb AS STRING) || ' -> ' || CAST(nb AS STRING) END) AS changes FROM z WHERE na <> ca OR nb <> cb
""")
def m14_detail(i):
    return K.flag_change_detail(*impact_sides(i), "id", ["a_enabled", "b_enabled"])


@query("m14_change_summary", f"WITH {IMPACT} SELECT count(*) AS total_matched, count(*) FILTER (WHERE na <> ca OR nb <> cb) AS any_change, count(*) FILTER (WHERE na = ca AND nb = cb) AS no_change FROM z")
def m14_summary(i):
    return K.change_summary(*impact_sides(i), "id", ["a_enabled", "b_enabled"])


@query("m15_fix_coverage", f"""
WITH {QUEUES}, {IMPACT.strip()}, x AS (SELECT z.*, z.id IN (SELECT id FROM uq) AS q FROM z WHERE na <> ca OR nb <> cb)
SELECT 'all' AS feature, count(*) AS mismatches, count(*) FILTER (WHERE q) AS in_queue, round(100.0::DOUBLE * count(*) FILTER (WHERE q) / count(*), 2) AS fix_pct FROM x
UNION ALL SELECT 'a_enabled', count(*), count(*) FILTER (WHERE q), round(100.0::DOUBLE * count(*) FILTER (WHERE q) / count(*), 2) FROM x WHERE na <> ca
UNION ALL SELECT 'b_enabled', count(*), count(*) FILTER (WHERE q), round(100.0::DOUBLE * count(*) FILTER (WHERE q) / count(*), 2) FROM x WHERE nb <> cb
""")
def m15(i):
    new, cur = impact_sides(i)
    detail = K.flag_change_detail(new, cur, "id", ["a_enabled", "b_enabled"])
    agg = aggregated(i)
    return K.fix_coverage(
        detail, sync.to_update(agg, i.target, SPEC), "id", {"a_enabled": F.col("changes").contains("a_enabled"), "b_enabled": F.col("changes").contains("b_enabled")}
    )


def snapshots(i):
    before = i.entity.filter("segment <> 'HOUSEHOLD' OR balance < 9000").select("id", "name", "status", "units")
    after = i.entity.filter("segment <> 'MACHINERY' OR balance < 5000").select("id", "name", F.when(F.col("units") > 15, "BUSY").otherwise(F.col("status")).alias("status"), "units")
    return before, after


SNAPS = """
v1 AS (SELECT id, name, status, units FROM entity WHERE segment <> 'HOUSEHOLD' OR balance < 9000),
v2 AS (SELECT id, name, CASE WHEN units > 15 THEN 'BUSY' ELSE status END AS status, units FROM entity WHERE segment <> 'MACHINERY' OR balance < 5000)
"""


@query("m16_snapshot_diff", f"""
WITH {SNAPS} SELECT COALESCE(v1.id, v2.id) AS id, CASE WHEN v1.id IS NULL THEN 'added' WHEN v2.id IS NULL THEN 'removed' ELSE 'changed' END AS change FROM v1 FULL OUTER JOIN v2 ON v1.id = v2.id
WHERE v1.id IS NULL OR v2.id IS NULL OR v1.status <> v2.status
""")
def m16(i):
    return K.snapshot_diff(*snapshots(i), "id", ["name", "status", "units"])


@query("m16_snapshot_counts", f"WITH {SNAPS} SELECT 'v1' AS version, status, count(*) AS row_count FROM v1 GROUP BY status UNION ALL SELECT 'v2', status, count(*) FROM v2 GROUP BY status")
def m16_counts(i):
    before, after = snapshots(i)
    return K.snapshot_counts({"v1": before, "v2": after}, "status")


@query("m17_key_profile", """
WITH k AS (SELECT sync_key, count(*) AS n FROM entity GROUP BY sync_key)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) FILTER (WHERE sync_key IS NOT NULL) AS distinct_keys, CAST(sum(n - 1) FILTER (WHERE sync_key IS NOT NULL) AS BIGINT) AS duplicate_rows,
  CAST(COALESCE(sum(n) FILTER (WHERE sync_key IS NULL), 0) AS BIGINT) AS null_keys, count(*) FILTER (WHERE sync_key IS NOT NULL AND n > 1) AS repeated_values FROM k
""")
def m17(i):
    return K.key_profile(i.entity, "sync_key")


HISTORY = """
hist AS (SELECT event_id AS version, ts, event_type AS operation, CASE WHEN event_type = 'error' THEN CAST(round(value) AS BIGINT) ELSE 0 END AS rows_deleted, CASE WHEN event_type = 'purchase' THEN CAST(round(value) AS BIGINT) ELSE 0 END AS rows_updated FROM events)
"""


def operation_history(i):
    amount = F.round("value").cast("bigint")
    return i.events.select(
        F.col("event_id").alias("version"), "ts", F.col("event_type").alias("operation"), F.when(F.col("event_type") == "error", amount).otherwise(0).alias("rows_deleted"),
        F.when(F.col("event_type") == "purchase", amount).otherwise(0).alias("rows_updated"),
    )


@query("m18_change_impact", f"""
WITH {HISTORY} SELECT * FROM (SELECT 'rows_deleted' AS measure, version, ts, operation, rows_deleted AS amount FROM hist WHERE rows_deleted > 0 ORDER BY rows_deleted DESC, version LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'rows_updated', version, ts, operation, rows_updated FROM hist WHERE rows_updated > 0 ORDER BY rows_updated DESC, version LIMIT 10)
""")
def m18(i):
    return K.change_impact(operation_history(i), ["rows_deleted", "rows_updated"], "version", ["ts", "operation"], 10)


@query("m18_operation_totals", f"WITH {HISTORY} SELECT operation, count(*) AS operations, CAST(sum(rows_deleted) AS BIGINT) AS total_rows_deleted, CAST(sum(rows_updated) AS BIGINT) AS total_rows_updated FROM hist GROUP BY operation")
def m18_totals(i):
    return K.operation_totals(operation_history(i), "operation", ["rows_deleted", "rows_updated"])


@query("m19_status_counts", "SELECT CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'ok' END AS status, count(*) AS row_count FROM events GROUP BY 1")
def m19_status(i):
    return K.status_counts(i.events.select(F.when(F.col("event_type") == "error", "rejected").otherwise("ok").alias("status")), "status")


@query("m19_reject_summary", """
WITH r AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'ok' END AS status, CASE WHEN value > 100 THEN 'Limit Exceeded in flow' WHEN value > 50 THEN 'DUPLICATE_VALUE on key' ELSE 'unexpected ' || props END AS message FROM events)
SELECT message, CASE WHEN message LIKE '%Limit Exceeded%' THEN 'Limits' WHEN message LIKE '%DUPLICATE_VALUE%' THEN 'Duplicates' ELSE 'Other' END AS category, count(*) AS row_count, min(event_id) AS sample_id FROM r WHERE status = 'rejected' GROUP BY 1, 2
""")
def m19(i):
    message = F.when(F.col("value") > 100, "Limit Exceeded in flow").when(F.col("value") > 50, "DUPLICATE_VALUE on key").otherwise(F.concat(F.lit("unexpected "), "props"))
    rows = i.events.select("event_id", F.when(F.col("event_type") == "error", "rejected").otherwise("ok").alias("status"), message.alias("message"))
    return K.reject_summary(rows, "status", "message", "event_id", [("Limit Exceeded", "Limits"), ("DUPLICATE_VALUE", "Duplicates")], "rejected")


COPIED = """
cp AS (SELECT e.id, e.name AS own_name, p.name AS company_name, CASE WHEN e.units > 12 THEN e.name WHEN e.segment = 'BUILDING' THEN NULL WHEN e.balance < 100 THEN 'Someone' ELSE p0.name END AS copied
  FROM entity e JOIN parent p0 ON p0.id = e.parent_id LEFT JOIN parent p ON p.id = e.parent_id AND NOT p.is_deleted),
st AS (SELECT *, CASE WHEN copied = company_name THEN 'CORRECT' WHEN copied = own_name THEN 'STILL_BROKEN' WHEN copied IS NULL THEN 'NULL' ELSE 'OTHER' END AS check_status FROM cp)
"""


def copied(i):
    live = i.parent.filter("NOT is_deleted").select(F.col("id").alias("parent_id"), F.col("name").alias("company_name"))
    every = i.parent.select(F.col("id").alias("parent_id"), F.col("name").alias("any_name"))
    value = F.when(F.col("units") > 12, F.col("own_name")).when(F.col("segment") == "BUILDING", None).when(F.col("balance") < 100, "Someone").otherwise(F.col("any_name"))
    rows = i.entity.withColumnRenamed("name", "own_name").join(every, "parent_id").join(live, "parent_id", "left")
    return K.value_source_check(rows.withColumn("copied", value), "copied", "company_name", "own_name")


@query("m20_value_source_check", f"WITH {COPIED} SELECT id, copied, check_status FROM st")
def m20(i):
    return copied(i).select("id", "copied", "check_status")


@query("m20_value_source_summary", f"""
WITH {COPIED} SELECT check_status, count(*) AS row_count, count(*) FILTER (WHERE copied IS NULL AND company_name IS NOT NULL) AS fillable, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percentage FROM st GROUP BY check_status
""")
def m20_summary(i):
    return K.value_source_summary(copied(i), "copied", "company_name")


@query("m22_completeness_profile", """
SELECT 'sync_key' AS column_name, 'filled' AS kind, count(sync_key) AS row_count, round(100.0::DOUBLE * count(sync_key) / count(*), 2) AS pct FROM target UNION ALL SELECT 'target_name', 'filled', count(target_name), round(100.0::DOUBLE * count(target_name) / count(*), 2) FROM target
UNION ALL SELECT 'a_enabled', 'enabled', count(*) FILTER (WHERE a_enabled), round(100.0::DOUBLE * count(*) FILTER (WHERE a_enabled) / count(*), 2) FROM target
UNION ALL SELECT 'a_enabled', 'disabled', count(*) FILTER (WHERE NOT a_enabled), round(100.0::DOUBLE * count(*) FILTER (WHERE NOT a_enabled) / count(*), 2) FROM target
""")
def m22(i):
    return K.completeness_profile(i.target, ["sync_key", "target_name"], ["a_enabled"])


@query("m23_sync_result_check", """
WITH c AS (SELECT CASE WHEN target_name IS NULL THEN NULL ELSE source_id END AS own_id, source_id AS sync_id, CASE WHEN b_enabled THEN parent_id ELSE parent_id + 20 END AS parent_id FROM target)
SELECT count(*) AS created, count(DISTINCT own_id) AS unique_ids, count(*) FILTER (WHERE own_id IS NULL) AS missing_id, count(*) FILTER (WHERE sync_id IS NULL) AS missing_sync_id, count(*) FILTER (WHERE own_id = sync_id) AS matching_ids,
  count(*) FILTER (WHERE own_id IN (SELECT id FROM entity WHERE status <> 'DELETED')) AS linked_to_source, count(*) FILTER (WHERE parent_id IN (SELECT id FROM parent)) AS linked_to_parent, count(*) FILTER (WHERE parent_id NOT IN (SELECT id FROM parent)) AS orphans FROM c
""")
def m23(i):
    created = i.target.select(
        F.when(F.col("target_name").isNotNull(), F.col("source_id")).alias("own_id"), F.col("source_id").alias("sync_id"),
        F.when(F.col("b_enabled"), F.col("parent_id")).otherwise(F.col("parent_id") + 20).alias("parent_id"),
    )
    return K.sync_result_check(created, i.entity.filter("status <> 'DELETED'"), i.parent, "own_id", "sync_id", "parent_id", "id", "id")


@query("m24_multi_case_summary", f"""
WITH {AGGREGATED} SELECT count(*) AS multi_keys, CAST(sum(active_count) AS BIGINT) AS rows_in_them, max(active_count) AS largest, round(CAST(sum(active_count) AS DOUBLE) / count(*), 4) AS mean_size FROM agg WHERE is_multi
""")
def m24(i):
    return K.multi_case_summary(aggregated(i))


@query("m24_missing_with_features", f"""
WITH {QUEUES} SELECT count(*) AS with_features, count(*) FILTER (WHERE a_enabled) AS with_a_enabled, count(*) FILTER (WHERE b_enabled) AS with_b_enabled FROM cq WHERE has_any_flag
""")
def m24_missing(i):
    _, _, creates, _ = stack(i)
    return K.missing_with_features(creates, ["a_enabled", "b_enabled"])


@query("m24_flag_not_copied", f"""
WITH {AGGREGATED}, lt AS (SELECT sync_key, COALESCE(bool_or(a_enabled), FALSE) AS t FROM target WHERE NOT is_deleted GROUP BY sync_key) SELECT agg.sync_key, agg.a_enabled FROM agg JOIN lt ON lt.sync_key = agg.sync_key WHERE agg.a_enabled AND NOT lt.t
""")
def m24_flag(i):
    return K.flag_not_copied(aggregated(i), i.target.filter("NOT is_deleted"), "sync_key", "sync_key", "a_enabled", "a_enabled")
