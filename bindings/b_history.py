"""J18-J20, J28, J31, J32, J34, W7-W9, W12, A40, A41."""

from pyspark.sql import functions as F

from bindings.base import query
from crosswalk.operators import history as H


@query("j18_feature_effective_join", """
WITH s AS (SELECT user_id, min(ts) AS enabled_at FROM events WHERE event_type = 'signup' AND value > 60 GROUP BY user_id)
SELECT e.event_id, e.user_id, e.ts, s.enabled_at FROM events e JOIN s ON s.user_id = e.user_id AND e.ts >= s.enabled_at
""")
def j18(i):
    features = i.events.filter("event_type = 'signup' AND value > 60").select("user_id", F.col("ts").alias("at"))
    return H.feature_effective_join(i.events, features, "user_id", "ts", "at").select("event_id", "user_id", "ts", "enabled_at")


@query("j19_pair_events", """
WITH s AS (SELECT item_id, min(changed_at) AS started_at FROM status_log WHERE status = 'view' GROUP BY item_id)
SELECT s.item_id, s.started_at, min(l.changed_at) AS finished_at, round((epoch_us(min(l.changed_at)) - epoch_us(s.started_at))::DOUBLE / 60000000, 4) AS minutes
FROM s JOIN status_log l ON l.item_id = s.item_id AND l.status = 'purchase' AND l.changed_at > s.started_at GROUP BY s.item_id, s.started_at
""")
def j19(i):
    return H.pair_events(i.status_log, "item_id", "status", "changed_at", "view", "purchase")


@query("j19_pair_average", """
SELECT count(*) AS pairs, round(CAST(sum(epoch_us(b.changed_at) - epoch_us(a.changed_at)) AS DOUBLE) / count(*) / 60000000, 4) AS avg_minutes
FROM status_log a JOIN status_log b ON a.item_id = b.item_id AND a.status = 'view' AND b.status = 'purchase' AND b.changed_at > a.changed_at
""")
def j19_average(i):
    return H.pair_average(i.status_log, "item_id", "status", "changed_at", "view", "purchase")


@query("j20_period_gaps", """
WITH p AS (SELECT o_orderkey AS id, o_custkey AS key, o_orderdate AS start_at, CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(20 + 120 * (o_orderkey % 3) AS INTEGER)) AS end_at FROM orders),
l AS (SELECT *, max({'at': end_at, 'id': id}) OVER (PARTITION BY key ORDER BY start_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM p)
SELECT key, last.id AS after_id, id AS before_id, last.at AS gap_start, start_at AS gap_end, round((epoch_us(start_at) - epoch_us(last.at))::DOUBLE / 86400000000, 4) AS gap_days
FROM l WHERE epoch_us(start_at) - epoch_us(last.at) > 7 * 86400000000
""")
def j20(i):
    """Periods of 20, 140 and 260 days, so that short ones lie within long ones."""
    end = F.timestamp_seconds(F.unix_timestamp("o_orderdate") + (20 + 120 * (F.col("o_orderkey") % 3)) * 86_400)
    periods = i.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("key"), F.col("o_orderdate").alias("start_at"), end.alias("end_at"))
    return H.period_gaps(periods, "key", "start_at", "end_at", "id", 7)


@query("j20_open_period_gaps", """
WITH p AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS key, o_orderdate AS start_at,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS TIMESTAMP) + to_days(1) WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) + to_days(3) END AS end_at FROM orders),
l AS (SELECT *, max({'at': COALESCE(end_at, TIMESTAMP '9999-12-31'), 'id': id}) OVER (PARTITION BY key ORDER BY start_at, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM p)
SELECT key, last.id AS after_id, id AS before_id, last.at AS gap_start, start_at AS gap_end, round((epoch_us(start_at) - epoch_us(last.at))::DOUBLE / 86400000000, 4) AS gap_days
FROM l WHERE epoch_us(start_at) - epoch_us(last.at) > 7 * 86400000000
""")
def j20_open(i):
    """A third of all periods under one key, cut into pieces; a period that is still open covers all later ones."""
    days = F.when(F.col("o_orderpriority") != "5-LOW", 1).when(F.col("o_orderkey") % 50 != 0, 3)
    periods = i.orders.select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_custkey") % 3 == 0, 0).otherwise(F.col("o_custkey")).alias("key"), F.col("o_orderdate").alias("start_at"),
        F.timestamp_seconds(F.unix_timestamp("o_orderdate") + days * 86_400).alias("end_at"),
    )
    return H.period_gaps(periods, "key", "start_at", "end_at", "id", 7, "year", open_covers=True, rows=400)


@query("j28_still_in_state", """
SELECT DISTINCT item_id, changed_at AS since FROM status_log a WHERE status = 'error' AND NOT EXISTS (
  SELECT 1 FROM status_log b WHERE b.item_id = a.item_id AND b.status IN ('purchase', 'signup') AND b.changed_at > a.changed_at)
""")
def j28(i):
    return H.still_in_state(i.status_log, ["item_id"], "status", "changed_at", "error", ["purchase", "signup"])


@query("j31_cross_service_context", """
WITH li AS (SELECT l_orderkey, count(*) AS n, max((l_shipdate, l_linenumber, l_returnflag)) AS m FROM lineitem GROUP BY l_orderkey),
ev AS (SELECT user_id, count(*) AS n, arg_max(event_type, (ts, event_type, value)) AS event_type, arg_max(value, (ts, event_type, value)) AS value FROM events GROUP BY user_id)
SELECT o.o_orderkey, c.c_name, COALESCE(li.n, 0) AS line_records, li.m[2] AS line_l_linenumber, li.m[3] AS line_l_returnflag, COALESCE(ev.n, 0) AS event_records,
  ev.event_type AS event_event_type, ev.value AS event_value
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN li ON li.l_orderkey = o.o_orderkey LEFT JOIN ev ON ev.user_id = o.o_orderkey
""")
def j31(i):
    root = i.orders.join(i.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name")
    services = {
        "line": (i.lineitem, "l_orderkey", "l_shipdate", ["l_linenumber", "l_returnflag"]),
        "event": (i.events.withColumn("user_text", F.col("user_id").cast("string")), "user_text", "ts", ["event_type", "value"]),
    }
    return H.cross_service_context(root, "o_orderkey", services)


@query("j32_eligible_next", f"""
WITH w AS (SELECT event_id, event_type, ts, CASE WHEN value > 100 THEN 1 WHEN value > 50 THEN 2 ELSE 3 END AS priority FROM events
  WHERE event_type <> 'signup' AND ts <= TIMESTAMP '2024-01-20 00:00:00'),
perm AS (SELECT DISTINCT o_custkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'error' WHEN '2-HIGH' THEN 'purchase' WHEN '3-MEDIUM' THEN 'click' ELSE 'view' END AS event_type FROM orders WHERE o_orderstatus = 'O')
SELECT o_custkey, event_type, priority, ts, event_id FROM (SELECT p.o_custkey, w.*, row_number() OVER (PARTITION BY o_custkey ORDER BY priority, ts, event_id) AS rn
  FROM perm p JOIN w ON w.event_type = p.event_type) WHERE rn = 1
""")
def j32(i):
    group = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "error").when(F.col("o_orderpriority") == "2-HIGH", "purchase")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "click").otherwise("view")
    )
    permissions = i.orders.filter("o_orderstatus = 'O'").select("o_custkey", group.alias("event_type"))
    priority = F.when(F.col("value") > 100, 1).when(F.col("value") > 50, 2).otherwise(3)
    return H.eligible_next(
        i.events, permissions, F.col("event_type") != "signup", "event_type", "o_custkey", "event_id", "ts", "2024-01-20 00:00:00", priority
    )


@query("j34_overridden_decisions", """
WITH r AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' THEN 3 WHEN event_type IN ('click', 'view') THEN 1 ELSE 2 END AS kind, CASE WHEN value > 50 THEN 'FRAUD' ELSE 'CLEAN' END AS label FROM events),
o AS (SELECT user_id, arg_max(label, (ts, event_id)) AS label, arg_max(ts, (ts, event_id)) AS ts FROM r WHERE kind = 3 GROUP BY user_id)
SELECT r.user_id, r.event_id, r.label AS original_label, o.label AS override_label, o.ts AS override_at FROM r JOIN o ON o.user_id = r.user_id AND o.ts > r.ts WHERE r.kind = 1
""")
def j34(i):
    kind = F.when(F.col("event_type") == "error", 3).when(F.col("event_type").isin("click", "view"), 1).otherwise(2)
    rows = i.events.select("event_id", "user_id", "ts", kind.alias("kind"), F.when(F.col("value") > 50, "FRAUD").otherwise("CLEAN").alias("label"))
    return H.overridden_decisions(rows, "user_id", "kind", "label", "ts", "event_id", 1, 3)


@query("w7_day_over_day", """
WITH d AS (SELECT CAST(CAST(ts AS DATE) AS STRING) AS day, count(*) AS checks FROM events GROUP BY 1)
SELECT day, checks, lag(checks) OVER (ORDER BY day) AS prev_checks, checks - lag(checks) OVER (ORDER BY day) AS change FROM d
""")
def w7(i):
    return H.day_over_day(i.events, "ts", F.count(F.lit(1)), "checks")


@query("w8_time_in_status", """
SELECT item_id, status, changed_at, log_id, lag(status) OVER w AS prev_status, lag(changed_at) OVER w AS prev_changed_at,
  (epoch_us(changed_at) - epoch_us(lag(changed_at) OVER w)) // 1000000 AS seconds_since FROM status_log WINDOW w AS (PARTITION BY item_id ORDER BY changed_at, log_id)
""")
def w8(i):
    return H.time_in_status(i.status_log, "item_id", "status", "changed_at", "log_id")


HOT_HOUR = """
log AS (SELECT log_id, status, CASE WHEN item_id % 3 = 0 THEN 0 ELSE item_id END AS item_id, CASE WHEN item_id % 3 = 0 THEN TIMESTAMP '2024-01-05 03:00:00' + to_seconds(CAST(value AS INTEGER)) ELSE changed_at END AS changed_at FROM status_log)
"""


def hot_hour(i):
    """A third of all changes belong to one item and happen within two minutes."""
    hot = F.col("item_id") % 3 == 0
    return i.status_log.select(
        "log_id", "status", F.when(hot, 0).otherwise(F.col("item_id")).alias("item_id"),
        F.when(hot, F.timestamp_seconds(F.lit(1704423600) + F.round("value", 0).cast("long")).cast("timestamp_ntz")).otherwise(F.col("changed_at")).alias("changed_at"),
    )


@query("w8_hot_hour", f"""
WITH {HOT_HOUR} SELECT item_id, status, changed_at, log_id, lag(status) OVER w AS prev_status, lag(changed_at) OVER w AS prev_changed_at,
  (epoch_us(changed_at) - epoch_us(lag(changed_at) OVER w)) // 1000000 AS seconds_since FROM log WINDOW w AS (PARTITION BY item_id ORDER BY changed_at, log_id)
""")
def w8_hot(i):
    return H.time_in_status(hot_hour(i), "item_id", "status", "changed_at", "log_id", rows=300)


@query("j19_hot_hour_average", f"""
WITH {HOT_HOUR}, n AS (SELECT item_id, changed_at, count(*) FILTER (WHERE status = 'view') AS b, count(*) FILTER (WHERE status = 'purchase') AS e FROM log GROUP BY item_id, changed_at)
SELECT CAST(sum(a.b * z.e) AS BIGINT) AS pairs, round(CAST(sum(a.b * z.e * (epoch_us(z.changed_at) - epoch_us(a.changed_at))) AS DOUBLE) / sum(a.b * z.e) / 60000000, 4) AS avg_minutes
FROM n a JOIN n z ON a.item_id = z.item_id AND z.changed_at > a.changed_at
""")
def j19_hot(i):
    return H.pair_average(hot_hour(i), "item_id", "status", "changed_at", "view", "purchase", rows=20)


@query("w9_cumulative_enabled", """
WITH d AS (SELECT code, CAST(CAST(changed_at AS DATE) AS STRING) AS day, count(*) AS row_count FROM feature_log WHERE state = 'enabled' GROUP BY 1, 2)
SELECT code, day, row_count, CAST(sum(row_count) OVER (PARTITION BY code ORDER BY day) AS BIGINT) AS cumulative FROM d
""")
def w9(i):
    return H.cumulative_by_day(i.feature_log.filter("state = 'enabled'"), "code", "changed_at")


CURRENT = """
cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, code ORDER BY changed_at DESC NULLS LAST, log_id DESC) AS rn FROM feature_log) WHERE rn = 1)
"""


@query("w12_event_current_state", f"WITH {CURRENT} SELECT entity_id, code, state, changed_at AS since FROM cur")
def w12(i):
    return H.event_current_state(i.feature_log, "entity_id", "code", "state", "changed_at", "log_id")


@query("w12_enabled_set", f"""
WITH {CURRENT} SELECT entity_id, COALESCE(string_agg(code, ',' ORDER BY code) FILTER (WHERE state = 'enabled'), '') AS enabled_codes,
  CAST(count(*) FILTER (WHERE state = 'enabled') AS INT) AS enabled_count FROM cur GROUP BY entity_id
""")
def w12_set(i):
    return H.enabled_set(H.event_current_state(i.feature_log, "entity_id", "code", "state", "changed_at", "log_id"), "entity_id", "code", "state", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


@query("a40_lifecycle_duration", """
SELECT item_id, min(changed_at) FILTER (WHERE status = 'signup') AS activated_at, max(changed_at) FILTER (WHERE status = 'error' AND value > 100) AS deactivated_at,
  round((epoch_us(max(changed_at) FILTER (WHERE status = 'error' AND value > 100)) - epoch_us(min(changed_at) FILTER (WHERE status = 'signup')))::DOUBLE / 3600000000, 4) AS lifetime_hours
FROM status_log GROUP BY item_id HAVING max(changed_at) FILTER (WHERE status = 'error' AND value > 100) IS NOT NULL
""")
def a40(i):
    rows = i.status_log.withColumn("status", F.when((F.col("status") == "error") & (F.col("value") > 100), "closed").otherwise(F.col("status")))
    return H.lifecycle_duration(rows, "item_id", "status", "changed_at", "signup", "closed")


@query("a41_toggle_counts", "SELECT entity_id, count(*) AS toggles FROM feature_log WHERE code = '2-HIGH' GROUP BY entity_id HAVING count(*) > 1")
def a41(i):
    return H.toggle_counts(i.feature_log.filter("code = '2-HIGH'"), "entity_id")
