"""F1-F16: selection, text rules and rule columns."""

from pyspark.sql import functions as F

from bindings.base import AS_OF_EVENTS, AS_OF_ORDERS, frame, query
from crosswalk.functions import columns as C
from crosswalk.operators import filters as L

RULES = [
    ("contains", "test", "has test"),
    ("contains", "demo", "has demo"),
    ("contains", "ring", "has ring"),
    ("regex", r"^red[_\s-]", "starts red"),
    ("ends", "bolt", "ends bolt"),
]
RULE_SQL = """lower(name) LIKE '%test%' OR lower(name) LIKE '%demo%' OR lower(name) LIKE '%ring%'
  OR regexp_matches(lower(name), '^red[_\\s-]') OR lower(name) LIKE '%bolt'"""
LABEL_SQL = """CASE WHEN lower(name) LIKE '%test%' THEN 'has test' WHEN lower(name) LIKE '%demo%' THEN 'has demo'
  WHEN lower(name) LIKE '%ring%' THEN 'has ring' WHEN regexp_matches(lower(name), '^red[_\\s-]') THEN 'starts red'
  WHEN lower(name) LIKE '%bolt' THEN 'ends bolt' ELSE 'other' END"""


@query("f1_exclusion_filter", """
SELECT id, name FROM item WHERE NOT (
  (upper(name) LIKE '%TEST%' OR upper(name) LIKE '%-DEMO%' OR upper(kind) LIKE '%TEST%' OR upper(kind) LIKE '%-DEMO%'
   OR upper(name) = 'RED BOLT' OR upper(kind) = 'RED BOLT' OR brand IN ('Brand#7', 'Brand#9')) AND NOT kind IN ('LARGE'))
""")
def f1(i):
    return L.exclusion_filter(
        i.item, ["name", "kind"], ["%TEST%", "%-demo%"], ["Red Bolt"], {"brand": ["Brand#7", "Brand#9"]}, {"kind": ["LARGE"]}
    ).select("id", "name")


@query("f3_valid_records", """
SELECT id, status = 'ACTIVE' AS is_active, sync_key IS NOT NULL AND sync_key <> 'XXXXXXXXXXXXXXX' AS has_valid_key
FROM entity WHERE parent_id IS NOT NULL AND status <> 'DELETED'
""")
def f3(i):
    return L.valid_records(i.entity, "parent_id", "status", "sync_key", sentinels=["XXXXXXXXXXXXXXX"]).select(
        "id", "is_active", "has_valid_key"
    )


@query("f4_keyword_classifier", f"SELECT id, name, {LABEL_SQL} AS detection FROM item WHERE {RULE_SQL}")
def f4(i):
    return L.keyword_classifier(i.item, "name", RULES, "other").select("id", "name", "detection")


@query("f5_keyword_flag", f"SELECT DISTINCT id FROM item WHERE {RULE_SQL}")
def f5(i):
    return L.keyword_flag(i.item, "id", "name", RULES)


@query("f5_keyword_counts", """
SELECT 'has test' AS keyword, status, count(*) AS row_count FROM item WHERE lower(name) LIKE '%test%' GROUP BY ALL
UNION ALL SELECT 'has demo', status, count(*) FROM item WHERE lower(name) LIKE '%demo%' GROUP BY ALL
UNION ALL SELECT 'has ring', status, count(*) FROM item WHERE lower(name) LIKE '%ring%' GROUP BY ALL
UNION ALL SELECT 'starts red', status, count(*) FROM item WHERE regexp_matches(lower(name), '^red[_\\s-]') GROUP BY ALL
UNION ALL SELECT 'ends bolt', status, count(*) FROM item WHERE lower(name) LIKE '%bolt' GROUP BY ALL
""")
def f5_counts(i):
    return L.keyword_counts(i.item, "name", RULES, ["status"])


@query("f6_suspicion_score", """
WITH m AS (SELECT id, name, status, CAST(size <= 10 AS INT) AS small_size, CAST(price < 1000 AS INT) AS cheap,
    CAST(regexp_matches(name, '^[a-f]') AS INT) AS early_letter, CAST(length(name) < 9 AS INT) AS short_name FROM item WHERE status = 'ACTIVE')
SELECT *, small_size + cheap + early_letter + short_name AS suspicion_score FROM m
WHERE small_size + cheap + early_letter + short_name >= 2 ORDER BY suspicion_score DESC, id LIMIT 100
""")
def f6(i):
    rows = i.item.filter("status = 'ACTIVE'")
    signals = {
        "small_size": F.col("size") <= 10, "cheap": F.col("price") < 1000,
        "early_letter": F.col("name").rlike("^[a-f]"), "short_name": F.length("name") < 9,
    }
    out = L.suspicion_score(rows, signals, [F.col("id")], top=100)
    return out.select("id", "name", "status", *signals, "suspicion_score")


@query("f7_parent_keyword_rollup", """
SELECT p.id AS parent_id, p.name, count(e.id) AS child_count, count(*) FILTER (WHERE e.status = 'ACTIVE') AS active_child_count
FROM parent p LEFT JOIN entity e ON e.parent_id = p.id WHERE lower(p.name) LIKE '%_1%' GROUP BY p.id, p.name
""")
def f7(i):
    parents = i.parent.withColumnRenamed("id", "parent_id")
    out = L.parent_keyword_rollup(
        parents, i.entity, "name", [("like", "%_1%", "one")], "parent_id", "parent_id", F.col("status") == "ACTIVE"
    )
    return out.select("parent_id", "name", "child_count", "active_child_count")


@query("f8_series_parse", r"""
WITH w AS (SELECT id, lower(name) AS t, regexp_extract(lower(name), '\bphase\s*([0-9]+|[ivx]+)\b', 1) AS word FROM item)
SELECT id, CASE word WHEN 'i' THEN 1 WHEN 'ii' THEN 2 WHEN 'iii' THEN 3 WHEN 'iv' THEN 4 WHEN 'v' THEN 5 ELSE TRY_CAST(word AS INT) END AS number,
  CASE WHEN t LIKE '%phase 1%' THEN 1 WHEN t LIKE '%phase 2%' THEN 2 WHEN t LIKE '%phase 3%' THEN 3 WHEN t LIKE '%phase 4%' THEN 4
    WHEN t LIKE '%phase 5%' THEN 5 ELSE COALESCE(TRY_CAST(regexp_extract(t, 'phase\s*([0-9]+)', 1) AS INT), 0) END AS legacy_number,
  regexp_replace(regexp_replace(t, '\bphase\s*([0-9]+|[ivx]+)\b', ''), '[^a-z0-9]', '', 'g') AS base
FROM w
""")
def f8(i):
    return i.item.select(
        "id", C.series_number(F.col("name")).alias("number"), C.series_number(F.col("name"), legacy=True).alias("legacy_number"),
        C.series_base(F.col("name")).alias("base"),
    )


frame("series_names", """
SELECT id, CASE id % 7 WHEN 0 THEN 'Oak Phase XI' WHEN 1 THEN 'Oak phase xlix North' WHEN 2 THEN 'Elm Phase MCMXCIV' WHEN 3 THEN 'Elm Phase 30000000000'
  WHEN 4 THEN 'Elm Phase IIX' WHEN 5 THEN 'Río Phase XC' ELSE '東京 phase 7' END AS name FROM item
""")


@query("f8_series_any_number", """
SELECT id, CASE id % 7 WHEN 0 THEN 11 WHEN 1 THEN 49 WHEN 2 THEN 1994 WHEN 3 THEN 30000000000 WHEN 5 THEN 90 WHEN 6 THEN 7 END AS number,
  CASE id % 7 WHEN 0 THEN 'oak' WHEN 1 THEN 'oaknorth' WHEN 4 THEN 'elmphaseiix' WHEN 5 THEN 'rio' WHEN 6 THEN '東京' ELSE 'elm' END AS base
FROM series_names
""")
def f8_any(i):
    return i.series_names.select("id", C.series_number(F.col("name")).alias("number"), C.series_base(F.col("name")).alias("base"))


@query("f9_rules_column", """
SELECT id, CASE WHEN status = 'DELETED' THEN 'gone' WHEN sync_key IS NULL THEN 'no key' WHEN balance > 5000 AND units > 10 THEN 'large'
  WHEN units = 0 THEN 'unused' ELSE 'normal' END AS ruling FROM entity
""")
def f9(i):
    rules = [
        (F.col("status") == "DELETED", "gone"), (F.col("sync_key").isNull(), "no key"),
        ((F.col("balance") > 5000) & (F.col("units") > 10), "large"), (F.col("units") == 0, "unused"),
    ]
    return i.entity.select("id", C.first_match(rules, "normal").alias("ruling"))


@query("f10_optional_filter", """
SELECT id, entity_id, inserted_at FROM checks WHERE provider = 'north'
  AND inserted_at >= TIMESTAMP '2024-01-05 00:00:00' AND inserted_at < TIMESTAMP '2024-01-20 00:00:00'
""")
def f10(i):
    out = L.optional_filter(
        i.checks, {"provider": "north", "entity_id": None}, {"inserted_at": ("2024-01-05 00:00:00", "2024-01-20 00:00:00")}
    )
    return out.select("id", "entity_id", "inserted_at")


@query("f11_relative_time_filter", f"""
SELECT event_id, CASE WHEN ts >= TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 7 DAYS AND ts < TIMESTAMP '{AS_OF_EVENTS}' THEN 1 ELSE 0 END AS last_week,
  CASE WHEN ts >= TIMESTAMP '2024-01-29 00:00:00' AND ts < TIMESTAMP '2024-01-30 00:00:00' THEN 1 ELSE 0 END AS on_day,
  CASE WHEN ts < TIMESTAMP '2024-01-29 00:00:00' THEN 1 ELSE 0 END AS before_day
FROM events WHERE ts >= TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 14 DAYS AND ts < TIMESTAMP '{AS_OF_EVENTS}'
""")
def f11(i):
    return i.events.filter(L.relative_time("ts", 14, "DAYS", AS_OF_EVENTS)).select(
        "event_id", L.relative_time("ts", 7, "DAYS", AS_OF_EVENTS).cast("int").alias("last_week"),
        L.today("ts", "2024-01-29 00:00:00").cast("int").alias("on_day"),
        L.before_day("ts", "2024-01-29 00:00:00").cast("int").alias("before_day"),
    )


@query("f12_flag_points", """
SELECT l_orderkey, l_linenumber, points, count(*) AS copies FROM (SELECT l_orderkey, l_linenumber,
  CAST(l_quantity > 25 AS INT) + CAST(l_discount > 0.05 AS INT) + CAST(l_tax > 0.04 AS INT) + CAST(l_returnflag = 'R' AS INT) + CAST(l_linestatus = 'O' AS INT) AS points
  FROM lineitem) WHERE points >= 3 GROUP BY l_orderkey, l_linenumber, points
""")
def f12(i):
    flags = [F.col("l_quantity") > 25, F.col("l_discount") > 0.05, F.col("l_tax") > 0.04, F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"]
    rows = i.lineitem.select("l_orderkey", "l_linenumber", C.flag_total(flags).alias("points")).filter("points >= 3")
    return rows.groupBy("l_orderkey", "l_linenumber", "points").agg(F.count(F.lit(1)).alias("copies"))


@query("f13_recency_bucket", f"""
WITH b AS (SELECT CASE WHEN updated_at IS NULL THEN 'Unknown' WHEN date_diff('day', CAST(updated_at AS DATE), DATE '2001-08-02') <= 30 THEN 'Recent'
    WHEN date_diff('day', CAST(updated_at AS DATE), DATE '2001-08-02') <= 60 THEN 'Acceptable' ELSE 'Stale' END AS bucket FROM entity)
SELECT bucket, count(*) AS row_count, CASE bucket WHEN 'Recent' THEN 1 WHEN 'Acceptable' THEN 2 WHEN 'Stale' THEN 3 ELSE 4 END AS sort_order FROM b GROUP BY bucket
""")
def f13(i):
    age = F.datediff(F.lit(AS_OF_ORDERS).cast("date"), F.col("updated_at"))
    bucket = C.recency_bucket(age, [(30, "Recent"), (60, "Acceptable")], "Stale", "Unknown")
    counts = i.entity.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("sort_order", C.ordered_label(F.col("bucket"), ["Recent", "Acceptable", "Stale"]))


@query("f14_allowlist_sample", """
SELECT id, name FROM entity WHERE id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 200)
""")
def f14(i):
    allowed = i.events.filter("event_type = 'purchase' AND value > 200").select(F.col("user_id").alias("id"))
    return L.allowlist_sample(i.entity, "id", allowed).select("id", "name")


@query("f14_ranked_sample", """
SELECT id, name, units, CASE WHEN units >= 20 THEN 'HIGH' WHEN units >= 10 THEN 'MEDIUM' ELSE 'LOW' END AS priority FROM entity
WHERE status = 'ACTIVE' ORDER BY units DESC, balance DESC, id LIMIT 50
""")
def f14_ranked(i):
    priority = C.first_match([(F.col("units") >= 20, "HIGH"), (F.col("units") >= 10, "MEDIUM")], "LOW")
    out = L.ranked_sample(i.entity.filter("status = 'ACTIVE'"), [F.desc("units"), F.desc("balance"), F.asc("id")], 50, priority)
    return out.select("id", "name", "units", "priority")


@query("f15_date_effective_flag", """
SELECT f.log_id, COALESCE(u.first_use, CASE WHEN f.state = 'enabled' THEN f.changed_at ELSE e.inserted_at END) AS start_at
FROM feature_log f LEFT JOIN (SELECT user_id, min(ts) AS first_use FROM events WHERE event_type = 'view' GROUP BY user_id) u ON u.user_id = f.entity_id
LEFT JOIN entity e ON e.id = f.entity_id
""")
def f15(i):
    use = i.events.filter("event_type = 'view'").groupBy(F.col("user_id").alias("entity_id")).agg(F.min("ts").alias("first_use"))
    created = i.entity.select(F.col("id").alias("entity_id"), "inserted_at")
    rows = i.feature_log.join(use, "entity_id", "left").join(created, "entity_id", "left")
    start = L.start_date_estimate(F.col("first_use"), F.col("changed_at"), F.col("inserted_at"), F.col("state") == "enabled")
    return rows.select("log_id", start.alias("start_at"))


@query("f16_rollout_sample", """
SELECT id, parent_id FROM entity WHERE CAST('0x' || substr(md5(CAST(id AS STRING) || ':pilot-1'), 1, 8) AS BIGINT) % 100 < 10
""")
def f16(i):
    return L.rollout_sample(i.entity, "id", "pilot-1", 10).select("id", "parent_id")
