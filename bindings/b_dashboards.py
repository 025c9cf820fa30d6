"""A3-A10: feature families and dashboard figures."""

from pyspark.sql import functions as F

from bindings.base import AS_OF_EVENTS, query
from crosswalk.operators import aggregates as A

LABELS = {"passed": "PASS", "failed": "FAIL", "needs_review": "NEEDS REVIEW"}
COUNTS = "count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'FAIL') AS failed, count(*) FILTER (WHERE status = 'NEEDS REVIEW') AS needs_review"


def rate(digits):
    return f"round(100.0::DOUBLE * count(*) FILTER (WHERE status = 'PASS') / count(*), {digits}) AS pass_rate"


TYPED = """
t AS (SELECT e.id, count(DISTINCT f.code) AS feature_count, COALESCE(string_agg(DISTINCT f.code, ', ' ORDER BY f.code), '') AS feature_list,
  CASE WHEN count(DISTINCT f.code) = 0 THEN 'No Features' WHEN count(*) FILTER (WHERE f.code NOT LIKE '%URGENT%' AND f.code NOT LIKE '%HIGH%') = 0 THEN 'Urgent Only' ELSE 'Mixed Features' END AS feature_type
  FROM entity e LEFT JOIN feature_log f ON f.entity_id = e.id AND f.state = 'enabled' WHERE e.status = 'ACTIVE' GROUP BY e.id)
"""


def typed(i):
    family = F.col("code").contains("URGENT") | F.col("code").contains("HIGH")
    return A.feature_family_type(
        i.entity.filter("status = 'ACTIVE'"), i.feature_log.filter("state = 'enabled'"), "id", "entity_id", "code", family, "Urgent Only", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    )


@query("a3_single_feature_entities", f"WITH {TYPED} SELECT id, feature_count, feature_list, feature_type FROM t")
def a3(i):
    return typed(i).select("id", "feature_count", "feature_list", "feature_type")


@query("a3_feature_type_counts", f"WITH {TYPED} SELECT feature_type, count(*) AS entity_count, CAST(sum(feature_count) AS BIGINT) AS total_features FROM t GROUP BY 1")
def a3_counts(i):
    return A.feature_type_counts(typed(i))


@query("a4_kpi_summary", f"""
SELECT count(*) AS total, count(DISTINCT entity_id) AS entities, count(DISTINCT parent_id) AS parents, {COUNTS},
  round(100.0::DOUBLE * count(*) FILTER (WHERE status = 'PASS') / count(*), 2) AS passed_rate, round(100.0::DOUBLE * count(*) FILTER (WHERE status = 'FAIL') / count(*), 2) AS failed_rate FROM checked
""")
def a4(i):
    return A.kpi_summary(i.checked, "status", LABELS, {"entities": "entity_id", "parents": "parent_id"}, ["passed", "failed"])


@query("a5_parent_performance", f"""
SELECT parent_name, count(*) AS total, count(DISTINCT entity_id) AS entities, {COUNTS}, {rate(1)}, min(inserted_at) AS first_at, max(inserted_at) AS last_at FROM checked GROUP BY parent_name
""")
def a5(i):
    return A.group_performance(i.checked, ["parent_name"], "status", LABELS, "passed", "inserted_at", distinct={"entities": "entity_id"})


@query("a5_entity_performance", f"""
SELECT entity_name, parent_name, segment, count(*) AS total, {COUNTS}, {rate(1)}, min(inserted_at) AS first_at, max(inserted_at) AS last_at,
  CAST(date_diff('day', CAST(max(inserted_at) AS DATE), DATE '2024-01-31') AS INT) AS days_since_last FROM checked GROUP BY ALL
""")
def a5_entity(i):
    return A.group_performance(i.checked, ["entity_name", "parent_name", "segment"], "status", LABELS, "passed", "inserted_at", AS_OF_EVENTS)


@query("a6_daily_status_counts", "SELECT CAST(CAST(inserted_at AS DATE) AS STRING) AS day, status, count(*) AS row_count FROM checked GROUP BY 1, 2")
def a6(i):
    return A.daily_status_counts(i.checked, "inserted_at", "status")


@query("a6_weekly_summary", f"SELECT CAST(CAST(date_trunc('week', inserted_at) AS DATE) AS STRING) AS week_start, count(*) AS total, {COUNTS}, {rate(2)} FROM checked GROUP BY 1")
def a6_weekly(i):
    return A.weekly_summary(i.checked, "inserted_at", "status", LABELS, "passed")


@query("a7_status_distribution", "SELECT status, count(*) AS row_count, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percentage FROM checked GROUP BY status")
def a7(i):
    return A.distribution_pct(i.checked, "status", "status")


@query("a7_failure_reasons", """
SELECT reason, row_count, percentage FROM (SELECT 'level ' || CAST(level AS STRING) AS reason, count(*) AS row_count, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percentage
  FROM checked WHERE status = 'FAIL' GROUP BY level) ORDER BY row_count DESC, reason LIMIT 10
""")
def a7_reasons(i):
    reason = F.concat(F.lit("level "), F.col("level").cast("string"))
    return A.distribution_pct(i.checked.filter("status = 'FAIL'"), reason, "reason", 10)


@query("a7_copies_distribution", """
SELECT copies, count(*) AS row_count, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percentage FROM (SELECT sync_key, count(*) AS copies FROM entity WHERE sync_key IS NOT NULL GROUP BY sync_key) GROUP BY copies
""")
def a7_copies(i):
    copies = i.entity.filter("sync_key IS NOT NULL").groupBy("sync_key").agg(F.count(F.lit(1)).alias("copies"))
    return A.distribution_pct(copies, "copies", "copies")


@query("a8_provider_comparison", f"""
SELECT CASE provider WHEN 'north' THEN 'North' WHEN 'south' THEN 'South' ELSE 'Other' END AS provider_name, count(*) AS total, {COUNTS}, {rate(2)} FROM checked GROUP BY 1
""")
def a8(i):
    name = F.when(F.col("provider") == "north", "North").when(F.col("provider") == "south", "South").otherwise("Other")
    return A.group_performance(i.checked, [name.alias("provider_name")], "status", LABELS, "passed", digits=2)


@query("a8_geo_performance", f"""
WITH g AS (SELECT *, CASE WHEN region_id <> 4 THEN 'R' || CAST(region_id AS STRING) END AS region FROM checked)
SELECT region, count(*) AS total, count(DISTINCT entity_id) AS entities, {COUNTS}, {rate(2)} FROM g WHERE region IS NOT NULL GROUP BY region
""")
def a8_geo(i):
    region = F.when(F.col("region_id") != 4, F.concat(F.lit("R"), F.col("region_id").cast("string")))
    rows = i.checked.withColumn("region", region).filter("region IS NOT NULL")
    return A.group_performance(rows, ["region"], "status", LABELS, "passed", distinct={"entities": "entity_id"}, digits=2)


@query("a9_recent_detail", """
SELECT inserted_at, parent_name, entity_name, status, provider, CASE WHEN provider = 'north' THEN CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) > 66 THEN 'Enhanced'
  WHEN CAST(json_extract_string(props, '$.k') AS INT) > 33 THEN 'Basic' ELSE 'N/A' END ELSE 'N/A' END AS verification_level,
  CAST(date_diff('day', CAST(inserted_at AS DATE), DATE '2024-01-31') AS INT) AS days_ago FROM checked ORDER BY inserted_at DESC, id LIMIT 100
""")
def a9(i):
    k = F.get_json_object("props", "$.k").cast("int")
    level = F.when(F.col("provider") == "north", F.when(k > 66, "Enhanced").when(k > 33, "Basic").otherwise("N/A")).otherwise("N/A")
    return A.recent_detail(
        i.checked, "inserted_at", "id", ["inserted_at", "parent_name", "entity_name", "status", "provider"], {"verification_level": level}, AS_OF_EVENTS, 100
    )


@query("a10_parent_filter_list", "SELECT DISTINCT parent_id AS company_id, parent_name AS company_name FROM checked")
def a10(i):
    return A.filter_list(i.checked, {"company_id": "parent_id", "company_name": "parent_name"}, ["company_name"])


@query("a10_child_filter_list", "SELECT DISTINCT entity_id, entity_name, parent_name FROM checked WHERE parent_name = 'NATION_7'")
def a10_child(i):
    rows = i.checked.filter("parent_name = 'NATION_7'")
    return A.filter_list(rows, {"entity_id": "entity_id", "entity_name": "entity_name", "parent_name": "parent_name"}, ["parent_name", "entity_name"])
