"""C2 stack, A1, A2, J1-J10, J13, J26, J27, J29, J30, J35-J38."""

from pyspark.sql import functions as F

from bindings.base import query
from crosswalk.functions.scale import chunked_list, member_lists
from crosswalk.operators import reconcile as R
from crosswalk.plans import sync

CODES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}
SPEC = sync.SyncSpec(
    flags={"a_enabled": "a_updated_at", "b_enabled": "b_updated_at"}, metadata=["name", "segment", "inserted_at"], sentinels=["XXXXXXXXXXXXXXX"]
)
LONG_AGO = "1900-01-01 00:00:00"


def newest_first():
    times = [F.coalesce(F.col(t), F.lit(LONG_AGO).cast("timestamp_ntz")) for t in ("a_updated_at", "b_updated_at")]
    return [F.greatest(*times).desc(), F.col("row_id").asc()]


def enriched(i):
    return sync.enriched(i.entity, i.feature_wide, i.parent, SPEC, newest_first())


def aggregated(i):
    return sync.aggregated(enriched(i), SPEC)


ENRICHED = f"""
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY greatest(COALESCE(a_updated_at, TIMESTAMP '{LONG_AGO}'),
  COALESCE(b_updated_at, TIMESTAMP '{LONG_AGO}')) DESC, row_id) AS rn FROM feature_wide) WHERE rn = 1),
enriched AS (SELECT e.*, e.status = 'ACTIVE' AS is_active, COALESCE(e.sync_key <> 'XXXXXXXXXXXXXXX', FALSE) AS has_valid_key,
  COALESCE(n.a_enabled, FALSE) AS a_enabled, COALESCE(n.b_enabled, FALSE) AS b_enabled, n.a_updated_at, n.b_updated_at, p.name AS company_name
  FROM entity e LEFT JOIN newest n ON n.entity_id = e.id LEFT JOIN parent p ON p.id = e.parent_id AND NOT p.is_deleted
  WHERE e.parent_id IS NOT NULL AND e.status <> 'DELETED')
"""
AGGREGATED = ENRICHED + """,
valid AS (SELECT * FROM enriched WHERE is_active AND has_valid_key),
grouped AS (SELECT sync_key, count(*) AS active_count, count(DISTINCT id) AS unique_count, max(updated_at) AS last_updated_at, bool_or(a_enabled) AS a_enabled,
  bool_or(b_enabled) AS b_enabled, min(a_updated_at) AS a_enabled_at, min(b_updated_at) AS b_enabled_at FROM valid GROUP BY sync_key),
rep AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sync_key ORDER BY updated_at DESC NULLS LAST, id DESC) AS rn FROM valid) WHERE rn = 1),
agg AS (SELECT g.*, r.id, r.name, r.segment, r.inserted_at, r.company_name, CAST(g.a_enabled AS INT) + CAST(g.b_enabled AS INT) AS total_flag_count,
  g.active_count > 1 AS is_multi, g.a_enabled OR g.b_enabled AS has_any_flag FROM grouped g JOIN rep r ON r.sync_key = g.sync_key)
"""
LIVE = """,
live AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sync_key ORDER BY last_modified DESC NULLS LAST, target_id) AS rn FROM target
  WHERE NOT is_deleted AND sync_key IS NOT NULL) WHERE rn = 1)
"""
COLUMNS = ["sync_key", "id", "name", "segment", "company_name", "a_enabled", "b_enabled", "a_enabled_at", "b_enabled_at", "last_updated_at",
           "active_count", "unique_count", "total_flag_count", "is_multi", "has_any_flag"]
LIST = ", ".join(COLUMNS)


@query("a1_aggregate_many_to_one", f"WITH {AGGREGATED} SELECT {LIST} FROM agg")
def a1(i):
    return aggregated(i).select(*COLUMNS)


@query("a1_member_lists", """
SELECT parent_id, CAST(floor(id / 100) AS BIGINT) AS chunk, string_agg(CAST(id AS STRING), ',' ORDER BY id) AS ids, CAST(count(*) AS INT) AS ids_count
FROM entity WHERE status = 'ACTIVE' GROUP BY 1, 2
""")
def a1_members(i):
    return chunked_list(i.entity.filter("status = 'ACTIVE'"), ["parent_id"], "id", 100, "ids")


@query("a1_text_member_lists", """
WITH m AS (SELECT DISTINCT CASE WHEN parent_id % 3 = 0 THEN NULL ELSE parent_id END AS parent_id, name AS member FROM entity),
n AS (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY member) - 1 AS place FROM m WHERE member IS NOT NULL)
SELECT parent_id, CAST(place // 40 AS BIGINT) AS piece, string_agg(member, ';' ORDER BY member) AS ids, CAST(count(*) AS INT) AS ids_count FROM n GROUP BY 1, 2
""")
def a1_text_members(i):
    """A third of all members under one key, which is null; ranges of 200 rows."""
    rows = i.entity.select(F.when(F.col("parent_id") % 3 != 0, F.col("parent_id")).alias("parent_id"), F.col("name").alias("member"))
    return member_lists(rows, ["parent_id"], "member", 40, "ids", ";", rows=200)


@query("a2_pivot_flags", """
SELECT entity_id, """ + ", ".join(f"bool_or(code = '{c}' AND state = 'enabled') AS {n}" for c, n in CODES.items()) + """
FROM feature_log GROUP BY entity_id
""")
def a2(i):
    return R.pivot_flags(i.feature_log, "entity_id", "code", F.col("state") == "enabled", CODES)


@query("j1_star_left_chain", """
SELECT DISTINCT o.o_orderkey, l.l_returnflag, c.c_name, n.n_name, r.r_name, p.p_brand, s.s_name FROM orders o
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN events e ON e.user_id = c.c_custkey
""")
def j1(i):
    edges = [
        R.Edge(i.lineitem, ["o_orderkey"], ["l_orderkey"]), R.Edge(i.customer, ["o_custkey"], ["c_custkey"]),
        R.Edge(i.nation, ["c_nationkey"], ["n_nationkey"]), R.Edge(i.region, ["n_regionkey"], ["r_regionkey"]),
        R.Edge(i.part, ["l_partkey"], ["p_partkey"]), R.Edge(i.supplier, ["l_suppkey"], ["s_suppkey"]),
        R.Edge(i.events, ["c_custkey"], ["user_id"]),
    ]
    return R.star_left_chain(i.orders, edges, ["o_orderkey", "l_returnflag", "c_name", "n_name", "r_name", "p_brand", "s_name"])


@query("j2_enrich_latest", f"""
WITH {ENRICHED} SELECT id, sync_key, status, is_active, has_valid_key, a_enabled, b_enabled, a_updated_at, b_updated_at, company_name FROM enriched
""")
def j2(i):
    return enriched(i).select(
        "id", "sync_key", "status", "is_active", "has_valid_key", "a_enabled", "b_enabled", "a_updated_at", "b_updated_at", "company_name"
    )


@query("j3_create_queue", f"""
WITH {AGGREGATED} SELECT {LIST} FROM agg WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.sync_key = agg.sync_key AND NOT t.is_deleted)
""")
def j3(i):
    return sync.to_create(aggregated(i), i.target, SPEC).select(*COLUMNS)


@query("j4_update_queue", f"WITH {AGGREGATED} {LIVE} SELECT {', '.join('agg.' + c for c in COLUMNS)}, live.target_id FROM agg JOIN live ON live.sync_key = agg.sync_key")
def j4(i):
    return sync.to_update(aggregated(i), i.target, SPEC).select(*COLUMNS, "target_id")


@query("c2_sync_update_queue", f"""
WITH {AGGREGATED} {LIVE} SELECT agg.sync_key, agg.id, agg.name, live.target_id, agg.total_flag_count, agg.active_count, agg.last_updated_at
FROM agg JOIN live ON live.sync_key = agg.sync_key WHERE agg.has_any_flag
""")
def c2(i):
    out = sync.to_update(aggregated(i), i.target, SPEC).filter("has_any_flag")
    return out.select("sync_key", "id", "name", "target_id", "total_flag_count", "active_count", "last_updated_at")


@query("c2_sync_mismatches", f"""
WITH {AGGREGATED} SELECT t.target_id, t.sync_key, t.a_enabled, t.b_enabled, COALESCE(agg.a_enabled, FALSE) AS source_a_enabled,
  COALESCE(agg.b_enabled, FALSE) AS source_b_enabled FROM target t LEFT JOIN agg ON agg.sync_key = t.sync_key
WHERE NOT t.is_deleted AND (t.a_enabled IS DISTINCT FROM COALESCE(agg.a_enabled, FALSE) OR t.b_enabled IS DISTINCT FROM COALESCE(agg.b_enabled, FALSE))
""")
def c2_fix(i):
    out = sync.to_fix(aggregated(i), i.target, SPEC, {"a_enabled": "a_enabled", "b_enabled": "b_enabled"})
    return out.select("target_id", "sync_key", "a_enabled", "b_enabled", "source_a_enabled", "source_b_enabled")


@query("j5_missing_in_target", """
SELECT id, name, sync_key FROM entity e WHERE status = 'ACTIVE' AND sync_key IS NOT NULL AND trim(sync_key) <> ''
  AND NOT EXISTS (SELECT 1 FROM target t WHERE t.source_id = e.id)
""")
def j5(i):
    live = (F.col("status") == "ACTIVE") & R.has_text("sync_key")
    return R.missing_in_target(i.entity, i.target, "id", "source_id", live).select("id", "name", "sync_key")


@query("j6_gap_profile", """
WITH gap AS (SELECT * FROM entity e WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.source_id = e.id)),
months AS (SELECT 'month' AS profile, strftime(inserted_at, '%Y-%m') AS bucket, count(*) AS row_count FROM gap WHERE inserted_at IS NOT NULL GROUP BY 2 ORDER BY 2 DESC LIMIT 12)
SELECT 'status' AS profile, status AS bucket, count(*) AS row_count FROM gap GROUP BY 2
UNION ALL SELECT 'has_key', CASE WHEN sync_key IS NOT NULL AND trim(sync_key) <> '' THEN 'true' ELSE 'false' END, count(*) FROM gap GROUP BY 2
UNION ALL SELECT * FROM months
""")
def j6(i):
    return R.gap_profile(R.missing_in_target(i.entity, i.target, "id", "source_id"), "status", "inserted_at", "sync_key", 12)


WIDE = """
w AS (SELECT entity_id, bool_or(code = '1-URGENT' AND state = 'enabled') AS urgent, bool_or(code = '5-LOW' AND state = 'enabled') AS low FROM feature_log GROUP BY entity_id),
d AS (SELECT t.target_id, t.source_id, t.a_enabled, t.b_enabled, t.last_modified, COALESCE(w.urgent, FALSE) AS source_a_enabled, COALESCE(w.low, FALSE) AS source_b_enabled
  FROM target t LEFT JOIN w ON w.entity_id = t.source_id)
"""
PAIRS = {"a_enabled": "urgent", "b_enabled": "low"}
SHOWN = ["target_id", "a_enabled", "b_enabled", "source_a_enabled", "source_b_enabled"]


def wide(i):
    return R.pivot_flags(i.feature_log, "entity_id", "code", F.col("state") == "enabled", {"1-URGENT": "urgent", "5-LOW": "low"})


@query("j7_flag_mismatch", f"""
WITH {WIDE} SELECT {', '.join(SHOWN)} FROM d WHERE a_enabled IS DISTINCT FROM source_a_enabled OR b_enabled IS DISTINCT FROM source_b_enabled
""")
def j7(i):
    return R.flag_mismatch(wide(i), i.target, "entity_id", "source_id", PAIRS).select(*SHOWN)


@query("j7_flag_mismatch_plain", f"""
WITH {WIDE} SELECT {', '.join(SHOWN)} FROM d WHERE (a_enabled <> source_a_enabled OR b_enabled <> source_b_enabled)
  AND last_modified >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 90 DAYS
""")
def j7_plain(i):
    recent = F.col("last_modified") >= F.lit("2001-08-02 00:00:00").cast("timestamp_ntz") - F.expr("INTERVAL 90 DAYS")
    return R.flag_mismatch(wide(i), i.target, "entity_id", "source_id", PAIRS, null_safe=False, condition=recent).select(*SHOWN)


@query("j7_flag_backfill", f"WITH {WIDE} SELECT {', '.join(SHOWN)} FROM d WHERE last_modified >= TIMESTAMP '2001-07-01 00:00:00'")
def j7_backfill(i):
    day = F.col("last_modified") >= F.lit("2001-07-01 00:00:00").cast("timestamp_ntz")
    return R.flag_sync_rows(wide(i), i.target, "entity_id", "source_id", PAIRS, day).select(*SHOWN)


def environments(i):
    a = i.entity.filter("segment <> 'MACHINERY'").select("id", "name", "units", "status")
    b = i.target.filter("NOT is_deleted").select(
        F.col("source_id").alias("id"), F.col("target_name").alias("name"), F.when(F.col("b_enabled"), 99).otherwise(F.lit(5)).alias("units"), F.lit("ACTIVE").alias("status")
    )
    more = i.entity.filter("segment = 'MACHINERY' AND units > 12").select("id", "name", "units", "status")
    return a, b.unionByName(more)


COMPARE = """
a AS (SELECT id, name, units, status FROM entity WHERE segment <> 'MACHINERY'),
b AS (SELECT source_id AS id, target_name AS name, CASE WHEN b_enabled THEN 99 ELSE 5 END AS units, 'ACTIVE' AS status FROM target WHERE NOT is_deleted
  UNION ALL SELECT id, name, units, status FROM entity WHERE segment = 'MACHINERY' AND units > 12),
j AS (SELECT a.id AS ka, b.id AS kb, COALESCE(a.id, b.id) AS id, CASE WHEN a.id IS NOT NULL AND b.id IS NOT NULL THEN 'BOTH' WHEN a.id IS NOT NULL THEN 'A_ONLY' ELSE 'B_ONLY' END AS data_source,
  a.name AS a_name, b.name AS b_name, a.units AS a_units, b.units AS b_units, a.status AS a_status, b.status AS b_status,
  CASE WHEN a.name <> b.name THEN 'MISMATCH' ELSE 'MATCH' END AS name_status, CASE WHEN a.units <> b.units THEN 'MISMATCH' ELSE 'MATCH' END AS units_status,
  CASE WHEN a.status <> b.status THEN 'MISMATCH' ELSE 'MATCH' END AS status_status FROM a FULL OUTER JOIN b ON a.id = b.id)
"""


@query("j8_env_compare", f"""
WITH {COMPARE} SELECT id, data_source, a_name, b_name, a_units, b_units, a_status, b_status, name_status, units_status, status_status,
  CASE WHEN kb IS NULL THEN 1 WHEN ka IS NULL THEN 2 WHEN name_status = 'MISMATCH' THEN 3 WHEN units_status = 'MISMATCH' THEN 4 WHEN status_status = 'MISMATCH' THEN 5 ELSE 6 END AS sort_order FROM j
""")
def j8(i):
    return R.env_compare(*environments(i), "id", ["name", "units", "status"])


@query("j9_env_compare_metrics", f"""
WITH {COMPARE} SELECT 'Total in A' AS metric, count(*) AS row_count FROM a UNION ALL SELECT 'Total in B', count(*) FROM b
UNION ALL SELECT 'In both', count(*) FROM j WHERE data_source = 'BOTH' UNION ALL SELECT 'Only in A', count(*) FROM j WHERE data_source = 'A_ONLY'
UNION ALL SELECT 'Only in B', count(*) FROM j WHERE data_source = 'B_ONLY' UNION ALL SELECT 'Mismatch name', count(*) FROM j WHERE name_status = 'MISMATCH'
UNION ALL SELECT 'Mismatch units', count(*) FROM j WHERE units_status = 'MISMATCH' UNION ALL SELECT 'Mismatch status', count(*) FROM j WHERE status_status = 'MISMATCH'
""")
def j9(i):
    columns = ["name", "units", "status"]
    return R.env_compare_metrics(R.env_compare(*environments(i), "id", columns), columns)


# Both environments hold keys many times, and rows without a key.
COPIES = """
a AS (SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey END AS id, l_returnflag AS status, l_linenumber AS units FROM lineitem WHERE l_orderkey % 5 > 0),
b AS (SELECT CASE WHEN l_linenumber > 1 THEN l_orderkey END AS id, l_returnflag AS status, l_linenumber % 2 + 1 AS units FROM lineitem WHERE l_orderkey % 7 > 0),
j AS (SELECT a.id AS ka, b.id AS kb, a.status <> b.status AS status_differs, a.units <> b.units AS units_differ FROM (SELECT * FROM a WHERE id IS NOT NULL) a
  FULL OUTER JOIN (SELECT * FROM b WHERE id IS NOT NULL) b ON a.id = b.id)
"""


def copies(i):
    a = i.lineitem.filter("l_orderkey % 5 > 0").selectExpr("CASE WHEN l_linenumber < 7 THEN l_orderkey END AS id", "l_returnflag AS status", "l_linenumber AS units")
    b = i.lineitem.filter("l_orderkey % 7 > 0").selectExpr("CASE WHEN l_linenumber > 1 THEN l_orderkey END AS id", "l_returnflag AS status", "l_linenumber % 2 + 1 AS units")
    return a, b


@query("j9_metrics_of_copies", f"""
WITH {COPIES} SELECT 'Total in A' AS metric, count(DISTINCT ka) AS row_count FROM j UNION ALL SELECT 'Total in B', count(DISTINCT kb) FROM j
UNION ALL SELECT 'In both', count(DISTINCT ka) FROM j WHERE kb IS NOT NULL UNION ALL SELECT 'Only in A', count(DISTINCT ka) FROM j WHERE kb IS NULL
UNION ALL SELECT 'Only in B', count(DISTINCT kb) FROM j WHERE ka IS NULL UNION ALL SELECT 'Mismatch status', count(DISTINCT ka) FROM j WHERE status_differs
UNION ALL SELECT 'Mismatch units', count(DISTINCT ka) FROM j WHERE units_differ
""")
def j9_copies(i):
    return R.env_compare_metrics(R.env_compare(*copies(i), "id", ["status", "units"]), ["status", "units"])


@query("j8_repeated_keys", f"""
WITH {COPIES} SELECT id, sum(na) AS a_rows, sum(nb) AS b_rows FROM (SELECT id, 1 AS na, 0 AS nb FROM a UNION ALL SELECT id, 0, 1 FROM b) u
GROUP BY id HAVING id IS NULL OR sum(na) > 1 OR sum(nb) > 1
""")
def j8_repeated(i):
    return R.repeated_keys(*copies(i), "id")


@query("j10_env_mismatch_detail", f"""
WITH {COMPARE} SELECT id, concat_ws('; ', CASE WHEN name_status = 'MISMATCH' THEN 'name: ' || a_name || ' -> ' || b_name END,
  CASE WHEN units_status = 'MISMATCH' THEN 'units: ' || CAST(a_units AS STRING) || ' -> ' || CAST(b_units AS STRING) END,
  CASE WHEN status_status = 'MISMATCH' THEN 'status: ' || a_status || ' -> ' || b_status END) AS differences
FROM j WHERE data_source = 'BOTH' AND (name_status = 'MISMATCH' OR units_status = 'MISMATCH' OR status_status = 'MISMATCH')
""")
def j10(i):
    columns = ["name", "units", "status"]
    return R.env_mismatch_detail(R.env_compare(*environments(i), "id", columns), "id", columns)


@query("j13_partner_flag", """
SELECT i.id, CAST(EXISTS (SELECT 1 FROM supplier s WHERE 'Brand#' || CAST(s.s_nationkey AS STRING) = i.brand AND s.s_acctbal > 5000 AND s.s_name NOT LIKE '%7%') AS INT) AS api_flag,
  CAST(EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = i.id AND l.l_returnflag = 'R') AS INT) AS integration_flag FROM item i
""")
def j13(i):
    credentials = i.supplier.withColumn("owner", F.concat(F.lit("Brand#"), F.col("s_nationkey").cast("string")))
    allowed = (F.col("s_acctbal") > 5000) & ~F.col("s_name").like("%7%")
    returned = i.lineitem.filter("l_returnflag = 'R'")
    return R.partner_flag(i.item, "brand", credentials, "owner", allowed, returned, ("id", "l_partkey")).select("id", "api_flag", "integration_flag")


ORPHANS = """
child AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice < 100000 THEN '' WHEN o_totalprice > 480000 THEN NULL ELSE CAST(o_custkey AS STRING) END AS parent_key FROM orders),
par AS (SELECT CAST(c_custkey AS STRING) AS c_key FROM customer WHERE c_mktsegment <> 'MACHINERY'),
orph AS (SELECT o_orderkey, parent_key, CASE WHEN parent_key IS NULL OR trim(parent_key) = '' THEN 'missing key' ELSE 'no parent' END AS reason FROM child
  WHERE parent_key IS NULL OR trim(parent_key) = '' OR parent_key NOT IN (SELECT c_key FROM par))
"""


def orphans(i):
    key = F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_totalprice") < 100000), "").when(F.col("o_totalprice") <= 480000, F.col("o_custkey").cast("string"))
    child = i.orders.select("o_orderkey", key.alias("parent_key"))
    parent = i.customer.filter("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").cast("string").alias("c_key"))
    return R.orphan_check(child, parent, "parent_key", "c_key"), child


@query("j26_orphan_check", f"WITH {ORPHANS} SELECT o_orderkey, parent_key, reason FROM orph")
def j26(i):
    return orphans(i)[0]


@query("j26_orphan_counts", f"""
WITH {ORPHANS} SELECT (SELECT count(*) FROM child) AS total_rows, (SELECT count(*) FROM orph) AS orphan_rows, (SELECT count(*) FROM child) - (SELECT count(*) FROM orph) AS linked_rows
""")
def j26_counts(i):
    return R.orphan_counts(*orphans(i))


@query("j27_key_in_other_system", """
WITH missing AS (SELECT * FROM entity e WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.source_id = e.id AND t.b_enabled)),
other AS (SELECT sync_key AS other_key, min(CASE WHEN target_name IS NULL THEN '' WHEN is_deleted THEN NULL ELSE CAST(source_id AS STRING) END) AS back FROM target
  WHERE sync_key IS NOT NULL GROUP BY sync_key)
SELECT m.id, m.sync_key, CASE WHEN o.other_key IS NULL THEN 'KEY NOT FOUND' WHEN o.back IS NULL OR o.back = '' THEN 'BACK REFERENCE EMPTY'
  WHEN o.back = CAST(m.id AS STRING) THEN 'MATCHES' ELSE 'MISMATCH' END AS match_status
FROM missing m LEFT JOIN other o ON o.other_key = m.sync_key WHERE m.sync_key IS NOT NULL AND trim(m.sync_key) <> ''
""")
def j27(i):
    back = F.when(F.col("target_name").isNull(), "").when(~F.col("is_deleted"), F.col("source_id").cast("string"))
    other = i.target.filter("sync_key IS NOT NULL").groupBy(F.col("sync_key").alias("other_key")).agg(F.min(back).alias("back"))
    missing = R.missing_in_target(i.entity, i.target.filter("b_enabled"), "id", "source_id")
    return R.key_in_other_system(missing, other, "sync_key", "other_key", "id", "back").select("id", "sync_key", "match_status")


@query("j29_has_sibling", """
SELECT id, sync_key, group_size FROM (SELECT id, sync_key, count(*) OVER (PARTITION BY sync_key) AS group_size FROM entity WHERE sync_key IS NOT NULL) WHERE group_size > 1
""")
def j29(i):
    return R.has_sibling(i.entity.select("id", "sync_key"), ["sync_key"])


@query("j30_method_overlap", """
WITH a AS (SELECT DISTINCT user_id AS id FROM events WHERE event_type = 'error' AND value > 60), b AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_totalprice > 300000)
SELECT CASE WHEN b.id IS NULL THEN 'errors only' WHEN a.id IS NULL THEN 'orders only' ELSE 'both' END AS found_in, count(*) AS ids FROM a FULL OUTER JOIN b ON a.id = b.id GROUP BY 1
""")
def j30(i):
    a = i.events.filter("event_type = 'error' AND value > 60").select(F.col("user_id").alias("id"))
    b = i.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("id"))
    return R.method_overlap(a, b, "id", "errors", "orders")


UNSEEN = """
WITH items AS (SELECT DISTINCT o_orderpriority AS name FROM orders WHERE o_orderstatus = 'O'),
seen AS (SELECT DISTINCT o_custkey, o_orderpriority AS name FROM orders WHERE o_orderpriority IN (SELECT name FROM items))
"""


def unseen(i, operator):
    items = i.orders.select(F.col("o_orderpriority").alias("name"), "o_orderstatus")
    users = i.customer.select(F.col("c_custkey").alias("o_custkey"))
    return operator(items, "name", F.col("o_orderstatus") == "O", i.orders, "o_custkey", "o_orderpriority", users)


@query("j35_not_yet_exposed", UNSEEN + """
SELECT c_custkey AS o_custkey, (SELECT count(*) FROM items) AS active_items, (SELECT count(*) FROM items) - count(name) AS unseen_items
FROM customer LEFT JOIN seen ON c_custkey = o_custkey GROUP BY c_custkey
""")
def j35(i):
    """Every customer, also those who never ordered."""
    return unseen(i, R.not_yet_exposed)


@query("j35_unexposed_users", UNSEEN + """
SELECT i.name, (SELECT count(*) FROM customer) AS all_users, (SELECT count(*) FROM customer) - count(c_custkey) AS unexposed_users
FROM items i LEFT JOIN (SELECT * FROM seen JOIN customer ON c_custkey = o_custkey) s ON s.name = i.name GROUP BY i.name
""")
def j35_items(i):
    return unseen(i, R.unexposed_users)


@query("j35_not_exposed_to_one", """
SELECT p_partkey, p_brand FROM part WHERE p_type <> 'PROMO' AND p_brand NOT IN (SELECT p.p_brand FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey
  JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE o.o_custkey = 5)
""")
def j35_one(i):
    shown = i.orders.join(i.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).join(i.part, F.col("l_partkey") == F.col("p_partkey"))
    shown = shown.select("o_custkey", F.col("p_brand").alias("seen"))
    out = R.not_exposed_to(i.part, "p_brand", F.col("p_type") != "PROMO", shown, "o_custkey", "seen", 5)
    return out.select("p_partkey", "p_brand")


STAGED = """
staged AS (SELECT log_id, entity_id, CASE WHEN state = 'pending' THEN 'odd' ELSE state END AS state, changed_at, code FROM feature_log WHERE code <> '3-MEDIUM'),
goal AS (SELECT log_id, entity_id, state, changed_at, code FROM feature_log WHERE state = 'enabled')
"""


def staged(i):
    rows = i.feature_log.filter("code <> '3-MEDIUM'").withColumn("state", F.when(F.col("state") == "pending", "odd").otherwise(F.col("state")))
    columns = ["log_id", "entity_id", "state", "changed_at", "code"]
    return rows.select(*columns), i.feature_log.filter("state = 'enabled'").select(*columns)


@query("j36_staged_checks", f"""
WITH {STAGED} SELECT 'duplicate' AS finding, CAST(entity_id AS STRING) || '/' || code || '/' || state AS detail, count(*) AS row_count FROM staged GROUP BY entity_id, code, state HAVING count(*) > 1
UNION ALL SELECT 'invalid value', state, count(*) FROM staged WHERE state NOT IN ('enabled', 'disabled') GROUP BY state
""")
def j36(i):
    return R.staged_checks(staged(i)[0], ["entity_id", "code", "state"], "state", ["enabled", "disabled"])


@query("j36_insert_missing", f"""
WITH {STAGED} SELECT * FROM goal UNION ALL SELECT * FROM staged WHERE log_id NOT IN (SELECT log_id FROM goal)
""")
def j36_insert(i):
    return R.insert_missing(*staged(i), "log_id")[0]


@query("j37_value_drift", """
SELECT a.event_id, CAST(json_extract_string(a.props, '$.k') AS DECIMAL(18,2)) AS original_value, CAST(a.value AS DECIMAL(18,2)) AS recomputed_value,
  CAST(a.value AS DECIMAL(18,2)) - CAST(json_extract_string(a.props, '$.k') AS DECIMAL(18,2)) AS difference
FROM events a WHERE abs(CAST(a.value AS DECIMAL(18,2)) - CAST(json_extract_string(a.props, '$.k') AS DECIMAL(18,2))) > 50
""")
def j37(i):
    return R.value_drift(i.events, i.events, "event_id", "props", "$.k", "value", 50)


@query("j38_effective_access", """
WITH ef AS (SELECT c_custkey AS entity_id, code, state FROM (SELECT c.c_custkey, f.code, max(f.state) AS state FROM customer c JOIN feature_log f ON f.entity_id = c.c_custkey GROUP BY 1, 2)),
uf AS (SELECT user_id AS entity_id, '1-URGENT' AS code, CASE WHEN max(value) > 150 THEN 'enabled' ELSE 'disabled' END AS state FROM events GROUP BY user_id)
SELECT ef.entity_id, ef.code, ef.state, uf.state AS user_state, ef.state = 'enabled' AND (uf.state IS NULL OR uf.state = 'enabled') AS available
FROM ef LEFT JOIN uf ON uf.entity_id = ef.entity_id AND uf.code = ef.code
""")
def j38(i):
    flags = i.feature_log.groupBy("entity_id", "code").agg(F.max("state").alias("state"))
    users = i.events.groupBy(F.col("user_id").alias("entity_id")).agg(F.max("value").alias("top")).select(
        "entity_id", F.lit("1-URGENT").alias("code"), F.when(F.col("top") > 150, "enabled").otherwise("disabled").alias("state")
    )
    return R.effective_access(flags, users, "code", "state", "state", ["entity_id"])
