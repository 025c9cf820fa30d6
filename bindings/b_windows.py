"""W1-W6, W10, W11, T1-T3, U1-U3."""

from pyspark.sql import functions as F

from bindings.base import query
from crosswalk.functions import columns as C
from crosswalk.functions.scale import latest_per_key
from crosswalk.operators import windows as W


@query("w1_latest_per_key", """
SELECT entity_id, log_id, changed_at, state FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY changed_at DESC NULLS LAST, log_id DESC) AS rn FROM feature_log) WHERE rn = 1
""")
def w1(i):
    out = latest_per_key(i.feature_log, ["entity_id"], [F.col("changed_at").desc_nulls_last(), F.col("log_id").desc()])
    return out.select("entity_id", "log_id", "changed_at", "state")


@query("w2_latest_by_greatest", """
SELECT entity_id, row_id, a_enabled, b_enabled FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY
  greatest(COALESCE(a_updated_at, TIMESTAMP '1900-01-01 00:00:00'), COALESCE(b_updated_at, TIMESTAMP '1900-01-01 00:00:00')) DESC, row_id) AS rn
  FROM feature_wide) WHERE rn = 1
""")
def w2(i):
    out = W.latest_by_greatest(i.feature_wide, ["entity_id"], ["a_updated_at", "b_updated_at"], [F.col("row_id")])
    return out.select("entity_id", "row_id", "a_enabled", "b_enabled")


@query("w3_rank_keep_ties", """
SELECT parent_id, id, units FROM (SELECT *, rank() OVER (PARTITION BY parent_id ORDER BY units DESC) AS r FROM entity) WHERE r = 1
""")
def w3(i):
    return W.rank_keep_ties(i.entity, ["parent_id"], "units").select("parent_id", "id", "units")


@query("w4_running_copy_number", """
SELECT id, CASE WHEN sync_key IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY sync_key ORDER BY segment DESC) END AS copy_number FROM entity
""")
def w4(i):
    return W.running_copy_number(i.entity, ["sync_key"], "segment").select("id", "copy_number")


SERIES = r"""
WITH s AS (SELECT id, status, brand || '/' || regexp_replace(regexp_replace(lower(name), '\bphase\s*([0-9]+|[ivx]+)\b', ''), '[^a-z0-9]', '', 'g') AS base,
  CASE regexp_extract(lower(name), '\bphase\s*([0-9]+|[ivx]+)\b', 1) WHEN 'ii' THEN 2 ELSE TRY_CAST(regexp_extract(lower(name), '\bphase\s*([0-9]+|[ivx]+)\b', 1) AS INT) END AS number
  FROM item WHERE lower(name) LIKE '%phase%'),
g AS (SELECT *, max(number) OVER (PARTITION BY base) AS max_number, count(*) OVER (PARTITION BY base) AS series_size FROM s WHERE base <> ''),
t AS (SELECT id, base, number, max_number, series_size, CASE WHEN number < max_number AND status = 'ACTIVE' THEN 'Old Still Active'
  WHEN number < max_number AND status <> 'ACTIVE' THEN 'Old Inactive' WHEN number = max_number THEN 'Latest' ELSE 'Unknown' END AS series_status
  FROM g WHERE series_size > 1)
"""


def members(i):
    base = F.concat_ws("/", "brand", C.series_base(F.col("name")))
    return i.item.filter(F.lower("name").contains("phase")).select("id", "status", base.alias("base"), C.series_number(F.col("name")).alias("number"))


def series(i):
    return W.series_status(members(i), "base", "number", F.col("status") == "ACTIVE")


@query("w5_series_status", SERIES + "SELECT * FROM t")
def w5(i):
    return series(i).select("id", "base", "number", "max_number", "series_size", "series_status")


@query("w5_series_metrics", SERIES + """
SELECT 'Named in a series' AS metric, count(DISTINCT id) AS row_count FROM s UNION ALL SELECT 'In series of two or more', count(DISTINCT id) FROM t
UNION ALL SELECT 'Old still active', count(DISTINCT id) FROM t WHERE series_status = 'Old Still Active'
UNION ALL SELECT 'Old inactive', count(DISTINCT id) FROM t WHERE series_status = 'Old Inactive'
""")
def w5_metrics(i):
    return W.series_metrics(members(i), series(i), "id")


@query("w5_series_to_drop", SERIES + "SELECT DISTINCT id FROM t WHERE series_status LIKE 'Old%'")
def w5_drop(i):
    return W.series_to_drop(series(i), "id")


@query("w6_percent_of_total", """
SELECT status, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 2) AS percentage FROM checks GROUP BY status
""")
def w6(i):
    return W.percent_of_total(i.checks.groupBy("status").agg(F.count(F.lit(1)).alias("n")), "n")


@query("w10_rank_of", """
WITH r AS (SELECT o_orderkey, o_custkey, o_totalprice, rank() OVER (ORDER BY o_totalprice DESC) AS rank, count(*) OVER () AS total_rows FROM orders)
SELECT o_orderkey, o_totalprice, rank, total_rows FROM r WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def w10(i):
    buyers = i.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    chosen = i.orders.join(buyers, "o_custkey", "left_semi").select("o_orderkey")
    return W.rank_of(i.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", "o_totalprice", chosen)


@query("w11_newest_in_group", """
SELECT id, sync_key, count(*) OVER (PARTITION BY sync_key) AS group_size,
  COALESCE(updated_at = max(updated_at) OVER (PARTITION BY sync_key), FALSE) AS is_newest FROM entity WHERE sync_key IS NOT NULL
""")
def w11(i):
    return W.newest_in_group(i.entity, ["sync_key"], "updated_at").select("id", "sync_key", "group_size", "is_newest")


@query("t1_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def t1(i):
    return W.top_n(i.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 20)


@query("t2_custom_order", """
SELECT status, count(*) AS n, CASE status WHEN 'PASS' THEN 1 WHEN 'FAIL' THEN 2 WHEN 'NEEDS REVIEW' THEN 3 ELSE 4 END AS sort_order
FROM checks GROUP BY status ORDER BY sort_order
""")
def t2(i):
    return W.custom_order(i.checks.groupBy("status").agg(F.count(F.lit(1)).alias("n")), "status", ["PASS", "FAIL", "NEEDS REVIEW"])


@query("t3_sample_rows", "SELECT id, name FROM entity ORDER BY id LIMIT 10")
def t3(i):
    return W.sample_rows(i.entity.select("id", "name"), "id", 10)


@query("u1_union_all", """
SELECT c_custkey AS key, 'customer' AS kind, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, 'supplier', s_nationkey FROM supplier
""")
def u1(i):
    a = i.customer.select(F.col("c_custkey").alias("key"), F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation"))
    b = i.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"))
    return W.union_all([a, b])


@query("u2_union_distinct", """
SELECT l_partkey AS key, 'returned' AS reason FROM lineitem WHERE l_returnflag = 'R' UNION SELECT l_partkey, 'discounted' FROM lineitem WHERE l_discount > 0.08
""")
def u2(i):
    a = i.lineitem.filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("key"), F.lit("returned").alias("reason"))
    b = i.lineitem.filter("l_discount > 0.08").select(F.col("l_partkey").alias("key"), F.lit("discounted").alias("reason"))
    return W.union_distinct([a, b])


@query("u3_difference", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def u3(i):
    used = i.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return W.difference(i.customer.select("c_custkey"), used, ["c_custkey"])


@query("u3_intersection", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def u3_both(i):
    used = i.orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return W.intersection(i.customer.select("c_custkey"), used, ["c_custkey"])
