"""R1-R5. Streams read files that Spark writes from the given tables into a fresh folder."""

from pyspark.sql import functions as F

from bindings.base import query
from crosswalk.session import scratch_dir
from crosswalk.streaming import changes as S

CURRENT = """
cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY _commit_version DESC) AS rn FROM change_feed) WHERE rn = 1)
"""


@query("r1_stream_bronze", """
SELECT 'feed' AS _source_table, _change_type, count(*) AS row_count FROM change_feed GROUP BY _change_type UNION ALL SELECT 'orders', o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus
""")
def r1(i):
    base = scratch_dir(i.spark, "bronze")
    tables = {"feed": i.change_feed, "orders": i.orders}
    for name, df in tables.items():
        df.repartition(4).write.parquet(f"{base}/in/{name}")
    S.run_all(S.stream_bronze(i.spark, {n: d.schema for n, d in tables.items()}, f"{base}/in", f"{base}/out", f"{base}/checkpoint", 2))
    feed = i.spark.read.parquet(f"{base}/out/feed").groupBy("_source_table", "_change_type").agg(F.count(F.lit(1)).alias("row_count"))
    orders = i.spark.read.parquet(f"{base}/out/orders").groupBy("_source_table", F.col("o_orderstatus").alias("_change_type")).agg(F.count(F.lit(1)).alias("row_count"))
    return feed.unionByName(orders)


@query("r2_apply_changes", f"WITH {CURRENT} SELECT id, status, amount, _commit_version FROM cur WHERE _change_type <> 'delete'")
def r2(i):
    return S.apply_changes(i.change_feed, ["id"], ["_commit_version"]).select("id", "status", "amount", "_commit_version")


@query("r2_apply_changes_soft", f"WITH {CURRENT} SELECT id, status, _change_type = 'delete' AS is_deleted FROM cur")
def r2_soft(i):
    return S.apply_changes(i.change_feed, ["id"], ["_commit_version"], keep_deleted=True).select("id", "status", "is_deleted")


@query("r2_stream_snapshot", f"WITH {CURRENT} SELECT id, status, amount, _commit_version FROM cur WHERE _change_type <> 'delete'")
def r2_stream(i):
    base, feed = scratch_dir(i.spark, "changes"), i.change_feed
    feed.repartition(3, "status").write.parquet(f"{base}/in")  # the versions of a key are spread over the files
    stream = i.spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    S.stream_snapshot(stream, ["id"], ["_commit_version"], f"{base}/snapshot", f"{base}/checkpoint", 2).awaitTermination()
    return S.read_snapshot(i.spark, f"{base}/snapshot", feed.schema, ["id"], ["_commit_version"]).select("id", "status", "amount", "_commit_version")


COUNTS = "SELECT CAST(CAST(ts AS DATE) AS STRING) AS day, event_type, count(*) AS row_count FROM events GROUP BY 1, 2"


@query("r3_live_status_counts", COUNTS)
def r3(i):
    return S.live_status_counts(i.events, "ts", "event_type")


@query("r3_live_status_counts_stream", COUNTS)
def r3_stream(i):
    base = scratch_dir(i.spark, "live")
    i.events.repartition(3).write.parquet(f"{base}/in")
    stream = i.spark.readStream.schema(i.events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    S.stream_live_counts(stream, "ts", "event_type", f"{base}/counts", f"{base}/checkpoint", "40 days", 2).awaitTermination()
    return S.read_live_counts(i.spark, f"{base}/counts", "event_type")


@query("r3_day_totals", """
SELECT CAST(CAST(ts AS DATE) AS STRING) AS day, count(*) FILTER (WHERE event_type = 'signup') AS created, count(*) FILTER (WHERE event_type = 'purchase') AS updated, count(*) AS total FROM events GROUP BY 1
""")
def r3_totals(i):
    return S.day_totals(S.live_status_counts(i.events, "ts", "event_type"), "event_type", "signup", "purchase")


@query("r4_completion_progress", """
WITH a AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'F'), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R')
SELECT (SELECT count(*) FROM a) AS total, (SELECT count(*) FROM a WHERE k IN (SELECT k FROM b)) AS completed, (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) AS remaining,
  (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS orphans, round(100.0::DOUBLE * (SELECT count(*) FROM a WHERE k IN (SELECT k FROM b)) / (SELECT count(*) FROM a), 2) AS completed_pct
""")
def r4(i):
    return S.completion_progress(i.orders.filter("o_orderstatus <> 'F'"), i.lineitem.filter("l_returnflag = 'R'"), "o_orderkey", "l_orderkey")


@query("r5_soft_delete_report", "SELECT _change_type = 'delete' AS is_deleted, count(*) AS row_count, min(_change_timestamp) AS first_sync, max(_change_timestamp) AS last_sync FROM change_feed GROUP BY 1")
def r5(i):
    return S.soft_delete_report(i.change_feed.withColumn("is_deleted", F.col("_change_type") == "delete"), "is_deleted", "_change_timestamp")


@query("r5_deletions_per_day", "SELECT CAST(CAST(_change_timestamp AS DATE) AS STRING) AS day, count(*) AS deleted_rows FROM change_feed WHERE _change_type = 'delete' GROUP BY 1")
def r5_days(i):
    return S.deletions_per_day(i.change_feed.withColumn("is_deleted", F.col("_change_type") == "delete"), "is_deleted", "_change_timestamp")


@query("r5_active_only", "SELECT target_id, sync_key FROM target WHERE NOT is_deleted")
def r5_active(i):
    return S.active_only(i.target, "is_deleted").select("target_id", "sync_key")


@query("r2_both_images", """
SELECT event_id % 97 AS id, max(event_id) AS version, arg_max(value, event_id) + 1 AS value FROM events GROUP BY event_id % 97
HAVING max(event_id) % 5 > 0 OR arg_max(value, event_id) > 20
""")
def r2_images(i):
    """Each change comes with the row before and after it in one version; every fifth one is a delete, which a row in
    the same version replaces if its value is large."""
    rows = i.events.selectExpr("event_id % 97 AS id", "event_id AS version", "value")
    kinds = {"update_preimage": rows, "update_postimage": rows.filter("version % 5 > 0 OR value > 20").withColumn("value", F.col("value") + 1), "delete": rows.filter("version % 5 = 0")}
    parts = [r.withColumn("_change_type", F.lit(k)) for k, r in kinds.items()]
    feed = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return S.apply_changes(feed, ["id"], ["version"]).drop("_change_type")
