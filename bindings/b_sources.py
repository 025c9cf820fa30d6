"""Reading, staging and writing."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from bindings.base import AS_OF_ORDERS, query
from crosswalk.functions.columns import count_if
from crosswalk.session import scratch_dir
from crosswalk.sources import sinks, tables


@query("s1_read_table", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000")
def s1(i):
    orders = tables.read_table(i.spark, i.folder, "orders")
    return orders.filter("o_orderstatus = 'P' AND o_totalprice > 400000").select("o_orderkey", "o_totalprice")


@query("s2_read_csv_clean", """
SELECT DISTINCT trim(sync_key) AS sync_key, status, name FROM entity WHERE trim(sync_key) <> ''
""")
def s2(i):
    path = scratch_dir(i.spark, "csv")
    i.entity.select(
        F.col("status").alias(" Status "), F.col("name").alias("Name"), F.concat(F.lit("  "), "sync_key", F.lit(" ")).alias("Sync Key ")
    ).write.csv(path, header=True)
    schema = StructType([StructField(n, StringType()) for n in (" Status ", "Name", "Sync Key ")])
    return tables.read_csv_clean(
        i.spark, path, schema, "sync_key", {"Status": "status", "Name": "name", "Sync Key": "sync_key"}
    )


@query("s3_lookback_increment", f"""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL 2400 HOURS AND o_orderstatus = 'P'
""")
def s3(i):
    return tables.lookback_increment(
        i.orders, "o_orderdate", 2400, AS_OF_ORDERS, F.col("o_orderstatus") == "P"
    ).select("o_orderkey", "o_orderdate")


@query("s4_stage_pending", f"""
SELECT id, sync_key, status, TIMESTAMP '{AS_OF_ORDERS}' AS processed_at, 'pending' AS sync_status FROM entity WHERE status = 'ACTIVE'
""")
def s4(i):
    rows = i.entity.filter("status = 'ACTIVE'").select("id", "sync_key", "status")
    path = scratch_dir(i.spark, "staging")
    for _ in range(2):  # a repeated run leaves the table as it is
        staged = sinks.stage_pending(rows, path, AS_OF_ORDERS, "run-1")
    return staged


@query("s5_materialise", """
SELECT l_returnflag, l_linestatus, count(*) AS row_count, CAST(sum(l_linenumber) AS BIGINT) AS line_total FROM lineitem GROUP BY ALL
""")
def s5(i):
    rows = i.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", "l_shipdate")
    path = scratch_dir(i.spark, "table")
    sinks.materialise(rows.limit(10), path, run_id="run-0")
    for _ in range(2):
        table = sinks.materialise(rows, path, ["l_shipdate"], "run-1")
    return table.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_linenumber").alias("line_total")
    )


@query("s6_append_audit", f"""
SELECT 'A-' || o_orderstatus AS audit_id, 'orders' AS sync_name, o_orderstatus AS sync_type, TIMESTAMP '{AS_OF_ORDERS}' AS execution_timestamp,
  CAST(count(*) AS INT) AS records_processed, CAST(count(*) FILTER (WHERE o_totalprice > 1000) AS INT) AS records_succeeded,
  CAST(count(*) FILTER (WHERE o_totalprice <= 1000) AS INT) AS records_failed,
  round(100.0::DOUBLE * count(*) FILTER (WHERE o_totalprice <= 1000) / count(*), 2) AS error_rate, 'job' AS executed_by,
  CASE WHEN o_orderstatus = 'P' THEN 'second run' ELSE 'first run' END AS notes
FROM orders GROUP BY o_orderstatus
""")
def s6(i):
    path, good = scratch_dir(i.spark, "audit"), F.col("o_totalprice") > 1000
    rows = i.orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("records_processed"), count_if(good).alias("records_succeeded"), count_if(~good).alias("records_failed")
    )
    rows = rows.select(
        F.concat(F.lit("A-"), "o_orderstatus").alias("audit_id"), F.lit("orders").alias("sync_name"), F.col("o_orderstatus").alias("sync_type"),
        F.lit(AS_OF_ORDERS).alias("execution_timestamp"), "records_processed", "records_succeeded", "records_failed",
        F.round(F.lit(100.0) * F.col("records_failed") / F.col("records_processed"), 2).alias("error_rate"), F.lit("job").alias("executed_by"),
    )
    first, second = F.col("sync_type") != "P", F.col("sync_type") == "P"
    for _ in range(2):  # both runs are repeated
        sinks.append_audit(rows.filter(first).withColumn("notes", F.lit("first run")), path, "run-1")
        log = sinks.append_audit(rows.filter(second).withColumn("notes", F.lit("second run")), path, "run-2")
    return log


@query("s7_batch_numbers", """
WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS record_number FROM orders)
SELECT o_orderkey, record_number, (record_number - 1) // 50 + 1 AS batch FROM n
""")
def s7(i):
    return sinks.number_batches(i.orders.select("o_orderkey"), "o_orderkey", 50)


@query("s7_text_batches", """
WITH n AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS record_number FROM orders)
SELECT o_orderkey, o_orderpriority, record_number, (record_number - 1) // 50 + 1 AS batch FROM n
""")
def s7_text(i):
    """Text order in which five values hold all rows; equal ones are ordered by id, in ranges of 1,000 rows."""
    return sinks.number_batches(i.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", 50, "o_orderkey", rows=1000)


@query("s7_batch_export", """
WITH n AS (SELECT id, row_number() OVER (ORDER BY id) AS record_number FROM entity WHERE status = 'ACTIVE')
SELECT (record_number - 1) // 50 + 1 AS batch, min(record_number) AS first_record, max(record_number) AS last_record, count(*) AS records
FROM n GROUP BY 1
""")
def s7_export(i):
    path = scratch_dir(i.spark, "batches")
    sinks.batch_export(i.entity.filter("status = 'ACTIVE'").select("id", "name", "sync_key"), "id", path, 50)
    written = StructType(
        [StructField("id", LongType()), StructField("name", StringType()), StructField("sync_key", StringType()),
         StructField("record_number", LongType()), StructField("batch", LongType())]
    )
    return sinks.batch_summary(i.spark.read.csv(path, header=True, schema=written))


@query("s8_payload_projection", """
SELECT e.id, e.sync_key AS target_key, e.name AS target_name, p.name AS company_name, TRUE AS trigger_rollups,
  '{' || CASE WHEN e.sync_key IS NULL THEN '' ELSE '"target_key":"' || e.sync_key || '",' END || '"target_name":"' || e.name || '",'
  || CASE WHEN p.name IS NULL THEN '' ELSE '"company_name":"' || p.name || '",' END || '"trigger_rollups":true}' AS payload
FROM entity e LEFT JOIN (SELECT * FROM parent WHERE NOT is_deleted) p ON e.parent_id = p.id
""")
def s8(i):
    return sinks.payload_projection(
        i.entity, {"sync_key": "target_key", "name": "target_name"}, {"trigger_rollups": True},
        i.parent.filter(~F.col("is_deleted")), ("parent_id", "id"), {"name": "company_name"}, keep=["id"],
    )


@query("s9_backup_then_clear", """
SELECT id, CASE WHEN status = 'DISABLED' THEN NULL ELSE sync_key END AS sync_key, status, status = 'DISABLED' AS backed_up FROM entity
""")
def s9(i):
    rows = i.entity.select("id", "sync_key", "status", "updated_at")
    cleared, backup = sinks.backup_then_clear(
        rows, F.col("status") == "DISABLED", "sync_key", ["id", "sync_key", "status", "updated_at"], scratch_dir(i.spark, "backup")
    )
    saved = backup.select("id", F.lit(True).alias("backed_up"))
    return cleared.join(saved, "id", "left").fillna(False, ["backed_up"]).select("id", "sync_key", "status", "backed_up")


@query("s10_restore_from_backup", "SELECT id, sync_key, status FROM entity")
def s10(i):
    rows = i.entity.select("id", "sync_key", "status")
    cleared, backup = sinks.backup_then_clear(
        rows, F.col("status") == "DISABLED", "sync_key", ["id", "sync_key"], scratch_dir(i.spark, "backup")
    )
    return sinks.restore_from_backup(cleared, backup, "id", "sync_key")


@query("s11_archive_expired", f"""
SELECT 'kept' AS part, 'none' AS run_id, count(*) AS row_count, min(o_orderdate) AS oldest, max(o_orderdate) AS newest FROM orders
WHERE NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL 700 DAYS)
UNION ALL
SELECT 'archived', 'run-1', count(*), min(o_orderdate), max(o_orderdate) FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{AS_OF_ORDERS}' - INTERVAL 700 DAYS
""")
def s11(i):
    rows = i.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    kept, archive = sinks.archive_expired(
        rows, "o_orderstatus", ["F"], "o_orderdate", 700, AS_OF_ORDERS, "run-1", scratch_dir(i.spark, "archive")
    )
    left = kept.agg(F.count(F.lit(1)).alias("row_count"), F.min("o_orderdate").alias("oldest"), F.max("o_orderdate").alias("newest"))
    moved = sinks.archive_summary(archive, "o_orderdate").withColumnRenamed("rows_archived", "row_count")
    left = left.withColumn("run_id", F.lit("none")).withColumn("part", F.lit("kept"))
    return left.unionByName(moved.withColumn("part", F.lit("archived")))


@query("f2_prefix_rename_projection", """
SELECT id AS entity_id, name AS entity_name, status AS entity_status, sync_key AS crm_key FROM entity
""")
def f2(i):
    wide = tables.prefix_projection(i.entity, "entity")
    return tables.rename_projection(
        wide, {"entity_id": "entity_id", "entity_name": "entity_name", "entity_status": "entity_status", "entity_sync_key": "crm_key"}
    )
