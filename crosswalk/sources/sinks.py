"""Staged, appended, batched, backed-up and archived tables.

Tables are never overwritten in place: a run writes a folder of its own, and the table's pointer then names it (see
``sources.runs``). A lost executor or a failed job leaves the earlier table whole, and a run that is repeated under its id adds
nothing. Read such tables with ``runs.read_runs``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType, TimestampNTZType

from crosswalk.functions.columns import moment
from crosswalk.functions.scale import number_rows
from crosswalk.sources.runs import write_run

AUDIT_SCHEMA = StructType(
    [
        StructField("audit_id", StringType()),
        StructField("sync_name", StringType()),
        StructField("sync_type", StringType()),
        StructField("execution_timestamp", TimestampNTZType()),
        StructField("records_processed", IntegerType()),
        StructField("records_succeeded", IntegerType()),
        StructField("records_failed", IntegerType()),
        StructField("error_rate", DoubleType()),
        StructField("executed_by", StringType()),
        StructField("notes", StringType()),
    ]
)


def materialise(df: DataFrame, path: str, cluster_by: Sequence[str] = (), run_id: str | None = None) -> DataFrame:
    """Put ``df`` in place of the table and read it back; ``cluster_by`` range-sorts it so that later scans can skip files.

    A row hash ends the range key, so a value held by very many rows is spread over several files.
    """
    out = df
    if cluster_by:
        out = df.repartitionByRange(*cluster_by, F.xxhash64(*df.columns)).sortWithinPartitions(*cluster_by)
    return write_run(out, path, run_id, replace=True)


def stage_pending(df: DataFrame, path: str, as_of: str, run_id: str | None = None) -> DataFrame:
    """Replace the staging table by rows stamped with the processing time and status ``pending``."""
    staged = df.withColumn("processed_at", moment(as_of)).withColumn("sync_status", F.lit("pending"))
    return materialise(staged, path, run_id=run_id)


def append_audit(rows: DataFrame, path: str, run_id: str | None = None) -> DataFrame:
    """Append typed audit rows to the log and return the whole log; a repeated run id appends nothing."""
    typed = rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in AUDIT_SCHEMA])
    return write_run(typed, path, run_id).select(*AUDIT_SCHEMA.names)


def number_batches(df: DataFrame, order_by: str, size: int = 50, tie: str | None = None, rows: int | None = None) -> DataFrame:
    """Global record number in the order of a column of any sortable type, and the batch each record falls in.

    Equal values are ordered by ``tie``, a unique column; it may be left out where ``order_by`` is unique itself.
    """
    out = number_rows(df, order_by, tie or order_by, name="record_number", rows=rows)
    return out.withColumn("batch", F.floor((F.col("record_number") - 1) / F.lit(size)).cast("bigint") + 1)


def batch_summary(batched: DataFrame) -> DataFrame:
    """First and last record number and the row count of each batch."""
    return batched.groupBy("batch").agg(
        F.min("record_number").alias("first_record"),
        F.max("record_number").alias("last_record"),
        F.count(F.lit(1)).alias("records"),
    )


def batch_export(df: DataFrame, order_by: str, path: str, size: int = 50, files_per_task: int = 200, tie: str | None = None) -> DataFrame:
    """Write the batches as CSV, one folder per batch, and return the numbered rows.

    Rows travel by groups of consecutive batches, so a batch is one file and a task opens a bounded number.
    """
    batched = number_batches(df, order_by, size, tie)
    slab = F.floor(F.col("batch") / F.lit(files_per_task))
    batched.withColumn("_slab", slab).repartition("_slab").drop("_slab").sortWithinPartitions(
        "batch", "record_number"
    ).write.mode("overwrite").partitionBy("batch").csv(path, header=True)
    return batched


def payload_projection(
    df: DataFrame,
    mapping: Mapping[str, str],
    constants: Mapping[str, object] | None = None,
    lookup: DataFrame | None = None,
    lookup_key: tuple[str, str] | None = None,
    lookup_columns: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Target fields from source fields, a looked-up parent's fields and constants, plus the JSON payload.

    ``to_json`` leaves out fields that are NULL, as the target expects. The lookup is a plain left join: Spark
    broadcasts it when its size allows and shuffles otherwise.
    """
    cols = [F.col(s).alias(t) for s, t in mapping.items()]
    if lookup is not None:
        left_key, right_key = lookup_key
        names = lookup_columns or {}
        side = lookup.select(F.col(right_key).alias("_key"), *[F.col(s).alias(f"_l_{t}") for s, t in names.items()])
        df = df.join(side, F.col(left_key) == F.col("_key"), "left")
        cols += [F.col(f"_l_{t}").alias(t) for t in names.values()]
    cols += [F.lit(v).alias(k) for k, v in (constants or {}).items()]
    kept = [F.col(k) for k in keep]
    fields = [*mapping.values(), *(lookup_columns or {}).values(), *(constants or {})]
    out = df.select(*kept, F.struct(*cols).alias("_p"))
    return out.select(*keep, *[F.col(f"_p.{f}").alias(f) for f in fields if f not in keep], F.to_json("_p").alias("payload"))


def backup_then_clear(
    df: DataFrame, predicate: Column, key: str, columns: Sequence[str], backup_path: str, run_id: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Snapshot the selected rows, then return (rows with their key set to NULL, the snapshot).

    Repeated under its run id, when the keys may already be cleared, it keeps the first snapshot.
    """
    backup = materialise(df.filter(predicate).select(*columns), backup_path, run_id=run_id)
    hit = F.coalesce(predicate, F.lit(False))
    return df.withColumn(key, F.when(~hit, F.col(key))), backup


def restore_from_backup(df: DataFrame, backup: DataFrame, id_col: str, key: str) -> DataFrame:
    """Put keys back where the current one is NULL and the backup's is not."""
    saved = backup.filter(F.col(key).isNotNull()).select(id_col, F.col(key).alias("_saved"))
    return df.join(saved, id_col, "left").withColumn(key, F.coalesce(key, "_saved")).select(*df.columns)


def archive_expired(
    df: DataFrame, state: str, done: Sequence[str], ts: str, days: int, as_of: str, run_id: str, archive_path: str
) -> tuple[DataFrame, DataFrame]:
    """Move completed rows older than ``days`` to the archive under a run id; return (kept, archive).

    Each run owns one folder of the archive, so running it again replaces its rows instead of adding them twice.
    """
    old = F.col(state).isin(*done) & (F.col(ts) < moment(as_of) - F.expr(f"INTERVAL {days} DAYS"))
    old = F.coalesce(old, F.lit(False))
    moved = df.filter(old).withColumn("archived_at", moment(as_of))
    moved.write.mode("overwrite").parquet(f"{archive_path}/run_id={run_id}")
    schema = StructType([*moved.schema.fields, StructField("run_id", StringType())])
    return df.filter(~old), df.sparkSession.read.schema(schema).parquet(archive_path)


def archive_summary(archive: DataFrame, ts: str) -> DataFrame:
    """Rows and time range per archive run."""
    return archive.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("rows_archived"), F.min(ts).alias("oldest"), F.max(ts).alias("newest")
    )
