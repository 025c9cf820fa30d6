"""Bronze streams, current rows from change rows, running counts, progress and deletion reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from crosswalk.functions.columns import count_if, percent
from crosswalk.functions.scale import latest_per_key
from crosswalk.sources.runs import read_pointer, remove_folders, write_pointer

CHANGE_COLUMNS = ("_change_type", "_commit_version", "_change_timestamp")  # fixed values: names in a change feed


def stream_bronze(
    spark: SparkSession, tables: Mapping[str, StructType], in_dir: str, out_dir: str, checkpoint_dir: str, files_per_batch: int | None = None, every: str | None = None
) -> dict[str, StreamingQuery]:
    """One append stream per table: files of ``in_dir/<table>`` to ``out_dir/<table>``, each with its checkpoint.

    The first run is the full load. By default a run reads all files present and stops, and the next one takes only
    new files; with ``every`` (such as ``1 minute``) the streams go on until stopped. The file sink's log makes each
    batch count once even when it is repeated after a failure.
    """
    started = {}
    for name, schema in tables.items():
        reader = spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        rows = reader.parquet(f"{in_dir}/{name}").withColumn("_source_table", F.lit(name))
        started[name] = (
            rows.writeStream.format("parquet").option("path", f"{out_dir}/{name}").option("checkpointLocation", f"{checkpoint_dir}/{name}")
            .outputMode("append").trigger(**({"processingTime": every} if every else {"availableNow": True})).start()
        )
    return started


def run_all(queries: Mapping[str, StreamingQuery]) -> None:
    """Wait for all streams; the first failure is raised."""
    for q in queries.values():
        q.awaitTermination()


BATCH = "_batch"  # the number of the batch that a count comes from

# Fixed value: how a change feed marks a row as it was before an update.
PRE_IMAGE = "update_preimage"


def newest_changes(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], kind: str = "_change_type") -> DataFrame:
    """R2: the newest change of each key by sequence, never by arrival; each map partition is pruned to one row per key.

    Rows as they were before an update are left out. Of changes with an equal sequence a delete comes before all others
    (it is half of a replacement), and among the others a hash of the row decides, whatever their order.
    """
    rest = [c for c in changes.columns if c not in keys]
    order = [F.col(c).desc_nulls_last() for c in sequence]
    if kind in changes.columns:
        changes = changes.filter(~F.col(kind).eqNullSafe(PRE_IMAGE))
        order.append(F.col(kind).eqNullSafe("delete").asc())
    return latest_per_key(changes, keys, [*order, F.xxhash64(*rest).desc()]).select(*keys, *rest)


def apply_changes(
    changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], kind: str = "_change_type", deletes: Sequence[str] = ("delete",), keep_deleted: bool = False
) -> DataFrame:
    """R2: current rows from change rows. Deleted keys are removed, or kept with ``is_deleted``."""
    latest = newest_changes(changes, keys, sequence, kind)
    gone = F.col(kind).isin(*deletes)
    return latest.withColumn("is_deleted", gone) if keep_deleted else latest.filter(~gone)


def merge_changes(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """R2: a snapshot (newest change per key, deletes included as markers) with later or late changes merged in.

    Delete markers stay in the snapshot, so an older change that arrives late cannot bring a deleted row back.
    """
    return newest_changes(snapshot.unionByName(changes.select(*snapshot.columns)), keys, sequence).select(*snapshot.columns)


def stream_snapshot(
    changes: DataFrame, keys: Sequence[str], sequence: Sequence[str], base: str, checkpoint: str, merge_every: int = 10
) -> StreamingQuery:
    """R2: keeps the newest change per key of a stream under ``base``; ``read_snapshot`` gives the live rows.

    Each micro-batch is one ``add_batch``. ``base`` and ``checkpoint`` belong together: start both anew or neither.
    """
    def write(batch: DataFrame, number: int) -> None:
        add_batch(batch, number, keys, sequence, base, merge_every)

    return changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def add_batch(batch: DataFrame, number: int, keys: Sequence[str], sequence: Sequence[str], base: str, merge_every: int = 10) -> None:
    """Adds the newest changes of batch ``number`` (batches are numbered without gaps) to the generation under ``base``.

    A generation is ``merged=<m>`` and the ``delta=<n>`` after it; a pointer (see ``sources.runs``) names it. The batch's own newest changes
    become a delta, so its cost follows the batch, not the table. Every ``merge_every`` batches a new generation begins, with
    everything merged. Folders count once the pointer names them; a batch that the pointer already holds is not written again. The
    generation before the last one stays for readers that have begun; older folders go. So a batch reads the pointer, writes
    one or two folders, and touches no others, however old the table is.
    """
    spark = batch.sparkSession
    state = read_pointer(spark, base) or {"number": 0, "merged": None, "first": number, "last": number - 1, "before": []}
    if number <= state["last"]:
        return
    newest_changes(batch, keys, sequence).select(*batch.columns).write.mode("overwrite").parquet(f"{base}/delta={number}")
    state |= {"number": state["number"] + 1, "last": number}
    if (number + 1) % merge_every:
        write_pointer(spark, base, state)
        return
    rows = spark.read.schema(batch.schema).parquet(*generation(base, state))
    newest_changes(rows, keys, sequence).select(*batch.columns).write.mode("overwrite").parquet(f"{base}/merged={number}")
    gone, state["before"] = state["before"], generation("", state)
    write_pointer(spark, base, state | {"merged": number, "first": number + 1})
    remove_folders(spark, [f"{base}{f}" for f in gone])


def generation(base: str, state: Mapping) -> list[str]:
    """The folders that a pointer names."""
    merged = [f"{base}/merged={state['merged']}"] if state["merged"] is not None else []
    return merged + [f"{base}/delta={n}" for n in range(state["first"], state["last"] + 1)]


def finished_folders(spark: SparkSession, base: str) -> dict[str, list[int]]:
    """Numbers of the completely written ``<kind>=<n>`` folders under ``base``, by kind.

    Asks the file system the session uses (local, HDFS or an object store).
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[str, list[int]] = {}
    if not fs.exists(path):
        return found
    for status in fs.listStatus(path):
        kind, _, number = status.getPath().getName().partition("=")
        if number.isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.setdefault(kind, []).append(int(number))
    return {k: sorted(v) for k, v in found.items()}


def _snapshot_rows(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """Rows of the last merged table and of the deltas after it. Folders without a pointer are taken if they are finished."""
    state = read_pointer(spark, base)
    if state:
        return spark.read.schema(schema).parquet(*generation(base, state))
    found = finished_folders(spark, base)
    merged = found.get("merged", [])
    after = merged[-1] if merged else -1
    paths = [f"{base}/merged={after}"] if merged else []
    paths += [f"{base}/delta={n}" for n in found.get("delta", []) if n > after]
    return spark.read.schema(schema).parquet(*paths)


def read_snapshot(
    spark: SparkSession, base: str, schema: StructType, keys: Sequence[str], sequence: Sequence[str], kind: str = "_change_type", deletes: Sequence[str] = ("delete",)
) -> DataFrame:
    """R2: live rows of the snapshot as of the last finished batch."""
    return apply_changes(_snapshot_rows(spark, base, schema), keys, sequence, kind, deletes)


def live_status_counts(df: DataFrame, ts: str, kind: str, watermark: str | None = None) -> DataFrame:
    """Rows per day and kind. The same expression serves a stream (with a watermark) and a batch."""
    stamped = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark:
        stamped = stamped.withWatermark(ts, watermark)
    counts = stamped.groupBy(F.window(ts, "1 day"), kind).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.select(F.col("window.start").cast("date").cast("string").alias("day"), kind, "row_count")


def stream_live_counts(
    events: DataFrame, ts: str, kind: str, base: str, checkpoint: str, watermark: str = "7 days", merge_every: int = 10
) -> StreamingQuery:
    """Keeps the counts per day and kind of a stream under ``base``; ``read_live_counts`` gives them.

    The stream holds the counts of days that the watermark has not passed, gives out those that a batch has changed, and
    drops a day's state once the watermark passes its end; so state and output of a batch follow what is open, not all
    that ever was. Each batch's counts are merged by day and kind, the later batch first (see ``add_batch``); a repeated batch changes
    nothing. A row that is later than the watermark is no longer counted here; ``live_status_counts`` over the stored
    events counts it.
    """
    counts = live_status_counts(events, ts, kind, watermark)

    def write(batch: DataFrame, number: int) -> None:
        add_batch(batch.withColumn(BATCH, F.lit(number).cast("bigint")), number, ["day", kind], [BATCH], base, merge_every)

    writer = counts.writeStream.outputMode("update").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_live_counts(spark: SparkSession, base: str, kind: str) -> DataFrame:
    """Rows per day and kind as of the last finished batch."""
    schema = StructType.fromDDL(f"day string, {kind} string, row_count bigint, {BATCH} bigint")
    return newest_changes(_snapshot_rows(spark, base, schema), ["day", kind], [BATCH]).select("day", kind, "row_count")


def day_totals(counts: DataFrame, kind: str, created: str, updated: str) -> DataFrame:
    """Created, updated and total per day out of the status counts."""
    n = F.col("row_count")
    return counts.groupBy("day").agg(
        F.coalesce(F.sum(F.when(F.col(kind) == created, n)), F.lit(0)).alias("created"), F.coalesce(F.sum(F.when(F.col(kind) == updated, n)), F.lit(0)).alias("updated"),
        F.sum("row_count").alias("total"),
    )


def completion_progress(stage: DataFrame, done: DataFrame, key: str, done_key: str) -> DataFrame:
    """Staged rows, completed and remaining ones, done rows nobody staged, and percent. Run again per batch."""
    a = stage.select(F.col(key).alias("_a")).distinct()
    b = done.select(F.col(done_key).alias("_b")).distinct()
    both = a.join(b, F.col("_a") == F.col("_b"), "full_outer")
    staged, finished = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    return both.agg(
        count_if(staged).alias("total"), count_if(staged & finished).alias("completed"), count_if(staged & ~finished).alias("remaining"),
        count_if(~staged & finished).alias("orphans"), percent(count_if(staged & finished), count_if(staged)).alias("completed_pct"),
    )


def soft_delete_report(df: DataFrame, deleted: str, synced: str) -> DataFrame:
    """Rows, first and last sync by deleted flag."""
    return df.groupBy(deleted).agg(F.count(F.lit(1)).alias("row_count"), F.min(synced).alias("first_sync"), F.max(synced).alias("last_sync"))


def deletions_per_day(df: DataFrame, deleted: str, synced: str) -> DataFrame:
    """Deleted rows per day."""
    return df.filter(F.col(deleted)).groupBy(F.col(synced).cast("date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("deleted_rows"))


def active_only(df: DataFrame, deleted: str) -> DataFrame:
    """Rows not deleted; an unknown flag counts as not deleted."""
    return df.filter(~F.coalesce(F.col(deleted), F.lit(False)))
