"""Health of a sync, daily snapshots, trends parsed from them, tiles and alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.functions.columns import count_if, elapsed, first_match, moment, percent
from crosswalk.functions.scale import with_figures
from crosswalk.operators.filters import today


# Size above which the create queue gets each label, and percent below which coverage does
CREATE_BANDS = [(200, "High CREATE backlog"), (50, "Moderate CREATE queue"), (0, "Small CREATE queue")]
COVERAGE_BANDS = [(90, "Coverage LOW (<90%)"), (95, "Coverage OK (90-95%)")]


def _cross(parts: Sequence[DataFrame]) -> DataFrame:
    """One wide row from one-row aggregates."""
    return reduce(with_figures, parts)


def health_check(
    rows: DataFrame, target: DataFrame, agg: DataFrame, creates: DataFrame, updates: DataFrame, audit: DataFrame, deleted: str, as_of: str, day: str
) -> DataFrame:
    """M3: one row: source, target, queue, multi and sync figures, coverage, gap and status bands.

    ``rows`` are enriched entities, ``agg`` the rows per key, ``audit`` the audit log. Pass materialised frames:
    each is read once here. The gap is source total minus target total.
    """
    one = _cross([
        rows.agg(F.count(F.lit(1)).alias("total_source"), count_if(F.col("is_active")).alias("active_source"), count_if(F.col("has_valid_key")).alias("source_with_key")),
        target.filter(~F.col(deleted)).agg(F.count(F.lit(1)).alias("total_target")),
        agg.agg(F.count(F.lit(1)).alias("total_keys"), count_if(F.col("is_multi")).alias("multi_keys"), F.max("active_count").alias("max_per_key")),
        creates.agg(F.count(F.lit(1)).alias("create_queue"), count_if(F.col("has_any_flag")).alias("create_with_features"), count_if(F.col("is_multi")).alias("create_multi")),
        updates.agg(F.count(F.lit(1)).alias("update_queue"), count_if(F.col("has_any_flag")).alias("update_with_features"), count_if(F.col("is_multi")).alias("update_multi")),
        audit.filter(F.col("sync_type").isin("CREATE", "UPDATE")).agg(
            F.max("execution_timestamp").alias("last_sync_at"),
            F.coalesce(F.sum(F.when(today("execution_timestamp", day), F.col("records_succeeded"))), F.lit(0)).cast("bigint").alias("synced_today"),
        ),
    ])
    one = one.withColumn("coverage_pct", percent(F.col("total_target"), F.col("source_with_key")))
    q, c = F.col("create_queue"), F.col("coverage_pct")
    return one.withColumns({
        "gap": F.col("total_source") - F.col("total_target"),
        "report_at": moment(as_of),
        "create_queue_status": first_match([(q > n, label) for n, label in CREATE_BANDS], "No creates needed"),
        "coverage_status": first_match([(c < n, label) for n, label in COVERAGE_BANDS], "Coverage GOOD (>95%)"),
    })


# Queue kind -> (size above which it is high, size from which it is moderate)
QUEUE_LIMITS = {"create": (100, 50), "update": (1000, 500)}


@dataclass(frozen=True)
class QueueRules:
    """Limits of the queue check, and what its findings are called; ``{queue}`` stands for the queue's name."""

    limits: Mapping[str, tuple[int, int]] = field(default_factory=lambda: QUEUE_LIMITS)
    start_hour: int = 8  # the first sync of a day is expected by the end of this hour
    stale_hours: int = 2
    full: str = "{queue}: too long"
    filling: str = "{queue}: long"
    silent: str = "no run since midnight"
    idle: str = "runs without rows"
    stale: str = "last run long ago"
    fine: str = "in order"
    sizes: Sequence[tuple[int, str]] = ((0, "empty"), (1, "short"))  # from this size on


def queue_health(queues: Mapping[str, DataFrame], activity: Mapping[str, DataFrame], as_of: str, hour: int, rules: QueueRules = QueueRules()) -> DataFrame:
    """M4: per queue: size, last sync, records today, status and assessment.

    ``activity`` gives per queue a one-row frame (last_sync_at, records_today). Alarms (a full queue, a day without a sync) come before
    warnings (a filling queue, an old sync). Elapsed hours count across midnight.
    """
    parts = []
    size, last = F.col("queue_size"), F.col("last_sync_at")
    expected = F.lit(hour > rules.start_hour)
    assessment = first_match([(size >= least, text) for least, text in sorted(rules.sizes, reverse=True)])
    for kind, queue in queues.items():
        high, some = rules.limits[kind]
        alarms = [(size > high, rules.full.format(queue=kind)), (expected & last.isNull(), rules.silent), (expected & (F.col("records_today") == 0), rules.idle)]
        warnings = [(size >= some, rules.filling.format(queue=kind)), (elapsed(last, moment(as_of), "hour") > rules.stale_hours, rules.stale)]
        one = _cross([queue.agg(F.count(F.lit(1)).alias("queue_size")), activity[kind]])
        status = first_match([*alarms, *warnings], rules.fine)
        parts.append(one.select(F.lit(kind).alias("queue"), "queue_size", "last_sync_at", "records_today", status.alias("status"), assessment.alias("assessment")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def sync_activity(target: DataFrame, created: str, modified: str, deleted: str, day: str) -> dict[str, DataFrame]:
    """M4: last create and last update of the day with their row counts (updates exclude rows created that day)."""
    live = target.filter(~F.col(deleted))
    made = live.filter(today(created, day)).agg(F.max(created).alias("last_sync_at"), F.count(F.lit(1)).alias("records_today"))
    changed = live.filter(today(modified, day) & (F.col(created) < moment(day))).agg(F.max(modified).alias("last_sync_at"), F.count(F.lit(1)).alias("records_today"))
    return {"create": made, "update": changed}


def audit_snapshot(
    target: DataFrame, health: DataFrame, name: str, flags: Mapping[str, str], created: str, modified: str, day: str, as_of: str
) -> DataFrame:
    """M5: the daily snapshot row: counts, error rate, the metrics as columns and as a text note."""
    one = _cross([
        target.agg(
            F.count(F.lit(1)).alias("records_processed"), F.count(name).alias("records_succeeded"), count_if(F.col(name).isNull()).alias("records_failed"),
            *[count_if(F.col(f)).alias(f"flag_{f}") for f in flags], count_if(today(created, day)).alias("created_today"), count_if(today(modified, day)).alias("updated_today"),
        ),
        health.select("coverage_pct", "coverage_status", "total_source", "total_target", "gap", "create_queue", "update_queue"),
    ])
    parts = {
        "Coverage": F.concat(F.format_string("%.2f", F.col("coverage_pct")), F.lit("%")), "Status": F.col("coverage_status"), "Source Total": F.col("total_source"),
        "Target Total": F.col("total_target"), "Gap": F.col("gap"), "CREATE Queue": F.col("create_queue"), "UPDATE Queue": F.col("update_queue"),
        "Created Today": F.col("created_today"), "Updated Today": F.col("updated_today"), **{label: F.col(f"flag_{f}") for f, label in flags.items()},
    }
    note = F.concat_ws(" | ", *[F.concat(F.lit(f"{k}: "), v.cast("string")) for k, v in parts.items()])
    return one.withColumns({
        "audit_id": F.concat(F.lit("daily_snapshot_"), F.date_format(moment(as_of), "yyyyMMdd")), "sync_name": F.lit("Daily System Snapshot"), "sync_type": F.lit("MONITORING"),
        "execution_timestamp": moment(as_of), "error_rate": percent(F.col("records_failed"), F.col("records_processed")), "executed_by": F.lit("automated_daily_snapshot"), "notes": note,
    })


def audit_trends(audit: DataFrame, fields: Mapping[str, str], as_of: str, days: int = 30, kind: str = "MONITORING") -> DataFrame:
    """M6: figures parsed back from the notes of the last days; a figure a note lacks is NULL.

    ``fields`` maps an output column to the label in front of the number.
    """
    rows = audit.filter((F.col("sync_type") == kind) & (F.col("execution_timestamp") >= moment(as_of) - F.expr(f"INTERVAL {days} DAYS")))
    def number(label: str) -> Column:
        return F.regexp_extract("notes", rf"{label}: ([0-9.]+)", 1).try_cast("double")

    return rows.select(F.col("execution_timestamp").cast("date").cast("string").alias("snapshot_date"), *[number(v).alias(k) for k, v in fields.items()])


# Alert limits
LIMITS = {"coverage": 90.0, "null_names": 50, "sync_age_hours": 2, "create_queue": 100, "update_queue": 1000}


def daily_alerts(metrics: DataFrame, limits: Mapping[str, float] = LIMITS) -> DataFrame:
    """One row per rule: value, limit, pass flag and message. ``metrics`` is one row with the named columns."""
    low = {"coverage"}
    lines = []
    for name, limit in limits.items():
        value = F.col(name).cast("double")
        good = F.coalesce(value >= limit if name in low else value <= limit, F.lit(False))
        text = F.concat(F.when(good, "OK ").otherwise("ALERT "), F.lit(f"{name}: "), F.coalesce(F.format_string("%.2f", value), F.lit("no value")), F.lit(f" (limit {limit:g})"))
        lines.append(F.struct(F.lit(name).alias("rule"), value.alias("value"), F.lit(float(limit)).alias("limit_value"), good.alias("pass"), text.alias("message")))
    return metrics.select(F.inline(F.array(*lines)))


def alert_metrics(health: DataFrame, target: DataFrame, name: str, modified: str, as_of: str) -> DataFrame:
    """The row of metrics the alert rules read."""
    side = target.agg(count_if(F.col(name).isNull()).alias("null_names"), elapsed(F.max(modified), moment(as_of), "hour").alias("sync_age_hours"))
    return _cross([health.select(F.col("coverage_pct").alias("coverage"), "create_queue", "update_queue"), side])


def status_tile(health: DataFrame, bands: Sequence[tuple[float, str]] = ((95, "Excellent"), (90, "Good"), (85, "OK")), other: str = "Attention Needed") -> DataFrame:
    """The system status tile."""
    return health.select(first_match([(F.col("coverage_pct") >= low, label) for low, label in bands], other).alias("status"), "coverage_pct", "gap")


def queue_tile(health: DataFrame, limits: Mapping[str, tuple[int, int]] = QUEUE_LIMITS) -> DataFrame:
    """Queue sizes with High, Moderate or Normal."""
    rows = []
    for kind, (high, some) in limits.items():
        size = F.col(f"{kind}_queue")
        rows.append(F.struct(F.lit(kind).alias("queue_type"), size.alias("queue_size"), first_match([(size > high, "High"), (size > some, "Moderate")], "Normal").alias("status")))
    return health.select(F.inline(F.array(*rows)))


def adoption_tile(target: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Enabled rows and percent per flag, one pass."""
    one = target.agg(F.count(F.lit(1)).alias("_n"), *[count_if(F.col(f)).alias(f"_{i}") for i, f in enumerate(flags)])
    rows = [
        F.struct(F.lit(label).alias("feature"), F.col(f"_{i}").alias("enabled_count"), percent(F.col(f"_{i}"), F.col("_n"), 1).alias("enabled_pct"))
        for i, label in enumerate(flags.values())
    ]
    return one.select(F.inline(F.array(*rows)))


def last_sync_tile(target: DataFrame, times: Mapping[str, str], as_of: str) -> DataFrame:
    """Last time and age in hours per kind of sync."""
    one = target.agg(*[F.max(c).alias(f"_{i}") for i, c in enumerate(times.values())])
    rows = [
        F.struct(F.lit(k).alias("sync_type"), F.col(f"_{i}").alias("last_sync_at"), elapsed(F.col(f"_{i}"), moment(as_of), "hour").alias("hours_ago"))
        for i, k in enumerate(times)
    ]
    return one.select(F.inline(F.array(*rows)))
