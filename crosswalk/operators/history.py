"""Events in time order.

A key may own a third of all events, also within one hour, so nothing here sorts a whole key in one task unless it was first
reduced to one row per day or per state; see ``functions.scale.pieces`` for row-level ordering.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosswalk.functions.columns import codes_present, count_if, day_text, elapsed, hours_between, micros, moment
from crosswalk.functions.scale import carried, join_back, lag_in_key, latest_per_key, pieces

FOREVER = "9999-12-31 00:00:00"  # the end of a period that is still open


def feature_effective_join(rows: DataFrame, features: DataFrame, key: str, ts: str, enabled_at: str) -> DataFrame:
    """Rows on or after the moment their entity's feature was enabled (earliest enabling, one per entity)."""
    starts = features.groupBy(key).agg(F.min(enabled_at).alias("enabled_at"))
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    out = join_back(rows, starts.join(sizes, key), [key], "_rows", "inner").drop("_rows")
    return out.filter(F.col(ts) >= F.col("enabled_at"))


def pair_events(df: DataFrame, key: str, status: str, ts: str, first: str, later: str) -> DataFrame:
    """Per key, the first ``first`` event and the first ``later`` event after it, with minutes between.

    The first start is a minimum per key joined back to the later events, so keys are never self-joined.
    """
    rows = df.filter(F.col(status).isin(first, later)).select(key, status, ts)
    starts = rows.groupBy(key).agg(
        F.min(F.when(F.col(status) == first, F.col(ts))).alias("started_at"), count_if(F.col(status) == later).alias("_rows")
    )
    ends = join_back(rows.filter(F.col(status) == later), starts.filter("started_at IS NOT NULL"), [key], "_rows", "inner")
    done = ends.filter(F.col(ts) > F.col("started_at")).groupBy(key, "started_at").agg(F.min(ts).alias("finished_at"))
    minutes = (micros(F.col("finished_at")) - micros(F.col("started_at"))).cast("double") / 60_000_000
    return done.withColumn("minutes", F.round(minutes, 4))


def pair_average(df: DataFrame, key: str, status: str, ts: str, first: str, later: str, grain: str = "day", rows: int | None = None) -> DataFrame:
    """Mean minutes over all (first, later) event pairs of a key with later > first, and the pair count.

    For each later event only the number and the sum of the earlier starts are needed. They are running totals per
    key, taken inside the pieces of a key and carried over them, so the pairs themselves never exist, and a key that
    holds a third of all events within an hour is summed in many tasks. A start and an end at the same time are no pair, so events of one time
    are merged first.
    """
    stamp = F.col("_b") * F.col("_at").cast("decimal(38,0)")
    events = df.filter(F.col(status).isin(first, later) & F.col(ts).isNotNull()).groupBy(key, ts)
    merged = events.agg(count_if(F.col(status) == first).alias("_b"), count_if(F.col(status) == later).alias("_e")).withColumn("_at", micros(F.col(ts)))
    cells = pieces(merged, [key], [ts], F.date_trunc(grain, F.col(ts)), rows)
    parts = [key, "_bucket", "_cell"]
    order = Window.partitionBy(*parts).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = cells.withColumns({"_n": F.sum("_b").over(order), "_s": F.sum(stamp).over(order)}).filter("_e > 0")
    out = inside.join(carried(cells, [key], {"_on": F.col("_b"), "_os": stamp}), parts)
    n = (F.coalesce("_n", F.lit(0)) + F.col("_on")) * F.col("_e")
    earlier = (F.coalesce("_s", F.lit(0)) + F.col("_os")) * F.col("_e")
    agg = out.agg(F.sum(n).alias("pairs"), F.sum(n * F.col("_at").cast("decimal(38,0)") - earlier).alias("_micros"))
    return agg.select("pairs", F.round(F.try_divide(F.col("_micros").cast("double"), F.col("pairs")) / 60_000_000, 4).alias("avg_minutes"))


def period_gaps(
    df: DataFrame, key: str, start: str, end: str, id_col: str, days: int, grain: str = "month", open_covers: bool = False, rows: int | None = None
) -> DataFrame:
    """Gaps of more than ``days`` days of a key that no period covers, between the period that had reached
    furthest and the next one by start. A period within a longer one opens no gap.

    A period without an end covers nothing, as its length is not known; with ``open_covers`` it covers all that comes
    after its start. A period without a start is left out. The furthest end is carried within the pieces of a key and, one row per piece,
    across them, so no task sorts a whole key.
    """
    reached = F.coalesce(F.col(end), F.lit(FOREVER).cast(df.schema[end].dataType)) if open_covers else F.col(end)
    given = df.select(key, id_col, start, end).filter(F.col(start).isNotNull()).withColumn("_to", reached)
    cells = pieces(given, [key], [start, id_col], F.date_trunc(grain, F.col(start)), rows)
    parts = [key, "_bucket", "_cell"]
    reach = F.when(F.col("_to").isNotNull(), F.struct(F.col("_to").alias("at"), F.col(id_col).alias("id")))
    inside = Window.partitionBy(*parts).orderBy(start, id_col).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(key).orderBy("_bucket", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    most = latest_per_key(cells.filter(F.col("_to").isNotNull()), parts, [F.col("_to").desc(), F.col(id_col).desc()])
    # Pieces whose periods all have no end hand on what came before them: every piece needs a row here.
    every = cells.select(*parts).distinct().join(most.select(*parts, reach.alias("_most")), parts, "left")
    before = every.select(*parts, F.max("_most").over(across).alias("_before"))
    out = cells.withColumn("_inside", F.max(reach).over(inside)).join(before, parts).withColumn("_last", F.greatest("_inside", "_before"))
    gap = micros(F.col(start)) - micros(F.col("_last.at"))
    return out.filter(gap > days * 86_400_000_000).select(
        key, F.col("_last.id").alias("after_id"), F.col(id_col).alias("before_id"), F.col("_last.at").alias("gap_start"),
        F.col(start).alias("gap_end"), F.round(gap.cast("double") / 86_400_000_000, 4).alias("gap_days"),
    )


def still_in_state(df: DataFrame, keys: Sequence[str], status: str, ts: str, state: str, clearing: Sequence[str]) -> DataFrame:
    """State rows not followed by a clearing event of the same entity.

    A row is open exactly when the entity's last clearing event is not later, so one maximum per entity decides.
    """
    held = df.filter(F.col(status) == state).select(*keys, ts)
    cleared = df.groupBy(*keys).agg(
        F.max(F.when(F.col(status).isin(*clearing), F.col(ts))).alias("_cleared"), count_if(F.col(status) == state).alias("_rows")
    )
    out = join_back(held, cleared, keys, "_rows", "inner")
    return out.filter(F.col("_cleared").isNull() | (F.col("_cleared") <= F.col(ts))).select(*keys, F.col(ts).alias("since")).distinct()


def overridden_decisions(df: DataFrame, key: str, kind: str, label: str, ts: str, tie: str, decision: object, override: object) -> DataFrame:
    """Decisions followed by an override of the same subject: both labels and the time of the last override."""
    made = df.filter(F.col(kind) == F.lit(decision)).select(key, tie, F.col(label).alias("original_label"), F.col(ts).alias("_at"))
    stats = df.groupBy(key).agg(
        count_if(F.col(kind) == F.lit(decision)).alias("_rows"),
        F.max_by(F.when(F.col(kind) == F.lit(override), F.struct(F.col(label).alias("l"), F.col(ts).alias("t"))),
                 F.when(F.col(kind) == F.lit(override), F.struct(ts, tie))).alias("_o"),
    )
    out = join_back(made, stats, [key], "_rows", "inner").filter(F.col("_o.t") > F.col("_at"))
    return out.select(key, tie, "original_label", F.col("_o.l").alias("override_label"), F.col("_o.t").alias("override_at"))


def day_over_day(df: DataFrame, ts: str, value: Column, name: str = "value") -> DataFrame:
    """Daily value, the value of the day before and the change. The window sees one row per day."""
    daily = df.groupBy(day_text(F.col(ts)).alias("day")).agg(value.alias(name))
    prev = F.lag(name).over(Window.orderBy("day"))
    return daily.withColumn(f"prev_{name}", prev).withColumn("change", F.col(name) - F.col(f"prev_{name}"))


def time_in_status(df: DataFrame, key: str, status: str, ts: str, tie: str, grain: str = "day", rows: int | None = None) -> DataFrame:
    """Time since the previous change of the same item, and what it was. Rows without an item are left out."""
    out = lag_in_key(df.select(key, status, ts, tie), [key], ts, tie, [status, ts], grain, rows)
    return out.withColumn("seconds_since", elapsed(F.col(f"prev_{ts}"), F.col(ts), "second"))


def cumulative_by_day(df: DataFrame, group: str, ts: str) -> DataFrame:
    """Rows per day and group with the running total; the window sees one row per day and group."""
    daily = df.groupBy(group, day_text(F.col(ts)).alias("day")).agg(F.count(F.lit(1)).alias("row_count"))
    window = Window.partitionBy(group).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("cumulative", F.sum("row_count").over(window))


def event_current_state(df: DataFrame, entity: str, code: str, state: str, ts: str, tie: str) -> DataFrame:
    """Last event per entity and code."""
    return latest_per_key(df, [entity, code], [F.col(ts).desc_nulls_last(), F.col(tie).desc()]).select(entity, code, state, F.col(ts).alias("since"))


def enabled_set(current: DataFrame, entity: str, code: str, state: str, codes: Sequence[str], enabled: str = "enabled") -> DataFrame:
    """Those of ``codes`` that are enabled for each entity as sorted text, and their number."""
    listed, number = codes_present(F.col(code), codes, F.col(state) == enabled, ",")
    return current.groupBy(entity).agg(listed.alias("enabled_codes"), number.alias("enabled_count"))


def lifecycle_duration(df: DataFrame, key: str, status: str, ts: str, start: str, end: str) -> DataFrame:
    """First start, last end and lifetime in hours of entities that ended at least once."""
    out = df.groupBy(key).agg(
        F.min(F.when(F.col(status) == start, F.col(ts))).alias("activated_at"), F.max(F.when(F.col(status) == end, F.col(ts))).alias("deactivated_at")
    ).filter("deactivated_at IS NOT NULL")
    return out.withColumn("lifetime_hours", F.round(hours_between(F.col("activated_at"), F.col("deactivated_at")), 4))


def toggle_counts(df: DataFrame, key: str, more_than: int = 1) -> DataFrame:
    """Entities with more than one event."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("toggles")).filter(F.col("toggles") > more_than)


def cross_service_context(root: DataFrame, key: str, services: Mapping[str, tuple[DataFrame, str, str, Sequence[str]]]) -> DataFrame:
    """One row per document with the newest record of each service and how many records it has there.

    ``services`` maps a prefix to (table, its key, order column, columns). Keys are compared as text. Each service
    is reduced to one row per document before the join, so records of different services do not multiply.
    """
    out = root.withColumn("_k", F.col(key).cast("string"))
    for prefix, (df, theirs, order, columns) in services.items():
        keyed = df.withColumn("_k", F.col(theirs).cast("string")).filter(F.col("_k").isNotNull())
        newest = latest_per_key(keyed, ["_k"], [F.col(c).desc_nulls_last() for c in (order, *columns)])
        counts = keyed.groupBy("_k").agg(F.count(F.lit(1)).alias(f"{prefix}_records"))
        side = newest.select("_k", *[F.col(c).alias(f"{prefix}_{c}") for c in columns])
        out = out.join(counts, "_k", "left").join(side, "_k", "left").fillna(0, [f"{prefix}_records"])
    return out.drop("_k")


def eligible_next(
    items: DataFrame, permissions: DataFrame, ready: Column, group: str, who: str, item: str, due: str, as_of: str, priority: Column
) -> DataFrame:
    """For each reviewer the next item: due, permitted, by priority, then age.

    The best item of each work group is found first (a reviewer never needs another one of that group), so items
    are not paired with reviewers.
    """
    waiting = items.filter(ready & (F.col(due) <= moment(as_of))).withColumn("_p", priority)
    order = [F.col("_p").asc(), F.col(due).asc(), F.col(item).asc()]
    best = latest_per_key(waiting.select(group, "_p", due, item), [group], order)
    allowed = permissions.select(who, group).distinct().join(best, group)
    return latest_per_key(allowed, [who], [*order, F.col(group).asc()]).select(who, group, F.col("_p").alias("priority"), due, item)


