"""Grouped figures, rates, distributions and duplicate reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.functions.columns import (
    Rule,
    codes_present,
    count_if,
    first_match,
    hours_between,
    letters_and_digits,
    mean,
    micros,
    moment,
    month_text,
    ordered_label,
    percent,
    week_text,
)
from crosswalk.functions.scale import group_stats, highest, latest_per_key, percentiles, with_figures
from crosswalk.operators.windows import percent_of_total



def label_counts(status: str, labels: Mapping[str, str]) -> list[Column]:
    """One count column per label value."""
    return [count_if(F.col(status) == value).alias(name) for name, value in labels.items()]


# ---- feature families -------------------------------------------------------------------------------------------


def feature_family_type(
    entities: DataFrame, features: DataFrame, entity_id: str, feature_key: str, code: str, in_family: Column, only_label: str, codes: Sequence[str]
) -> DataFrame:
    """A3: each entity with its enabled features (of ``codes``, the features there are) counted and typed: none, only the family, or mixed.

    Features are reduced to one row per entity first; grouping is by the entity's own id, so entities without
    features stay apart.
    """
    listed, number = codes_present(F.col(code), codes)
    known = features.filter(F.col(code).isin(*codes))
    per = known.groupBy(F.col(feature_key).alias(entity_id)).agg(number.cast("bigint").alias("feature_count"), listed.alias("feature_list"), count_if(~in_family).alias("_other"))
    out = entities.join(per, entity_id, "left").fillna(0, ["feature_count", "_other"]).fillna("", ["feature_list"])
    kind = first_match([(F.col("feature_count") == 0, "No Features"), (F.col("_other") == 0, only_label)], "Mixed Features")
    return out.withColumn("feature_type", kind).drop("_other")


def feature_type_counts(typed: DataFrame) -> DataFrame:
    """A3: entities and features per type."""
    return typed.groupBy("feature_type").agg(F.count(F.lit(1)).alias("entity_count"), F.sum("feature_count").alias("total_features"))


# ---- dashboard figures ------------------------------------------------------------------------------------------


def kpi_summary(df: DataFrame, status: str, labels: Mapping[str, str], distinct: Mapping[str, str], rates: Sequence[str]) -> DataFrame:
    """A4: one row: total, distinct parents, rows per label and rates of some labels (NULL when there is no row)."""
    # Rows are merged per combination of the distinct columns first, so the expansion Spark makes for several
    # distinct counts works on combinations, not on rows.
    per = df.groupBy(*distinct.values()).agg(F.count(F.lit(1)).alias("total"), *label_counts(status, labels))
    one = per.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"), *[F.count_distinct(c).alias(n) for n, c in distinct.items()],
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in labels],
    )
    return one.select("*", *[percent(F.col(r), F.col("total")).alias(f"{r}_rate") for r in rates])


def group_performance(
    df: DataFrame, keys: Sequence[str | Column], status: str, labels: Mapping[str, str], passed: str, ts: str | None = None,
    as_of: str | None = None, distinct: Mapping[str, str] | None = None, digits: int = 1,
) -> DataFrame:
    """Per group: rows, rows per label, pass rate, distinct children, first and last time, days since the last."""
    total = F.count(F.lit(1))
    aggs = [total.alias("total"), *[F.count_distinct(c).alias(n) for n, c in (distinct or {}).items()], *label_counts(status, labels)]
    aggs.append(percent(count_if(F.col(status) == labels[passed]), total, digits).alias("pass_rate"))
    if ts:
        aggs += [F.min(ts).alias("first_at"), F.max(ts).alias("last_at")]
    out = df.groupBy(*keys).agg(*aggs)
    if ts and as_of:
        out = out.withColumn("days_since_last", F.datediff(moment(as_of).cast("date"), F.col("last_at").cast("date")))
    return out


def daily_status_counts(df: DataFrame, ts: str, status: str) -> DataFrame:
    """Rows by day and status."""
    return df.groupBy(F.col(ts).cast("date").cast("string").alias("day"), status).agg(F.count(F.lit(1)).alias("row_count"))


def weekly_summary(df: DataFrame, ts: str, status: str, labels: Mapping[str, str], passed: str) -> DataFrame:
    """Totals and pass rate per week (weeks start on Monday)."""
    return group_performance(df, [week_text(F.col(ts)).alias("week_start")], status, labels, passed, digits=2)


def distribution_pct(df: DataFrame, column: str | Column, name: str, top: int | None = None) -> DataFrame:
    """Rows and share of all rows per value; with ``top`` the most frequent values, shares still of all."""
    counts = df.groupBy((F.col(column) if isinstance(column, str) else column).alias(name)).agg(F.count(F.lit(1)).alias("row_count"))
    out = percent_of_total(counts, "row_count")
    return out if top is None else out.orderBy(F.desc("row_count"), F.asc(name)).limit(top)


def recent_detail(df: DataFrame, ts: str, tie: str, columns: Sequence[str], extra: Mapping[str, Column], as_of: str, n: int | None = None) -> DataFrame:
    """Rows, all or the ``n`` newest, with derived columns and their age in days."""
    age = F.datediff(moment(as_of).cast("date"), F.col(ts).cast("date")).alias("days_ago")
    return highest(df, [F.col(ts).desc(), F.col(tie)], n).select(*columns, *[c.alias(k) for k, c in extra.items()], age)


def filter_list(df: DataFrame, columns: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    """A10: distinct values for a drop-down, sorted."""
    return df.select(*[F.col(c).alias(n) for n, c in columns.items()]).distinct().orderBy(*order)


def kpi_rows(one: DataFrame, rows: Sequence[tuple[str, str, str | None, str | None]]) -> DataFrame:
    """(metric, count, percentage, notes) rows from a single aggregated row.

    Each entry is (label, count column, base column, note); without a base the share is 100%.
    """
    def share(value: str, base: str | None) -> Column:
        if base is None:
            return F.lit("100%")
        return F.concat(F.format_string("%.2f", percent(F.col(value), F.col(base))), F.lit("%"))

    lines = [
        F.struct(F.lit(label).alias("metric"), F.col(value).alias("count"), share(value, base).alias("percentage"), F.lit(note).cast("string").alias("notes"))
        for label, value, base, note in rows
    ]
    return one.select(F.inline(F.array(*lines)))


# Classes of duplicate names, urgency levels and points
SAME_NAMES, OTHER_NAMES, UNCLEAR = "LIKELY_MIGRATION", "DIFFERENT_NAMES", "UNKNOWN"
PRIORITIES = ("P1 - URGENT", "P2 - HIGH", "P3 - MEDIUM", "P4 - LOW")
FEATURE_POINTS, MISSING_POINTS = 10, 5

# ---- duplicates -------------------------------------------------------------------------------------------------


def valid_key(key: str, sentinels: Sequence[str]) -> Column:
    good = F.col(key).isNotNull()
    return good & ~F.col(key).isin(*sentinels) if sentinels else good


def duplicate_groups(df: DataFrame, key: str, created: str, sentinels: Sequence[str] = ()) -> DataFrame:
    """Keys shared by several rows: number, oldest and newest time. ``duplicate_rows`` gives the members."""
    out = df.filter(valid_key(key, sentinels)).groupBy(key).agg(
        F.count(F.lit(1)).alias("copies"), F.min(created).alias("oldest"), F.max(created).alias("newest")
    )
    return out.filter("copies > 1")


def duplicate_rows(df: DataFrame, key: str, sentinels: Sequence[str] = ()) -> DataFrame:
    """The rows of every shared key with the number of copies; all members, one row each."""
    return group_stats(df.filter(valid_key(key, sentinels)), [key], size="copies").filter("copies > 1")


def duplicate_status(df: DataFrame, key: str, status: str, created: str, sentinels: Sequence[str] = (), active: str = "ACTIVE", disabled: str = "DISABLED") -> DataFrame:
    """One row: disabled rows within shared keys, groups they touch, and groups with no active row."""
    groups = df.filter(valid_key(key, sentinels)).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col(status) == active).alias("a"), count_if(F.col(status) == disabled).alias("d"),
        F.min(F.when(F.col(status) == disabled, F.col(created))).alias("lo"), F.max(F.when(F.col(status) == disabled, F.col(created))).alias("hi"),
    ).filter("n > 1")
    idle = F.col("a") == 0
    return groups.agg(
        F.coalesce(F.sum("d"), F.lit(0)).alias("disabled_rows"), count_if(F.col("d") > 0).alias("groups_with_disabled"), F.min("lo").alias("oldest"),
        F.max("hi").alias("newest"), count_if(idle).alias("groups_without_active"), F.coalesce(F.sum(F.when(idle, F.col("n"))), F.lit(0)).alias("rows_in_those_groups"),
    )


def duplicate_name_class(df: DataFrame, key: str, name: str, sentinels: Sequence[str] = ()) -> DataFrame:
    """Same or different names within a group, compared as letters and digits only.

    Smallest and largest normalised name decide it; no list of names is gathered. A name without letters and digits
    leaves its group unclear.
    """
    plain = letters_and_digits(F.col(name))
    out = df.filter(valid_key(key, sentinels)).groupBy(key).agg(F.count(F.lit(1)).alias("copies"), F.min(plain).alias("_lo"), F.max(plain).alias("_hi"))
    kind = first_match([(F.col("_lo") == "", UNCLEAR), (F.col("_lo") == F.col("_hi"), SAME_NAMES), (F.col("_lo") != F.col("_hi"), OTHER_NAMES)], UNCLEAR)
    return out.filter("copies > 1").select(key, "copies", kind.alias("issue_category"))


def duplicate_triage(members: DataFrame, features: str, in_target: Column) -> DataFrame:
    """Urgency of each member: 10 per enabled feature, 5 when missing in the target; P1 to P4."""
    used, here = F.col(features) > 0, F.coalesce(in_target, F.lit(False))
    level = first_match(list(zip([used & ~here, used, ~here], PRIORITIES)), PRIORITIES[-1])
    score = F.col(features) * FEATURE_POINTS + F.when(here, 0).otherwise(MISSING_POINTS)
    return members.withColumn("in_target", here).withColumn("priority_score", score).withColumn("priority_level", level)


# ---- periods, durations, ages -----------------------------------------------------------------------------------


def period_share_pivot(df: DataFrame, ts: str, kind: str, kinds: Sequence[str], value: Column, period: str = "month", last: int | None = None) -> DataFrame:
    """Totals per period and kind, the row total and each kind's share; optionally the last periods only."""
    text = month_text(F.col(ts)) if period == "month" else week_text(F.col(ts))
    out = df.groupBy(text.alias("period")).pivot(kind, list(kinds)).agg(F.sum(value)).fillna(0)
    total = reduce(lambda a, b: a + b, [F.col(f"`{k}`") for k in kinds])
    out = out.withColumn("total", total).withColumns({f"{k}_pct": percent(F.col(f"`{k}`"), F.col("total"), 1) for k in kinds})
    return out if last is None else out.orderBy(F.desc("period")).limit(last)


def duration_stats(
    df: DataFrame, keys: Sequence[str], minutes: str, success: Column, lookback_days: int, units_per_minute: float, unit_price: float
) -> DataFrame:
    """Mean, exact median and 95th percentile, extremes, success counts, monthly projection and cost.

    ``minutes`` must be a decimal so that sums do not depend on row order.
    """
    timed = df.filter(F.col(minutes).isNotNull())
    middle = percentiles(timed, keys, minutes, {"median": 0.5, "p95": 0.95})
    base = df.groupBy(*keys).agg(
        F.count(minutes).alias("runs"), mean(F.col(minutes)).alias("avg_minutes"), F.min(minutes).cast("double").alias("min_minutes"),
        F.max(minutes).cast("double").alias("max_minutes"), count_if(success).alias("successful"), count_if(~success).alias("failed"),
        F.sum(minutes).cast("double").alias("_sum"),
    )
    per_month = F.col("_sum") * 30.0 / lookback_days
    out = base.join(middle, list(keys), "left") if keys else with_figures(base, middle)
    return out.select(
        *keys, "runs", "avg_minutes", F.round("median", 4).alias("median"), F.round("p95", 4).alias("p95"), "min_minutes", "max_minutes", "successful", "failed",
        F.round(per_month, 4).alias("minutes_per_month"), F.round(per_month * units_per_minute * unit_price, 4).alias("monthly_cost"),
    )


AGE_BUCKETS = ("< 24 hours", "24-48 hours", "2-7 days", "> 7 days")  # fixed values


def age_distribution(df: DataFrame, opened: str, as_of: str) -> DataFrame:
    """Open rows by age bucket, in a fixed order."""
    hours = hours_between(F.col(opened), moment(as_of))
    bucket = first_match([(hours < 24, AGE_BUCKETS[0]), (hours < 48, AGE_BUCKETS[1]), (hours < 168, AGE_BUCKETS[2])], AGE_BUCKETS[3])
    out = df.groupBy(bucket.alias("age_bucket")).agg(F.count(F.lit(1)).alias("row_count"))
    return out.withColumn("sort_order", ordered_label(F.col("age_bucket"), AGE_BUCKETS))


def open_hours_by(df: DataFrame, category: str, opened: str, as_of: str) -> DataFrame:
    """Open rows and their mean age in hours per category."""
    total = F.sum((micros(moment(as_of)) - micros(F.col(opened))).cast("decimal(38,0)")).cast("double")
    return df.groupBy(category).agg(F.count(F.lit(1)).alias("open_rows"), F.round(total / F.count(F.lit(1)) / 3_600_000_000, 4).alias("avg_hours_open"))


def case_rate(base: DataFrame, cases: DataFrame, base_key: str, group: str, case_key: str, more_than: int = 10, top: int | None = None) -> DataFrame:
    """Cases per base row and group; groups with more than ``more_than`` base rows, all or those of the highest rates.

    Cases are counted per base row before the join, so a base row with many cases is still one row.
    """
    per = cases.groupBy(F.col(case_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    rows = base.join(per, F.col(base_key) == F.col("_k"), "left")
    out = rows.groupBy(group).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("case_count"), F.count(F.lit(1)).alias("base_count"))
    out = out.filter(F.col("base_count") > more_than).withColumn("case_rate", percent(F.col("case_count"), F.col("base_count")))
    return highest(out, [F.desc("case_rate"), F.asc(group)], top)


def category_share(categories: DataFrame, rows: DataFrame, category: str, row_category: str) -> DataFrame:
    """Share of each category, categories without rows included."""
    counts = rows.groupBy(F.col(row_category).alias("_c")).agg(F.count(F.lit(1)).alias("row_count"))
    out = categories.join(counts, F.col(category) == F.col("_c"), "left").fillna(0, ["row_count"]).drop("_c")
    return percent_of_total(out, "row_count")


def category_trend(df: DataFrame, ts: str, category: str) -> DataFrame:
    """Rows by month and category."""
    return df.groupBy(month_text(F.col(ts)).alias("month"), category).agg(F.count(F.lit(1)).alias("row_count"))


def first_response(opened: DataFrame, replies: DataFrame, key: str, opened_at: str, reply_at: str, agent: str, tie: str) -> DataFrame:
    """The first reply of each case, who gave it and the hours it took."""
    first = latest_per_key(replies, [key], [F.col(reply_at).asc(), F.col(tie).asc()]).select(key, F.col(reply_at).alias("_at"), F.col(agent).alias("_agent"))
    out = opened.join(first, key)
    hours = hours_between(F.col(opened_at), F.col("_at"))
    return out.select(key, opened_at, F.col("_at").alias("first_response_at"), F.col("_agent").alias("agent"), F.round(hours, 4).alias("response_hours"))


def response_by_agent(first: DataFrame, opened_at: str) -> DataFrame:
    """Cases and mean response time per agent."""
    total = F.sum((micros(F.col("first_response_at")) - micros(F.col(opened_at))).cast("decimal(38,0)")).cast("double")
    return first.groupBy("agent").agg(F.count(F.lit(1)).alias("handled"), F.round(total / F.count(F.lit(1)) / 3_600_000_000, 4).alias("avg_response_hours"))


# ---- status, services, errors -----------------------------------------------------------------------------------


def status_rates(df: DataFrame, keys: Sequence[str], status: str, labels: Mapping[str, str], success: str) -> DataFrame:
    """Total, rows per status and success percent per group."""
    total = F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        total.alias("total"), *label_counts(status, labels), percent(count_if(F.col(status) == labels[success]), total).alias("success_pct")
    )


def failures_only(rates: DataFrame, failed: str) -> DataFrame:
    """Groups with at least one failure."""
    return rates.filter(F.col(failed) > 0)


def service_health(services: Mapping[str, tuple[DataFrame, str, Column, Column | None]]) -> DataFrame:
    """One row per service: items processed, ok, failed and mean minutes.

    ``services`` maps a name to (table, id column, ok condition, duration in microseconds or None).
    """
    parts = []
    for name, (df, key, ok, duration) in services.items():
        spent = F.lit(None).cast("bigint") if duration is None else duration
        per = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
            F.max(ok).alias("ok"), F.max(~ok).alias("bad"), F.sum(spent.cast("decimal(38,0)")).alias("spent"), F.count(spent).alias("timed")
        )
        minutes = F.round(F.try_divide(F.sum("spent").cast("double"), F.sum("timed")) / 60_000_000, 4)
        parts.append(
            per.agg(
                F.count(F.lit(1)).alias("total_processed"), count_if(F.col("ok")).alias("successful"), count_if(F.col("bad")).alias("failed"), minutes.alias("avg_minutes")
            ).withColumn("service", F.lit(name))
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def json_key_stats(df: DataFrame, json: str, path: str, score: str, top: int | None = None) -> DataFrame:
    """Rows and mean score per value of a JSON field, all or those of the highest mean. Rows without the field are left out."""
    rows = df.select(F.get_json_object(json, path).alias("json_value"), score).filter("json_value IS NOT NULL")
    out = rows.groupBy("json_value").agg(F.count(F.lit(1)).alias("row_count"), mean(F.col(score)).alias("avg_score"))
    return highest(out, [F.desc("avg_score"), F.asc("json_value")], top)


def error_rollup(df: DataFrame, key: str, kind: str, kinds: Sequence[str], more_than: int = 1) -> DataFrame:
    """Entities with several errors and those of the known ``kinds`` that they have; ``error_kinds`` has all kinds as rows."""
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("error_count"), codes_present(F.col(kind), kinds)[0].alias("error_types"))
    return out.filter(F.col("error_count") > more_than)


def error_kinds(df: DataFrame, key: str, kind: str) -> DataFrame:
    """A row per entity and kind of error, however many kinds there are."""
    return df.groupBy(key, kind).agg(F.count(F.lit(1)).alias("error_count"))


def token_cost(df: DataFrame, model: str, inputs: str, outputs: str, input_price: float = 0.03, output_price: float = 0.06) -> DataFrame:
    """Cost per model from token sums and prices per thousand tokens."""
    out = df.groupBy(model).agg(F.sum(inputs).alias("input_tokens"), F.sum(outputs).alias("output_tokens"))
    a = F.col("input_tokens").cast("double") / 1000.0 * input_price
    b = F.col("output_tokens").cast("double") / 1000.0 * output_price
    return out.select(model, "input_tokens", "output_tokens", F.round(a, 4).alias("input_cost"), F.round(b, 4).alias("output_cost"), F.round(a + b, 4).alias("total_cost"))


def mean_hours(start: Column, end: Column) -> Column:
    spans = (micros(end) - micros(start)).cast("decimal(38,0)")
    return F.round(F.try_divide(F.sum(spans).cast("double"), F.count(spans)) / 3_600_000_000, 4)


def review_times(df: DataFrame, keys: Sequence[str], ready: str, assigned: str, completed: str) -> DataFrame:
    """Finished reviews with mean hours in queue, at work and in total."""
    done = df.filter(F.col(completed).isNotNull() & F.col(assigned).isNotNull())
    return done.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("reviews"), mean_hours(F.col(ready), F.col(assigned)).alias("queue_hours"),
        mean_hours(F.col(assigned), F.col(completed)).alias("work_hours"), mean_hours(F.col(ready), F.col(completed)).alias("total_hours"),
    )


def feature_adoption(codes: DataFrame, features: DataFrame, entities: DataFrame, code: str, feature_code: str, enabled: Column) -> DataFrame:
    """Per feature the enabled rows and their percent of all entities; features nobody uses included."""
    counts = features.filter(enabled).groupBy(F.col(feature_code).alias("_c")).agg(F.count(F.lit(1)).alias("enabled"))
    total = entities.agg(F.count(F.lit(1)).alias("_all"))
    out = codes.join(counts, F.col(code) == F.col("_c"), "left").fillna(0, ["enabled"]).drop("_c")
    return with_figures(out, total).withColumn("adoption_pct", percent(F.col("enabled"), F.col("_all"))).drop("_all")


def feature_churn(events: DataFrame, code: str, entity: str, disabled: Column, ts: str, days: int, as_of: str) -> DataFrame:
    """Entities that disabled each feature in the last days."""
    recent = events.filter(disabled & (F.col(ts) > moment(as_of) - F.expr(f"INTERVAL {days} DAYS")))
    return recent.groupBy(code).agg(F.count_distinct(entity).alias("entities_disabled"))


def ab_compare(df: DataFrame, key: str, flagged: DataFrame, start: str, end: str, a_name: str, b_name: str) -> DataFrame:
    """Rows and mean minutes of entities with a flag against those without."""
    side = flagged.select(key).distinct().withColumn("_f", F.lit(True))
    out = df.join(side, key, "left")
    label = F.when(F.col("_f"), a_name).otherwise(b_name).alias("arm")
    spans = (micros(F.col(end)) - micros(F.col(start))).cast("decimal(38,0)")
    return out.groupBy(label).agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.try_divide(F.sum(spans).cast("double"), F.count(spans)) / 60_000_000, 4).alias("avg_minutes")
    )


def table_inventory(df: DataFrame, group: str, rows: str, size: str, name: str, top: int | None = None) -> DataFrame:
    """Tables, all or the largest, with their share of the total size."""
    total = df.agg(F.sum(size).alias("_total"))
    out = highest(df, [F.desc(size), F.desc(rows), F.asc(name)], top)
    return with_figures(out, total).withColumn("size_pct", percent(F.col(size), F.col("_total"))).drop("_total")


def inventory_totals(df: DataFrame, group: str, rows: str, size: str) -> DataFrame:
    """Tables, rows and size per catalog."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("tables"), F.sum(rows).alias("total_rows"), F.sum(size).alias("total_size"))


def activity_status(df: DataFrame, last_run: str, as_of: str, idle_days: int = 90) -> DataFrame:
    """Active, Inactive or Never Run by the last run."""
    edge = moment(as_of) - F.expr(f"INTERVAL {idle_days} DAYS")
    return df.withColumn("activity", first_match([(F.col(last_run).isNull(), "Never Run"), (F.col(last_run) > edge, "Active")], "Inactive"))


def conversion_rate(df: DataFrame, key: str, child: DataFrame, child_key: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows with a match in a child table. Child keys are distinct first, so matches do not repeat rows."""
    hit = child.select(F.col(child_key).alias("_k")).distinct()
    rows = df.join(hit, F.col(key) == F.col("_k"), "left")
    total, done = F.count(F.lit(1)), F.count("_k")
    return rows.groupBy(*by).agg(total.alias("total"), done.alias("converted"), percent(done, total).alias("conversion_pct"))


def overdue(df: DataFrame, last_run: str, interval_minutes: str, as_of: str, factor: int = 2) -> DataFrame:
    """Rows whose last run is older than ``factor`` times their own interval."""
    age = micros(moment(as_of)) - micros(F.col(last_run))
    late = age > F.col(interval_minutes).cast("bigint") * factor * 60_000_000
    return df.filter(late).withColumn("minutes_since", F.round(age.cast("double") / 60_000_000, 4))


def expired(df: DataFrame, created: str, incomplete: Column, hours: int, as_of: str) -> DataFrame:
    """Incomplete rows older than a limit, with their age in hours."""
    old = incomplete & (F.col(created) < moment(as_of) - F.expr(f"INTERVAL {hours} HOURS"))
    return df.filter(old).withColumn("age_hours", F.round(hours_between(F.col(created), moment(as_of)), 4))


# Score tiers, stability and sufficiency ratings
RISK_TIERS = [(20, "Very Low (0-20)"), (40, "Low (21-40)"), (60, "Medium (41-60)"), (80, "High (61-80)")]
CONFIDENCE_TIERS = [(90, "High (90-100)"), (70, "Medium (70-89)"), (50, "Low (50-69)")]
STABILITY = [(0.8, "Mostly Consistent"), (0.5, "Some Gaps")]
SUFFICIENCY = [(10000, "Excellent (6+ months)"), (5000, "Good (3-6 months)"), (3000, "Borderline (2-3 months)")]


def risk_tier(score: Column) -> Column:
    return first_match([(score <= top, label) for top, label in RISK_TIERS], "Very High (81-100)")


def confidence_tier(score: Column) -> Column:
    return first_match([(score >= low, label) for low, label in CONFIDENCE_TIERS], "Very Low (<50)")


def score_tiers(df: DataFrame, score: str, tier: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows and mean score per tier (and further columns)."""
    rows = df.filter(F.col(score).isNotNull())
    return rows.groupBy(*by, tier.alias("tier")).agg(F.count(F.lit(1)).alias("row_count"), mean(F.col(score)).alias("avg_score"))


def version_compare(df: DataFrame, keys: Sequence[str], score: str, ts: str, success: Column | None = None) -> DataFrame:
    """Rows, mean score, first and last use per version, and the success percent."""
    aggs = [F.count(F.lit(1)).alias("row_count"), mean(F.col(score)).alias("avg_score"), F.min(ts).alias("first_used"), F.max(ts).alias("last_used")]
    if success is not None:
        aggs.append(percent(count_if(success), F.count(F.lit(1))).alias("success_pct"))
    return df.groupBy(*keys).agg(*aggs)


def queue_stats(df: DataFrame, queue: str, state: str, created: str, states: Sequence[str]) -> DataFrame:
    """Jobs by queue and state with the oldest one."""
    return df.filter(F.col(state).isin(*states)).groupBy(queue, state).agg(F.count(F.lit(1)).alias("job_count"), F.min(created).alias("oldest"))


def worker_stats(df: DataFrame, worker: str, state: str, completed: str, discarded: str, start: str, end: str) -> DataFrame:
    """Totals, completed, failed and mean seconds per worker."""
    spans = (micros(F.col(end)) - micros(F.col(start))).cast("decimal(38,0)")
    return df.groupBy(worker).agg(
        F.count(F.lit(1)).alias("total_jobs"), count_if(F.col(state) == completed).alias("completed"), count_if(F.col(state) == discarded).alias("failed"),
        F.round(F.try_divide(F.sum(spans).cast("double"), F.count(spans)) / 1_000_000, 4).alias("avg_seconds"),
    )


def repeated_failures(df: DataFrame, state: Column, attempts: str, errors: str, at_least: int = 5) -> DataFrame:
    """Jobs that failed often, with the last entry of their error list."""
    return df.filter(state & (F.col(attempts) >= at_least)).withColumn("last_error", F.try_element_at(errors, F.lit(-1)))


def waiting_by_priority(df: DataFrame, waiting: Column, priority: str, created: str, as_of: str) -> DataFrame:
    """Waiting jobs with a negative (urgent) priority and how long they have waited."""
    out = df.filter(waiting & (F.col(priority) < 0))
    return out.withColumn("waiting_hours", F.round(hours_between(F.col(created), moment(as_of)), 4))


def consistency_rating(df: DataFrame, part: str, total: str) -> DataFrame:
    """Share of consecutive in total days and its rating; NULL shares (no days) rate as inconsistent."""
    share = F.try_divide(F.col(part).cast("double"), F.col(total).cast("double"))
    rules: list[Rule] = [(F.col(part) == F.col(total), "Consistent"), *[(share >= low, label) for low, label in STABILITY]]
    return df.withColumn("consistency_pct", F.round(share * 100, 2)).withColumn("stability", first_match(rules, "Inconsistent"))


def sufficiency_rating(amount: Column) -> Column:
    """Rating of verified assets by amount."""
    return first_match([(amount >= low, label) for low, label in SUFFICIENCY], "Insufficient (<2 months)")


def amount_by_source(df: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Documents, total and mean amount per source."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("documents"), F.sum(amount).cast("double").alias("total_amount"), mean(F.col(amount)).alias("avg_amount"))


def exposure_metrics(items: DataFrame, views: DataFrame, item: str, view_item: str, user: str, published: str, viewed: str) -> DataFrame:
    """Views, distinct users and mean hours to view per item; items nobody saw stay with zeros.

    Views are reduced to one row per item (sums of view times), then joined to the items.
    """
    per = views.groupBy(F.col(view_item).alias("_i")).agg(
        F.count(F.lit(1)).alias("views"), F.count_distinct(user).alias("unique_users"), F.sum(micros(F.col(viewed)).cast("decimal(38,0)")).alias("_at")
    )
    out = items.join(per, F.col(item) == F.col("_i"), "left").fillna(0, ["views", "unique_users"])
    total = F.col("_at") - micros(F.col(published)).cast("decimal(38,0)") * F.col("views")
    hours = F.round(F.try_divide(total.cast("double"), F.col("views").cast("double")) / 3_600_000_000, 4)
    return out.withColumn("avg_hours_to_view", hours).drop("_i", "_at")


def coverage_per_role(roles: DataFrame, role: str, assigned: DataFrame, assigned_role: str, item: str, active: Column) -> DataFrame:
    """Distinct active items per role, roles without any included."""
    counts = assigned.filter(active).groupBy(F.col(assigned_role).alias("_r")).agg(F.count_distinct(item).alias("active_items"))
    return roles.join(counts, F.col(role) == F.col("_r"), "left").fillna(0, ["active_items"]).drop("_r")


def integration_status(
    entities: DataFrame, key: str, integrations: DataFrame, activity: DataFrame, activity_key: str, ts: str, result: str, labels: Mapping[str, str],
    days: int, as_of: str,
) -> DataFrame:
    """Per entity: active or not, hours since the last run, and volumes of the last days by result.

    ``integrations`` has columns (key, ended_at, last_run). Each child is one row per entity before it is joined.
    """
    recent = activity.filter(F.col(ts) > moment(as_of) - F.expr(f"INTERVAL {days} DAYS"))
    volumes = recent.groupBy(F.col(activity_key).alias(key)).agg(F.count(F.lit(1)).alias("total_entries"), *label_counts(result, labels))
    links = integrations.select(key, "ended_at", "last_run", F.lit(True).alias("_i"))
    out = entities.join(links, key, "left").join(volumes, key, "left").fillna(0, ["total_entries", *labels])
    state = first_match([(F.col("_i").isNull(), "None"), (F.col("ended_at").isNull(), "Active")], "Inactive")
    hours = F.round(hours_between(F.col("last_run"), moment(as_of)), 4)
    return out.withColumn("integration_status", state).withColumn("hours_since_run", hours).drop("_i", "ended_at")


