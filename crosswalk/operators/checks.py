"""Expectations, parity, comparison, impact and quality checks.

Figures over one table come from one aggregate that is then turned into rows, not from one scan per figure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.functions.columns import all_of, any_of, count_if, first_match, norm_value, percent
from crosswalk.functions.scale import distinct_rows, highest, highest_per_key, with_figures
from crosswalk.session import cut_in_turn


def expect(df: DataFrame, drop: Mapping[str, Column]) -> DataFrame:
    """M1: rows for which every ``drop`` rule is true; a NULL result is not true."""
    return df.filter(all_of([F.coalesce(c, F.lit(False)) for c in drop.values()])) if drop else df


def expectation_counts(df: DataFrame, warn: Mapping[str, Column], drop: Mapping[str, Column]) -> DataFrame:
    """M1: rows passing and failing each rule, one row per rule, from one aggregate."""
    rules = [(n, c, "warn") for n, c in warn.items()] + [(n, c, "drop") for n, c in drop.items()]
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[count_if(F.coalesce(c, F.lit(False))).alias(f"_p{i}") for i, (_, c, _) in enumerate(rules)])
    rows = [
        F.struct(F.lit(n).alias("rule"), F.lit(a).alias("action"), F.col(f"_p{i}").alias("passed"), (F.col("_n") - F.col(f"_p{i}")).alias("failed"))
        for i, (n, _, a) in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*rows)))


def table_summary(df: DataFrame, distinct: Mapping[str, str], ts: str) -> DataFrame:
    """M2: rows, distinct ids, earliest and latest time. The few columns are stored, and each id's distinct values compared on their own."""
    stored = cut_in_turn([df.select(F.col(ts).alias("_ts"), *[F.col(c).alias(n) for n, c in distinct.items()])], "summary")
    out = stored.agg(F.count(F.lit(1)).alias("total_rows"), F.min("_ts").alias("earliest"), F.max("_ts").alias("latest"))
    for n in distinct:
        out = with_figures(out, distinct_rows(stored.select(n).filter(F.col(n).isNotNull())).agg(F.count(F.lit(1)).alias(n)))
    return out.select("total_rows", *distinct, "earliest", "latest")


def compare_fields(a: DataFrame, b: DataFrame, a_key: str, b_key: str, mapping: Mapping[str, str], kinds: Mapping[str, str] | None = None) -> DataFrame:
    """M7: one row per key and field: both normalised values and whether they are the same; keys of one side marked.

    ``mapping`` maps fields of a to fields of b; ``kinds`` gives text (default), bool or date by a's field name.
    Each side is one row per key before the join. Where a key repeats, a field is the same if all its values on both
    sides are; if not, two that differ are shown. Rows with a NULL key match nothing: one row per field and side.
    """
    kinds = kinds or {}

    def side(df: DataFrame, name: str, key: str, columns: Sequence[str]) -> DataFrame:
        values = [F.struct(norm_value(F.col(c), kinds.get(x, "text")).alias("v")) for c, x in zip(columns, mapping)]
        ends = [f(v).alias(f"_{name}{n}_{end}") for n, v in enumerate(values) for end, f in (("low", F.min), ("high", F.max))]
        return df.groupBy(F.col(key).cast("string").alias(f"_{name}")).agg(F.count(F.lit(1)).alias(f"_{name}_rows"), *ends)

    both = side(a, "a", a_key, list(mapping)).join(side(b, "b", b_key, list(mapping.values())), F.col("_a") == F.col("_b"), "full_outer")
    where = F.when(F.col("_b_rows").isNull(), "only in a").when(F.col("_a_rows").isNull(), "only in b").otherwise("both")
    fields = []
    for n, x in enumerate(mapping):
        a_low, a_high, b_low, b_high = [F.col(f"_{s}{n}_{end}.v") for s in "ab" for end in ("low", "high")]
        below = ~a_low.eqNullSafe(b_high)
        a_value, b_value = F.when(below, a_low).otherwise(a_high), F.when(below, b_high).otherwise(b_low)
        fields.append(F.struct(F.lit(x).alias("field"), a_value.alias("a_value"), b_value.alias("b_value"), a_value.eqNullSafe(b_value).alias("same")))
    return both.select(F.coalesce("_a", "_b").alias("key"), where.alias("found_in"), F.inline(F.array(*fields)))


def field_mismatches(compared: DataFrame) -> DataFrame:
    """M7: differing values of keys that both sides have."""
    return compared.filter("found_in = 'both' AND NOT same").select("key", "field", "a_value", "b_value")


def compare_summary(compared: DataFrame, fields: int) -> DataFrame:
    """M7: identical records, records with differences, and records of one side only."""
    per = compared.groupBy("key", "found_in").agg(count_if(F.col("same")).alias("_same"))
    both = F.col("found_in") == "both"
    return per.agg(
        count_if(both & (F.col("_same") == fields)).alias("identical"), count_if(both & (F.col("_same") < fields)).alias("different"),
        count_if(F.col("found_in") == "only in a").alias("only_in_a"), count_if(F.col("found_in") == "only in b").alias("only_in_b"),
    )


def dataset_profile(df: DataFrame, distinct: Sequence[str], nulls: Sequence[str], ts: str | None, patterns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """M8: (check, value) rows for one data set from one aggregate: rows, distinct and null counts, first and last day
    (as yyyymmdd) and number of days, pattern leakage."""
    figures: dict[str, Column] = {"rows": F.count(F.lit(1))}
    figures |= {f"distinct {c}": F.count_distinct(c) for c in distinct}
    figures |= {f"null {c}": count_if(F.col(c).isNull()) for c in nulls}
    if ts:
        day = F.date_format(ts, "yyyyMMdd").cast("bigint")
        figures |= {"first day": F.min(day), "last day": F.max(day), "distinct days": F.count_distinct(day)}
    for c, likes in (patterns or {}).items():
        figures[f"leaked {c}"] = count_if(any_of([F.upper(c).like(p) for p in likes]))
    one = df.agg(*[v.cast("bigint").alias(f"_{i}") for i, v in enumerate(figures.values())])
    rows = [F.struct(F.lit(n).alias("check_name"), F.col(f"_{i}").alias("value")) for i, n in enumerate(figures)]
    return one.select(F.inline(F.array(*rows)))


def dataset_parity(a: DataFrame, b: DataFrame, distinct: Sequence[str], nulls: Sequence[str], ts: str | None, patterns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """M8: the profiles of two data sets side by side with difference and percent of a."""
    left = dataset_profile(a, distinct, nulls, ts, patterns).withColumnRenamed("value", "a_value")
    right = dataset_profile(b, distinct, nulls, ts, patterns).withColumnRenamed("value", "b_value")
    out = left.join(right, "check_name")
    return out.withColumn("difference", F.col("b_value") - F.col("a_value")).withColumn("b_pct_of_a", percent(F.col("b_value"), F.col("a_value")))


def column_fill(df: DataFrame) -> DataFrame:
    """One row per column: type and number of filled rows, from one aggregate."""
    one = df.agg(*[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type"), F.col(f"_{i}").alias("filled")) for i, (c, t) in enumerate(df.dtypes)]
    return one.select(F.inline(F.array(*rows)))


def schema_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """M8: columns of either side with type and filled rows on each, and whether the types agree."""
    left = column_fill(a).withColumnsRenamed({"type": "a_type", "filled": "a_filled"})
    right = column_fill(b).withColumnsRenamed({"type": "b_type", "filled": "b_filled"})
    status = first_match(
        [(F.col("b_type").isNull(), "only in a"), (F.col("a_type").isNull(), "only in b"), (F.col("a_type") == F.col("b_type"), "same")], "type differs"
    )
    return left.join(right, "column_name", "full_outer").withColumn("status", status)


def sample_lookup(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str], n: int | None = None) -> DataFrame:
    """M8: keys of a with their values on both sides; with ``n`` the first ones, as a spot check a person can read."""
    picked = a.select(key, *[F.col(c).alias(f"a_{c}") for c in columns])
    picked = highest(picked, [F.col(key)], n)
    other = b.select(key, F.lit(True).alias("in_b"), *[F.col(c).alias(f"b_{c}") for c in columns])
    return picked.join(other, key, "left").fillna(False, ["in_b"])


def key_differences(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """M8: keys missing on one side and keys whose values differ; keys must be unique on each side."""
    left = a.select(*keys, F.struct(*columns).alias("_a"))
    right = b.select(*keys, F.struct(*columns).alias("_b"))
    out = left.join(right, list(keys), "full_outer")
    kind = first_match(
        [(F.col("_b").isNull(), "missing in b"), (F.col("_a").isNull(), "missing in a"), (~F.col("_a").eqNullSafe(F.col("_b")), "values differ")]
    )
    return out.select(*keys, kind.alias("difference")).filter("difference IS NOT NULL")


def assertions(figures: DataFrame, tests: Sequence[tuple[str, Column, Column, int]]) -> DataFrame:
    """M9: one row (test, expected, actual, pass) per test, from one row of figures; the last entry is a tolerance."""
    rows = [
        F.struct(
            F.lit(name).alias("test"), expected.cast("bigint").alias("expected"), actual.cast("bigint").alias("actual"),
            (F.abs(expected - actual) <= tolerance).alias("pass"),
        )
        for name, expected, actual, tolerance in tests
    ]
    return figures.select(F.inline(F.array(*rows)))


def sync_quality_suite(
    rows: DataFrame, agg: DataFrame, creates: DataFrame, updates: DataFrame, key: str, flag: str, flag_at: str, active: Column, tolerance: int = 50
) -> DataFrame:
    """M9: the aggregation keeps all keys, any-flag logic holds, queues cover all keys, no inactive row, earliest time.

    The flag and time tests run over every key, not over one example.
    """
    per = rows.filter(active).groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.coalesce(F.max(flag), F.lit(False)).alias("_flag"), F.min(flag_at).alias("_at")
    )
    got = agg.select(F.col(key).alias("_k"), F.col(flag).alias("_got_flag"), F.col(f"{flag}_at").alias("_got_at"), "active_count")
    both = per.join(got, F.col(key) == F.col("_k"), "full_outer")
    figures = both.agg(
        F.count(key).alias("keys"), F.count("_k").alias("kept"), F.coalesce(F.sum("_n"), F.lit(0)).alias("active"), F.coalesce(F.sum("active_count"), F.lit(0)).alias("summed"),
        count_if(~F.col("_flag").eqNullSafe(F.col("_got_flag"))).alias("bad_flag"), count_if(~F.col("_at").eqNullSafe(F.col("_got_at"))).alias("bad_time"),
    )
    for name, queue in (("creates", creates), ("updates", updates)):
        figures = with_figures(figures, queue.agg(F.count(F.lit(1)).alias(name)))
    zero = F.lit(0)
    return assertions(figures, [
        ("aggregation keeps all keys", F.col("keys"), F.col("kept"), 0), ("any flag gives true", zero, F.col("bad_flag"), 0),
        ("create and update cover all keys", F.col("kept"), F.col("creates") + F.col("updates"), tolerance), ("earliest time kept", zero, F.col("bad_time"), 0),
        ("no inactive row aggregated", F.col("active"), F.col("summed"), 0),
    ])


def quality_tile(df: DataFrame, required: str, others: Sequence[str], good: float = 90, excellent: float = 95) -> DataFrame:
    """Null counts, percent with the required field, and a band."""
    total = F.count(F.lit(1))
    pct = percent(F.count(required), total)
    out = df.agg(total.alias("total"), *[count_if(F.col(c).isNull()).alias(f"null_{c}") for c in [required, *others]], pct.alias("quality_pct"))
    band = first_match([(F.col("quality_pct") >= excellent, "Excellent"), (F.col("quality_pct") >= good, "Good")], "Poor")
    return out.withColumn("quality_status", band)


def missing_fields(df: DataFrame, required: Sequence[str], high: int = 100, moderate: int = 50) -> DataFrame:
    """Rows missing any required field (blank text counts as missing), per field, with a severity."""
    gone = {c: blank(c) for c in required}
    rows = df.filter(any_of(list(gone.values())))
    out = rows.agg(F.count(F.lit(1)).alias("rows_with_issues"), *[count_if(m).alias(f"missing_{c}") for c, m in gone.items()])
    level = first_match([(F.col("rows_with_issues") > high, "High"), (F.col("rows_with_issues") > moderate, "Moderate")], "Low")
    return out.withColumn("severity", level)


def blank(column: str) -> Column:
    return F.coalesce(F.trim(F.col(column).cast("string")) == "", F.lit(True))


def missing_patterns(df: DataFrame, required: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Which combination of fields is missing, by source of change."""
    names = F.concat_ws(",", *[F.when(blank(c), F.lit(c)) for c in required])
    return df.filter(names != "").groupBy(names.alias("missing"), *by).agg(F.count(F.lit(1)).alias("row_count"))


def matched(new: DataFrame, cur: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """New and current values side by side for keys both have (keys unique)."""
    left = new.select(key, *[F.col(c).alias(f"n_{c}") for c in columns])
    right = cur.select(key, *[F.col(c).alias(f"c_{c}") for c in columns])
    return left.join(right, key)


def update_impact(new: DataFrame, cur: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows whose value will change, per column, null-aware; one join and one aggregate."""
    changes = {c: ~F.col(f"n_{c}").eqNullSafe(F.col(f"c_{c}")) for c in columns}
    one = matched(new, cur, key, columns).agg(F.count(F.lit(1)).alias("_n"), *[count_if(x).alias(f"_{c}") for c, x in changes.items()])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"_{c}").alias("will_change"), F.col("_n").alias("total_matched"), percent(F.col(f"_{c}"), F.col("_n")).alias("pct_change"))
        for c in columns
    ]
    return one.select(F.inline(F.array(*rows)))


def flag_transitions(new: DataFrame, cur: DataFrame, key: str, flags: Sequence[str]) -> DataFrame:
    """Per flag: changing, turning on, turning off, percent; NULL counts as false."""
    rows = matched(new, cur, key, flags)
    n = {f: F.coalesce(F.col(f"n_{f}"), F.lit(False)) for f in flags}
    c = {f: F.coalesce(F.col(f"c_{f}"), F.lit(False)) for f in flags}
    one = rows.agg(F.count(F.lit(1)).alias("_n"), *[count_if(n[f] & ~c[f]).alias(f"on_{f}") for f in flags], *[count_if(~n[f] & c[f]).alias(f"off_{f}") for f in flags])
    lines = []
    for f in flags:
        change = F.col(f"on_{f}") + F.col(f"off_{f}")
        lines.append(F.struct(
            F.lit(f).alias("flag"), change.alias("will_change"), F.col(f"on_{f}").alias("turning_on"), F.col(f"off_{f}").alias("turning_off"),
            F.col("_n").alias("total_matched"), percent(change, F.col("_n"), 1).alias("pct_change"),
        ))
    return one.select(F.inline(F.array(*lines)))


def flag_change_detail(new: DataFrame, cur: DataFrame, key: str, flags: Sequence[str]) -> DataFrame:
    """Rows with at least one change and text ``flag: before -> after`` for each."""
    rows = matched(new, cur, key, flags)
    notes = []
    for f in flags:
        a, b = F.coalesce(F.col(f"c_{f}"), F.lit(False)), F.coalesce(F.col(f"n_{f}"), F.lit(False))
        notes.append(F.when(a != b, F.concat(F.lit(f"{f}: "), a.cast("string"), F.lit(" -> "), b.cast("string"))))
    text = F.concat_ws("; ", *notes)
    return rows.select(key, text.alias("changes")).filter("changes <> ''")


def change_summary(new: DataFrame, cur: DataFrame, key: str, flags: Sequence[str]) -> DataFrame:
    """Matched rows with and without any change."""
    rows = matched(new, cur, key, flags)
    any_change = any_of([F.coalesce(F.col(f"n_{f}"), F.lit(False)) != F.coalesce(F.col(f"c_{f}"), F.lit(False)) for f in flags])
    return rows.agg(F.count(F.lit(1)).alias("total_matched"), count_if(any_change).alias("any_change"), count_if(~any_change).alias("no_change"))


def fix_coverage(mismatch: DataFrame, queue: DataFrame, key: str, flags: Mapping[str, Column]) -> DataFrame:
    """Mismatching rows, how many are queued and the percent to be fixed: overall and per feature."""
    queued = queue.select(key).distinct().withColumn("_q", F.lit(True))
    rows = mismatch.join(queued, key, "left")
    hit = F.col("_q").isNotNull()
    tests = {"all": F.lit(True), **flags}
    one = rows.agg(*[count_if(c).alias(f"m{i}") for i, c in enumerate(tests.values())], *[count_if(c & hit).alias(f"q{i}") for i, c in enumerate(tests.values())])
    lines = [
        F.struct(F.lit(n).alias("feature"), F.col(f"m{i}").alias("mismatches"), F.col(f"q{i}").alias("in_queue"), percent(F.col(f"q{i}"), F.col(f"m{i}")).alias("fix_pct"))
        for i, n in enumerate(tests)
    ]
    return one.select(F.inline(F.array(*lines)))


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Added, removed and changed keys between two snapshots; unchanged ones are left out."""
    left = before.select(key, F.xxhash64(*columns).alias("_ha"), F.struct(*columns).alias("_a"), F.lit(True).alias("_in_a"))
    right = after.select(key, F.xxhash64(*columns).alias("_hb"), F.struct(*columns).alias("_b"), F.lit(True).alias("_in_b"))
    out = left.join(right, key, "full_outer")
    # Equal hashes are confirmed on the values, so a hash collision cannot hide a change.
    differ = (F.col("_ha") != F.col("_hb")) | ~F.col("_a").eqNullSafe(F.col("_b"))
    kind = first_match([(F.col("_in_a").isNull(), "added"), (F.col("_in_b").isNull(), "removed"), (differ, "changed")])
    return out.select(key, kind.alias("change")).filter("change IS NOT NULL")


def snapshot_counts(versions: Mapping[str, DataFrame], deleted: str) -> DataFrame:
    """Rows by deleted flag in each version."""
    parts = [df.groupBy(deleted).agg(F.count(F.lit(1)).alias("row_count")).withColumn("version", F.lit(v)) for v, df in versions.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, rows beyond the first of a key, null keys, repeated values."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = F.col(key).isNotNull()
    return per.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), count_if(known).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(known, F.col("_n") - 1)), F.lit(0)).alias("duplicate_rows"), F.coalesce(F.sum(F.when(~known, F.col("_n"))), F.lit(0)).alias("null_keys"),
        count_if(known & (F.col("_n") > 1)).alias("repeated_values"),
    )


def change_impact(history: DataFrame, measures: Sequence[str], version: str, columns: Sequence[str], top: int | None = None) -> DataFrame:
    """Operations by each measure (rows deleted, rows updated, bytes removed ...), all or the largest of each.

    The history is read once, however many measures there are.
    """
    each = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("bigint").alias("amount")) for m in measures])
    rows = history.select(version, *columns, F.inline(each)).filter("amount > 0")
    return highest_per_key(rows, ["measure"], [F.desc("amount"), F.asc(version)], top).select("measure", version, *columns, "amount")


def operation_totals(history: DataFrame, operation: str, measures: Sequence[str]) -> DataFrame:
    """Operations of each kind and the sums of their measures."""
    return history.groupBy(operation).agg(F.count(F.lit(1)).alias("operations"), *[F.sum(m).alias(f"total_{m}") for m in measures])


def reject_summary(df: DataFrame, status: str, message: str, id_col: str, categories: Sequence[tuple[str, str]], rejected: str) -> DataFrame:
    """Rejected rows by message with category, count and a sample id (the smallest)."""
    kind = first_match([(F.col(message).contains(part), label) for part, label in categories], "Other")
    bad = df.filter(F.col(status) == rejected)
    return bad.groupBy(message, kind.alias("category")).agg(F.count(F.lit(1)).alias("row_count"), F.min(id_col).alias("sample_id"))


def status_counts(df: DataFrame, status: str) -> DataFrame:
    """Rows per status."""
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("row_count"))


def value_source_check(df: DataFrame, value: str, right: str, wrong: str) -> DataFrame:
    """Is a copied value from the right source, still from the wrong one, empty, or something else?"""
    v = F.col(value)
    return df.withColumn("check_status", first_match([(v == F.col(right), "CORRECT"), (v == F.col(wrong), "STILL_BROKEN"), (v.isNull(), "NULL")], "OTHER"))


def value_source_summary(checked: DataFrame, value: str, right: str) -> DataFrame:
    """Rows and percent per status, and how many empty values the right source could fill."""
    counts = checked.groupBy("check_status").agg(F.count(F.lit(1)).alias("row_count"), count_if(F.col(value).isNull() & F.col(right).isNotNull()).alias("fillable"))
    total = counts.agg(F.sum("row_count").alias("_t"))
    return with_figures(counts, total).withColumn("percentage", percent(F.col("row_count"), F.col("_t"))).drop("_t")


def completeness_profile(df: DataFrame, required: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Filled rows per required column, enabled and disabled rows per flag."""
    one = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"f{i}") for i, c in enumerate(required)],
        *[count_if(F.col(c)).alias(f"t{i}") for i, c in enumerate(flags)], *[count_if(~F.col(c)).alias(f"u{i}") for i, c in enumerate(flags)],
    )
    def line(name: str, kind: str, amount: Column) -> Column:
        return F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("kind"), amount.alias("row_count"), percent(amount, F.col("_n")).alias("pct"))

    rows = [line(c, "filled", F.col(f"f{i}")) for i, c in enumerate(required)]
    for i, c in enumerate(flags):
        rows += [line(c, "enabled", F.col(f"t{i}")), line(c, "disabled", F.col(f"u{i}"))]
    return one.select(F.inline(F.array(*rows)))


def sync_result_check(created: DataFrame, source: DataFrame, parents: DataFrame, own_id: str, sync_id: str, parent_id: str, source_id: str, parent_key: str) -> DataFrame:
    """Rows a sync created: ids present, equal to the sync id, linked to the source and to a parent, orphans.

    The source and parent keys are distinct before the joins, so no row is counted twice.
    """
    s = source.select(F.col(source_id).cast("string").alias("_s")).distinct()
    p = parents.select(F.col(parent_key).cast("string").alias("_p")).distinct()
    rows = created.join(s, F.col(own_id).cast("string") == F.col("_s"), "left").join(p, F.col(parent_id).cast("string") == F.col("_p"), "left")
    return rows.agg(
        F.count(F.lit(1)).alias("created"), F.count_distinct(own_id).alias("unique_ids"), count_if(F.col(own_id).isNull()).alias("missing_id"),
        count_if(F.col(sync_id).isNull()).alias("missing_sync_id"), count_if(F.col(own_id) == F.col(sync_id)).alias("matching_ids"),
        F.count("_s").alias("linked_to_source"), F.count("_p").alias("linked_to_parent"), count_if(F.col("_p").isNull()).alias("orphans"),
    )


def multi_case_summary(agg: DataFrame) -> DataFrame:
    """Keys with several rows: how many, rows in them, largest and mean size."""
    multi = agg.filter("is_multi")
    return multi.agg(
        F.count(F.lit(1)).alias("multi_keys"), F.coalesce(F.sum("active_count"), F.lit(0)).alias("rows_in_them"), F.max("active_count").alias("largest"),
        F.round(F.try_divide(F.sum("active_count").cast("double"), F.count(F.lit(1)).cast("double")), 4).alias("mean_size"),
    )


def missing_with_features(creates: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Keys missing in the target that have features, by feature."""
    rows = creates.filter("has_any_flag")
    return rows.agg(F.count(F.lit(1)).alias("with_features"), *[count_if(F.col(f)).alias(f"with_{f}") for f in flags])


def flag_not_copied(agg: DataFrame, target: DataFrame, key: str, target_key: str, flag: str, target_flag: str) -> DataFrame:
    """Keys whose flag is set in the source and not in any live target row."""
    live = target.groupBy(F.col(target_key).alias("_k")).agg(F.coalesce(F.max(target_flag), F.lit(False)).alias("_t"))
    out = agg.filter(F.col(flag)).join(live, F.col(key) == F.col("_k"))
    return out.filter(~F.col("_t")).select(key, flag)
