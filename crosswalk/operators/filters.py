"""Row selection and text rules (F8, F9, F12, F13, F15 build on functions.columns)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.functions.columns import any_of, count_if, first_match, flag_total, keyword_match, moment
from crosswalk.functions.scale import highest

KeywordRule = tuple[str, str, str]  # (kind, pattern, label); kinds as in keyword_match


def exclusion_condition(
    columns: Sequence[str],
    patterns: Sequence[str] = (),
    exact: Sequence[str] = (),
    ids: Mapping[str, Sequence[object]] | None = None,
    exempt: Mapping[str, Sequence[object]] | None = None,
) -> Column:
    """true for rows to leave out: any column LIKE any pattern or equal to an exact text (both ignoring case),
    or a listed id, unless an exempt id. A NULL text is no match, so it never drops a row by itself."""
    tests = [F.upper(c).like(p.upper()) for c in columns for p in patterns]
    tests += [F.upper(c) == e.upper() for c in columns for e in exact]
    tests += [F.col(c).isin(*values) for c, values in (ids or {}).items()]
    spared = any_of([F.col(c).isin(*values) for c, values in (exempt or {}).items()])
    return any_of(tests) & ~spared


def exclusion_filter(df: DataFrame, *args, **kwargs) -> DataFrame:
    """rows that the exclusion condition does not hit."""
    return df.filter(~exclusion_condition(*args, **kwargs))


def valid_records(
    df: DataFrame, parent: str, status: str, key: str, deleted: str = "DELETED", active: str = "ACTIVE", sentinels: Sequence[str] = ()
) -> DataFrame:
    """rows with a parent and a status other than deleted; adds is_active and has_valid_key."""
    good = F.col(key).isNotNull()
    if sentinels:
        good = good & ~F.col(key).isin(*sentinels)
    return (
        df.filter(F.col(parent).isNotNull() & (F.col(status) != deleted))
        .withColumn("is_active", F.coalesce(F.col(status) == active, F.lit(False)))
        .withColumn("has_valid_key", F.coalesce(good, F.lit(False)))
    )


def keyword_label(column: Column, rules: Sequence[KeywordRule], default: str | None = None) -> Column:
    """label of the first text rule that matches."""
    return first_match([(keyword_match(column, kind, p), label) for kind, p, label in rules], default)


def keyword_any(column: Column, rules: Sequence[KeywordRule]) -> Column:
    return any_of([keyword_match(column, kind, p) for kind, p, _ in rules])


def keyword_classifier(df: DataFrame, column: str, rules: Sequence[KeywordRule], default: str, name: str = "detection") -> DataFrame:
    """rows matching any rule, with the label of the first one."""
    return df.filter(keyword_any(F.col(column), rules)).withColumn(name, keyword_label(F.col(column), rules, default))


def keyword_flag(df: DataFrame, key: str, column: str, rules: Sequence[KeywordRule]) -> DataFrame:
    """distinct ids whose text matches any rule."""
    return df.filter(keyword_any(F.col(column), rules)).select(key).distinct()


def keyword_counts(df: DataFrame, column: str, rules: Sequence[KeywordRule], by: Sequence[str] = ()) -> DataFrame:
    """rows per keyword (a row counts under every keyword it matches) and further columns, in one scan."""
    hits = F.array_compact(
        F.array(*[F.when(keyword_match(F.col(column), kind, p), F.lit(label)) for kind, p, label in rules])
    )
    return (
        df.filter(keyword_any(F.col(column), rules))
        .select(*by, F.explode(F.array_distinct(hits)).alias("keyword"))
        .groupBy("keyword", *by)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def suspicion_score(df: DataFrame, signals: Mapping[str, Column], order: Sequence[Column], at_least: int = 2, top: int | None = None) -> DataFrame:
    """sum of 0/1 signals; rows scoring ``at_least``, all of them or the ``top`` highest."""
    marked = df.select("*", *[F.coalesce(c.cast("int"), F.lit(0)).alias(n) for n, c in signals.items()])
    scored = marked.withColumn("suspicion_score", flag_total(list(signals)))
    return highest(scored.filter(F.col("suspicion_score") >= at_least), [F.col("suspicion_score").desc(), *order], top)


def parent_keyword_rollup(
    parents: DataFrame, children: DataFrame, name: str, rules: Sequence[KeywordRule], parent_key: str, child_key: str, active: Column
) -> DataFrame:
    """parents whose name matches a keyword, with their child and active child counts (0 kept)."""
    counts = children.groupBy(F.col(child_key).alias(parent_key)).agg(
        F.count(F.lit(1)).alias("child_count"), count_if(active).alias("active_child_count")
    )
    found = parents.filter(keyword_any(F.col(name), rules))
    return found.join(counts, parent_key, "left").fillna(0, ["child_count", "active_child_count"])


def optional_filter(df: DataFrame, equals: Mapping[str, object] | None = None, between: Mapping[str, tuple[str | None, str | None]] | None = None) -> DataFrame:
    """equality and half-open [start, end) time filters; a parameter of None does not filter.

    The predicate is built from the given parameters only, so it reaches the scan as a plain comparison.
    """
    for column, value in (equals or {}).items():
        if value is not None:
            df = df.filter(F.col(column) == F.lit(value))
    for column, (start, end) in (between or {}).items():
        if start is not None:
            df = df.filter(F.col(column) >= moment(start))
        if end is not None:
            df = df.filter(F.col(column) < moment(end))
    return df


def relative_time(ts: str, n: int, unit: str, as_of: str) -> Column:
    """``last``-n-units condition as a range on the raw column: [as_of - n units, as_of)."""
    return (F.col(ts) >= moment(as_of) - F.expr(f"INTERVAL {n} {unit}")) & (F.col(ts) < moment(as_of))


def today(ts: str, day: str) -> Column:
    """rows of one day as a half-open range, not a cast of the column."""
    return (F.col(ts) >= moment(day)) & (F.col(ts) < moment(day) + F.expr("INTERVAL 1 DAY"))


def before_day(ts: str, day: str) -> Column:
    return F.col(ts) < moment(day)


def allowlist_sample(df: DataFrame, key: str, allowed: DataFrame) -> DataFrame:
    """rows whose key is on the list; a semi join, so a list of any size works and copies do not fan out."""
    return df.join(allowed.select(key).distinct(), key, "left_semi")


def ranked_sample(df: DataFrame, order: Sequence[Column], n: int, priority: Column) -> DataFrame:
    """the first n rows by an ordered list of criteria, with a priority label."""
    return df.withColumn("priority", priority).orderBy(*order).limit(n)


def start_date_estimate(first_use: Column, updated: Column, inserted: Column, enabled: Column) -> Column:
    """first observed use, else the last update of an enabled row, else the creation time of a disabled one."""
    return F.coalesce(first_use, F.when(enabled, updated).otherwise(inserted))


def rollout_sample(df: DataFrame, key: str, salt: str, pct: int) -> DataFrame:
    """F16: a repeatable ``pct`` percent of entities, chosen by a hash of (key, salt) of all rows alike."""
    digest = F.conv(F.substring(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(salt))), 1, 8), 16, 10)
    return df.filter(F.pmod(digest.cast("bigint"), F.lit(100)) < pct)
