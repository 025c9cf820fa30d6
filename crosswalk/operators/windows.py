"""Order-dependent columns, top rows and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosswalk.functions.columns import first_match, ordered_label, percent
from crosswalk.functions.scale import carried, group_stats, join_back, latest_per_key, pieces, running_total, with_figures

# What stands in for a missing time, and the labels of series members
LONG_AGO = "1900-01-01 00:00:00"
OLD_ACTIVE, OLD_INACTIVE, LATEST, UNKNOWN = "Old Still Active", "Old Inactive", "Latest", "Unknown"

__all__ = ["latest_per_key"]  # W1 is latest_per_key itself


def latest_by_greatest(df: DataFrame, keys: Sequence[str], times: Sequence[str], tie: Sequence[Column]) -> DataFrame:
    """Newest row per key by the greatest of several times; a missing time counts as long ago."""
    newest = F.greatest(*[F.coalesce(F.col(t), F.lit(LONG_AGO).cast("timestamp_ntz")) for t in times])
    return latest_per_key(df.withColumn("_newest", newest), keys, [F.col("_newest").desc(), *tie]).drop("_newest")


def rank_keep_ties(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All rows equal to the best (largest, not NULL) value of their key.

    A maximum per key joined back, rather than RANK, so that a key with very many rows is not sorted by one task.
    """
    return group_stats(df, keys, _best=F.max(order)).filter(F.col(order) == F.col("_best")).drop("_best")


def running_copy_number(df: DataFrame, keys: Sequence[str], order: str, name: str = "copy_number", rows: int | None = None) -> DataFrame:
    """Running count per key in descending ``order``, rows with equal order counted together (default frame).

    Counts per (key, order value) are taken first; the running sum over a key's distinct order values is taken in pieces of
    bounded size and carried over them. Rows with a NULL key are not copies of each other: each gets 1.
    """
    counts = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_n"))
    cells = pieces(counts, keys, [order], F.lit(0), rows, descending=True)
    parts = [*keys, "_bucket", "_cell"]
    inside = F.sum("_n").over(Window.partitionBy(*parts).orderBy(F.col(order).desc_nulls_last()))
    running = cells.withColumn("_inside", inside).join(carried(cells, keys, {"_before": F.col("_n")}), parts)
    known = df.withColumn("_order", F.coalesce(F.col(order).cast("string"), F.lit("\u0000")))
    order_text = F.coalesce(F.col(order).cast("string"), F.lit("\u0000")).alias("_order")
    running = running.select(*keys, order_text, "_n", (F.col("_inside") + F.col("_before")).alias(name))
    out = join_back(known, running, [*keys, "_order"], "_n", "left")
    return out.withColumn(name, F.coalesce(name, F.lit(1))).select(*df.columns, name)


def series_status(df: DataFrame, group: str, number: str, active: Column) -> DataFrame:
    """Largest number and size of each series; older members still active, older inactive, or latest."""
    out = group_stats(df.filter(F.col(group) != ""), [group], size="series_size", max_number=F.max(number))
    older = F.col(number) < F.col("max_number")
    label = first_match(
        [
            (older & active, OLD_ACTIVE),
            (older & ~active, OLD_INACTIVE),
            (F.col(number) == F.col("max_number"), LATEST),
        ],
        UNKNOWN,
    )
    return out.filter("series_size > 1").withColumn("series_status", label)


def series_metrics(members: DataFrame, status: DataFrame, key: str) -> DataFrame:
    """Members, members of multi-part series, old ones still active and old inactive ones, one row each."""
    named = members.agg(F.count_distinct(key).alias("n0"))
    rest = status.agg(
        F.count_distinct(key).alias("n1"),
        F.count_distinct(F.when(F.col("series_status") == OLD_ACTIVE, F.col(key))).alias("n2"),
        F.count_distinct(F.when(F.col("series_status") == OLD_INACTIVE, F.col(key))).alias("n3"),
    )
    labels = ["Named in a series", "In series of two or more", "Old still active", "Old inactive"]
    rows = F.array(*[F.struct(F.lit(t).alias("metric"), F.col(f"n{i}").alias("row_count")) for i, t in enumerate(labels)])
    return with_figures(named, rest).select(F.inline(rows))


def series_to_drop(status: DataFrame, key: str) -> DataFrame:
    """Ids of members replaced by a later one."""
    return status.filter(F.col("series_status").isin(OLD_ACTIVE, OLD_INACTIVE)).select(key).distinct()


def percent_of_total(counts: DataFrame, value: str, name: str = "percentage", digits: int = 2) -> DataFrame:
    """Share of each row of a small aggregate in its total (the total is a scalar subquery)."""
    total = counts.agg(F.sum(value).alias("_total"))
    return with_figures(counts, total).withColumn(name, percent(F.col(value), F.col("_total"), digits)).drop("_total")


def rank_of(df: DataFrame, key: str, value: str, chosen: DataFrame) -> DataFrame:
    """Global rank by descending ``value`` of the chosen keys, and how many rows there are.

    Ranks come from running totals over distinct values, not from one ordered partition holding all rows.
    """
    run = running_total(df, [], value).withColumnRenamed("total", "total_rows")
    above = F.col("total_rows") - F.col("before") - F.col("weight")
    ranks = run.select(value, "weight", (above + 1).alias("rank"), "total_rows")
    rows = df.join(chosen.select(key).distinct(), key, "left_semi").select(key, value)
    return join_back(rows, ranks, [value], "weight", "inner").drop("weight")


def newest_in_group(df: DataFrame, keys: Sequence[str], ts: str, name: str = "is_newest") -> DataFrame:
    """Marks rows whose time equals the newest of their group."""
    out = group_stats(df, keys, size="group_size", _newest=F.max(ts))
    return out.withColumn(name, F.coalesce(F.col(ts) == F.col("_newest"), F.lit(False))).drop("_newest")


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Ordered limit; every task keeps n rows, so no global sort. End ``order`` with a unique column."""
    return df.orderBy(*order).limit(n)


def custom_order(df: DataFrame, column: str, order: Sequence[str], name: str = "sort_order") -> DataFrame:
    """Rows sorted by a fixed label order, with the position kept as a column."""
    return df.withColumn(name, ordered_label(F.col(column), order)).orderBy(name)


def sample_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """A repeatable handful of rows: the first n by key."""
    return df.orderBy(key).limit(n)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stacked rows, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Stacked rows without copies."""
    return union_all(frames).distinct()


def difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a without a partner in b. NULL keys have no partner.

    The keys of b are made distinct first: copies of a frequent key are dropped before the shuffle.
    """
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


def intersection(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a with a partner in b."""
    return a.join(b.select(*keys).distinct(), list(keys), "left_semi")
