"""Leaving out records for stated reasons, with a ledger that accounts for every one of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.functions.columns import any_of, first_match, ordered_label

STEPS = ("Before Filtering", "After Filtering", "Delta (Excluded)")


def exclusion_ledger(sources: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Distinct (id, reason) rows; an id may have several reasons."""
    parts = [df.select(F.col(df.columns[0]).alias(key)).withColumn("reason", F.lit(reason)) for reason, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def survivors(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Rows that are not in the ledger."""
    return df.join(ledger.select(key).distinct(), key, "left_anti")


def ledger_counts(ledger: DataFrame) -> DataFrame:
    """Ids per reason."""
    return ledger.groupBy("reason").agg(F.count(F.lit(1)).alias("excluded"))


def exclusion_waterfall(df: DataFrame, ledger: DataFrame, key: str, parent: str, units: str) -> DataFrame:
    """Entities, parents and units before, after, and the difference, in one pass over the marked rows.

    Rows are merged per entity and parent first, so the distinct counts work on those pairs.
    """
    marked = df.join(ledger.select(key).distinct().withColumn("_out", F.lit(True)), key, "left")
    kept = F.col("_out").isNull()
    per = marked.groupBy(key, parent).agg(F.max(kept).alias("kept"), F.sum(units).alias("u0"), F.sum(F.when(kept, F.col(units))).alias("u1"))
    one = per.agg(
        F.count_distinct(key).alias("e0"), F.count_distinct(F.when(F.col("kept"), F.col(key))).alias("e1"),
        F.count_distinct(parent).alias("p0"), F.count_distinct(F.when(F.col("kept"), F.col(parent))).alias("p1"),
        F.coalesce(F.sum("u0"), F.lit(0)).alias("u0"), F.coalesce(F.sum("u1"), F.lit(0)).alias("u1"),
    )
    def step(n: int, pick) -> Column:
        return F.struct(F.lit(STEPS[n]).alias("step"), *[pick(c).alias(t) for c, t in (("e", "entities"), ("p", "parents"), ("u", "units"))], F.lit(n + 1).alias("sort_order"))

    rows = [step(0, lambda c: F.col(f"{c}0")), step(1, lambda c: F.col(f"{c}1")), step(2, lambda c: F.col(f"{c}0") - F.col(f"{c}1"))]
    return one.select(F.inline(F.array(*rows)))


def excluded_by_rule(df: DataFrame, rules: Sequence[tuple[Column, str]], units: str, order: Sequence[str] = ()) -> DataFrame:
    """Excluded rows and units by the first rule that hits."""
    hit = df.filter(any_of([c for c, _ in rules]))
    out = hit.groupBy(first_match(rules).alias("reason")).agg(F.count(F.lit(1)).alias("excluded"), F.sum(units).alias("excluded_units"))
    return out.withColumn("sort_order", ordered_label(F.col("reason"), order)) if order else out


def net_active_count(df: DataFrame, key: str, parent: str, units: str, exclusions: Sequence[DataFrame]) -> DataFrame:
    """Entities, parents and units left after all exclusions (each a frame whose first column is the id)."""
    for ex in exclusions:
        df = df.join(ex.select(F.col(ex.columns[0]).alias(key)).distinct(), key, "left_anti")
    per = df.groupBy(key, parent).agg(F.sum(units).alias("units"))
    return per.agg(F.count_distinct(key).alias("entities"), F.count_distinct(parent).alias("parents"), F.sum("units").alias("units"))
