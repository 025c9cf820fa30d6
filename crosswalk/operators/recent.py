"""J23 over sliding time windows: matches of the last days and places of the last days, per record.

A window of days before each record would be a self-join of all records that share a name. Here it is the difference of two
running totals per shared key, one at the record's time and one a window earlier; distinct places are the running total of
the intervals in which a place is in reach. Totals run through the pieces of a key (``functions.scale.pieces``), so a name that a
third of all records share is many tasks, and no pair of records is ever formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosswalk.functions.columns import micros
from crosswalk.functions.scale import carried, join_back, lag_in_key, pieces
from crosswalk.operators.match import FIELDS, IDENT, SUBSET, SUBSETS, _identity, _subset_keys, _total, shared_keys, subset_score
from crosswalk.session import cut

DAY = 86_400_000_000  # microseconds


def running_at(marks: DataFrame, keys: Sequence[str], at: str, value: str, rows: int | None = None) -> DataFrame:
    """(keys, ``at``, ``value``): the sum of ``value`` over all marks of the key up to and at each time that has one.

    ``at`` is a number of microseconds. Marks of one time are summed first.
    """
    per = marks.groupBy(*keys, at).agg(F.sum(value).alias(value))
    cells = pieces(per, keys, [at], F.floor(F.col(at) / F.lit(30 * DAY)), rows)
    parts = [*keys, "_bucket", "_cell"]
    inside = F.sum(value).over(Window.partitionBy(*parts).orderBy(at))
    summed = cells.withColumn("_inside", inside).join(carried(cells, keys, {"_before": F.col(value)}), parts)
    return summed.select(*keys, at, (F.col("_inside") + F.col("_before")).alias(value))


def recent_matches(df: DataFrame, key: str, at: str, days: int = 30, min_score: int = 70, more_than: int = 3, rows: int | None = None) -> DataFrame:
    """Records with more than ``more_than`` other records that score ``min_score`` or more with them and lie in the
    ``days`` days up to and at their time: ``key``, ``at``, ``match_count`` and ``highest_score`` among those.

    Records without a time take no part. ``min_score`` is a number of points, not a band.
    """
    known = df.filter(F.col(at).isNotNull()).withColumn("_at", micros(F.col(at)))
    shared = shared_keys(known).groupBy(*IDENT).agg(F.collect_list(F.struct(*SUBSET)).alias("_keys"))  # 15 entries at most
    merged = _identity(known).groupBy(*IDENT, "_at").agg(F.count(F.lit(1)).alias("w"))
    sizes = merged.groupBy(*IDENT).agg(F.count(F.lit(1)).alias("_rows"))
    spread = cut(join_back(merged, shared.join(sizes, IDENT), IDENT, "_rows", "inner").select(*IDENT, "_at", "w", F.inline("_keys")), "recent-keys")
    points = cut(spread.groupBy(*SUBSET, "_at").agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("_rows")), "recent-points")
    # A total is wanted at each time and one window before it; the mark there adds nothing.
    earlier = points.select(*SUBSET, (F.col("_at") - days * DAY).alias("_at"), F.lit(0).cast("bigint").alias("n"))
    totals = running_at(points.select(*SUBSET, "_at", "n").unionByName(earlier), SUBSET, "_at", "n", rows)
    signed = totals.select(*SUBSET, F.inline(F.array(
        F.struct(F.col("_at").alias("_at"), F.col("n").alias("n")), F.struct((F.col("_at") + days * DAY).alias("_at"), (-F.col("n")).alias("n"))
    )))
    within = signed.groupBy(*SUBSET, "_at").agg(F.sum("n").alias("n"))
    stats = points.select(*SUBSET, "_at", "_rows").join(within, [*SUBSET, "_at"]).filter("n > 1")
    hits = join_back(spread, stats, [*SUBSET, "_at"], "_rows", "inner")
    counts = hits.groupBy(*IDENT, "_at").agg(
        *[F.expr(f"coalesce(sum(CASE WHEN mask = {m} THEN n - 1 END), 0L)").alias(f"c{m}") for m in range(len(SUBSETS))], F.max("w").alias("w")
    )
    best = F.expr("greatest(" + ", ".join(f"CASE WHEN c{n} > 0 THEN {subset_score(s)} ELSE 0 END" for n, s in enumerate(SUBSETS)) + ")")
    figures = counts.select(*IDENT, "_at", "w", _total(lambda p: p >= min_score).alias("match_count"), best.alias("highest_score"))
    strong = figures.filter(F.col("match_count") > more_than)
    return join_back(_identity(known), strong, [*IDENT, "_at"], "w", "inner").select(key, at, "match_count", "highest_score")


def recent_places(
    df: DataFrame, key: str, at: str, place: str, by: Sequence[Sequence[str]] = (("email",), ("phone",)), days: int = 90, at_least: int = 5, rows: int | None = None
) -> DataFrame:
    """Records for which those that share the fields of one of the sets in ``by`` lie in ``at_least`` or more distinct
    places within the ``days`` days up to and at their time, own place included: ``key``, ``at``, ``shared`` (the fields'
    names) and ``places``. A set counts for records that have all of its fields; its fields are given in the order of ``FIELDS``.

    Records without a time take no part; a place that is null is none.
    """
    masks = [SUBSETS.index(tuple(fields)) for fields in by]
    window = days * DAY
    known = df.filter(F.col(at).isNotNull()).withColumn("_at", micros(F.col(at)))
    keyed = cut(known.select(key, at, place, "_at", _subset_keys({m: F.lit(True) for m in masks})), "recent-keys")
    seen = keyed.filter(F.col(place).isNotNull()).select(*SUBSET, place, "_at").distinct()
    # A place is in reach from a record until a window later, longer where it is seen again before that.
    month = F.timestamp_micros("_at")
    steps = lag_in_key(seen.withColumn("_time", month), [*SUBSET, place], "_time", "_at", ["_at"], "month", rows)
    begun = F.col("prev__at").isNull() | (F.col("prev__at") + window <= F.col("_at"))
    ended = F.when(begun & F.col("prev__at").isNotNull(), F.struct((F.col("prev__at") + window).alias("_at"), F.lit(-1).cast("bigint").alias("n")))
    start = F.when(begun, F.struct(F.col("_at").alias("_at"), F.lit(1).cast("bigint").alias("n")))
    changes = steps.select(*SUBSET, F.inline(F.array_compact(F.array(start, ended))))
    last = seen.groupBy(*SUBSET, place).agg((F.max("_at") + window).alias("_at")).select(*SUBSET, "_at", F.lit(-1).cast("bigint").alias("n"))
    asked = keyed.groupBy(*SUBSET, "_at").agg(F.count(F.lit(1)).alias("_rows"))
    marks = changes.unionByName(last).unionByName(asked.select(*SUBSET, "_at", F.lit(0).cast("bigint").alias("n")))
    totals = running_at(marks, SUBSET, "_at", "n", rows).filter(F.col("n") >= at_least)
    hits = join_back(keyed, asked.join(totals, [*SUBSET, "_at"]), [*SUBSET, "_at"], "_rows", "inner")
    names = reduce(lambda c, m: c.when(F.col("mask") == m, ", ".join(SUBSETS[m])), masks, F)
    return hits.select(key, at, names.alias("shared"), F.col("n").alias("places"))
