"""Building blocks that stay balanced when one key holds a large part of all rows.

* ``latest_per_key``  row_number = 1; Spark prunes each map partition to one row per key before the shuffle.
* ``distinct_rows``   copies dropped, with as many tasks as there are distinct rows for.
* ``star_join``       left joins, those of large tables dealt by their rows; neither hot nor NULL keys fill a task.
* ``star_rows``       the same with the rows of large tables joined and stored a slice at a time.
* ``join_back``       many-to-one join in which neither hot nor NULL keys are shuffled.
* ``stored_ranges``   rows in stored ranges of any order, cut at sampled tuples.
* ``pieces``          time buckets per key, the overfull ones cut again; ``carried`` sums up the pieces before each.
* ``lag_in_key``      previous row per key, worked out in pieces so that no task sorts a whole key.
* ``number_rows``     global row number without a one-partition window.
* ``running_total``   running weight per group over ordered distinct values, also without one big partition.
* ``percentiles``     exact interpolated percentiles from ``running_total``.
* ``chunked_list``    the whole list of integer ids per key as rows of bounded length, by id ranges.
* ``member_lists``    the whole list of ids of any type per key, in pieces of bounded length, by place.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

from crosswalk.session import cut, cut_in_turn, stored

HOT_ROWS = 1_000_000  # a key with at least this many rows is not shuffled
HOT_KEYS = 4_096  # the largest keys only; bounds the broadcast of their figures
RANGE_ROWS = 1_000_000  # rows of a stored range: what one task sorts
LEAST_ROWS = 10_000  # below this a range is not worth a task of its own
PIECE_ROWS = 1_000_000  # rows of a key's time bucket that one task sorts
FULL_BUCKETS = 100_000  # bounds the broadcasts of buckets and ranges
MOST_RANGES = 2_000  # stored ranges, unless they held more than RANGE_ROWS rows
TASK_ROWS = 500_000  # rows that a task joins or compares
PLANNED_ROWS = 5_000_000  # tables of up to this many rows are dealt as the session's settings say
SMALL_ROWS = 100_000  # rows of a table that is broadcast beside larger ones
LIGHT_BYTES = 32 * 1024 * 1024  # measured size of a table that is broadcast in a star's slices
SPREAD = 32  # parts of a hot key's rows
SLICE_CELLS = 50_000_000  # values of a table, rows by columns, that are shuffled at one time
MOST_SLICES = 8  # slices of a table, which hold more rows in larger ones
FEW_COPIES = 0.8  # a table with at least this share of distinct rows, about, has few copies

Side = tuple[DataFrame, Sequence[str], Sequence[str]]  # a star's table, the left columns so far and its own columns that equal them


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``; give a unique last order column to make the choice repeatable."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def highest(df: DataFrame, order: Sequence[Column], n: int | None) -> DataFrame:
    """The first ``n`` rows in ``order``; every task keeps ``n`` rows, so no global sort. None: all rows, as they are."""
    return df if n is None else df.orderBy(*order).limit(n)


def highest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | None) -> DataFrame:
    """The first ``n`` rows of each key in ``order``; each map partition hands on ``n`` rows a key at most. None: all rows."""
    if n is None:
        return df
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")


def tasks_for(df: DataFrame, rows: int) -> int:
    """A task per ``TASK_ROWS`` rows, or one per shuffle partition if that is more and the rows suffice."""
    wide = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // LEAST_ROWS)
    return max(1, wide, -(-rows // TASK_ROWS))


def slices_for(rows: int, columns: int) -> int:
    """A slice per ``SLICE_CELLS`` values, ``MOST_SLICES`` at most."""
    return max(1, min(MOST_SLICES, -(-rows * columns // SLICE_CELLS)))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Copies dropped. ``df`` is read again, so it should be a stored table: how many tasks compare rows follows from about
    how many distinct ones there are. Where these are few, each map partition drops its copies before the shuffle.
    Of large tables with few copies only hashes are shuffled, and the rows whose hash is not the only one are compared. The rows of other
    large tables are compared and stored a slice at a time, so the disk holds the shuffle of one slice.
    """
    row = F.xxhash64(*df.columns)
    n, rows = df.agg(F.approx_count_distinct(row), F.count(F.lit(1))).first()
    if n <= TASK_ROWS:
        return df.distinct()
    slices = 1 if "collate" in df.schema.simpleString() else slices_for(rows, len(df.columns))  # equal texts of a collation can have unequal hashes
    if slices == 1:
        return df.repartition(tasks_for(df, n), *df.columns).distinct()
    if n > FEW_COPIES * rows:
        hashes = df.select(row.alias("_hash"))
        counts = hashes.repartition(tasks_for(df, rows), "_hash").groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
        shared = cut_in_turn([counts.filter("_n > 1").select("_hash")], "shared-hashes")
        found = shared.count()
        if not found:
            return df
        if found <= SMALL_ROWS:
            marked, few = df.withColumn("_hash", row), F.broadcast(shared)
            again = marked.join(few, "_hash", "left_semi").drop("_hash").distinct()
            return marked.join(few, "_hash", "left_anti").drop("_hash").union(again)
    parts = [df.filter(F.pmod(row, F.lit(slices)) == i).repartition(tasks_for(df, -(-n // slices)), *df.columns).distinct() for i in range(slices)]
    return cut_in_turn(parts, "distinct")


def hot_keys(df: DataFrame, keys: Sequence[str]) -> list[int]:
    """Hashes of the keys that about ``TASK_ROWS`` / 4 rows or more have, from one pass that keeps 10,000 counters."""
    found = df.select(F.xxhash64(*keys).alias("k")).agg(F.expr("approx_top_k(k, 1000, 10000)").alias("top")).first()["top"]
    return [t["item"] for t in found or [] if t["count"] >= TASK_ROWS / 4]


def most_rows(tables: Sequence[DataFrame]) -> tuple[list[int], int]:
    """Rows of each table, and of the largest, from one job."""
    counts = [df.agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("n")) for i, df in enumerate(tables)]
    sizes = {r["i"]: r["n"] for r in reduce(lambda a, b: a.union(b), counts).collect()}
    return [sizes[i] for i in range(len(tables))], max(sizes.values())


def star_join(root: DataFrame, sides: Sequence[Side]) -> tuple[DataFrame, bool]:
    """Chained left equi joins of ``root`` with (table, left columns so far, its right columns), and whether the tables are large.

    Where a table has more than ``PLANNED_ROWS`` rows, both sides of a join are dealt to a task per ``TASK_ROWS`` rows. Tables of up to
    ``SMALL_ROWS`` rows are broadcast then. A row with a NULL key matches nothing and goes to any task; the rows of a hot key are
    spread over ``SPREAD`` places, to each of which its rows on the right go. The joins of smaller tables are left to the planner.
    """
    sizes, most = most_rows([root, *[side for side, _, _ in sides]])
    dealt = dealt_sides(root, sides, sizes) if most > PLANNED_ROWS else None
    return joined(root, sides, dealt, tasks_for(root, most)), most > PLANNED_ROWS


def star_rows(root: DataFrame, sides: Sequence[Side], columns: Sequence[str]) -> tuple[DataFrame, bool]:
    """``columns`` of ``star_join``, and whether the tables are large, whose joined rows are stored then.

    Tables of more than ``SLICE_CELLS`` values are joined a slice of the root's rows at a time, so the disk holds the shuffles of one slice. The
    largest side that hangs on the root's own columns is cut into the same slices; every slice reads the others whole. Only columns
    that are needed later travel, and the smallest side comes first, which in left joins leaves the rows the same. Sides of up to
    ``LIGHT_BYTES`` are broadcast as well.
    """
    tables = [root, *[side for side, _, _ in sides]]
    sizes, most = most_rows(tables)
    needed = {*columns, *[c for _, left, right in sides for c in (*left, *right)]}
    plain = all(sum(t.columns.count(c) for t in tables) == 1 for c in needed)
    if most <= PLANNED_ROWS or not plain:
        dealt = dealt_sides(root, sides, sizes) if most > PLANNED_ROWS else None
        out = joined(root, sides, dealt, tasks_for(root, most)).select(*columns)
        return (out, False) if dealt is None else (cut_in_turn([out], "star"), True)
    slices = slices_for(most, len(needed))
    root, *narrow = [stored(t.select(*[c for c in t.columns if c in needed]), "star-table") for t in tables]
    order = smallest_first(root, [left for _, left, _ in sides], [t.columns for t in narrow], sizes[1:])
    sides, sizes = [(narrow[i], *sides[i][1:]) for i in order], [sizes[0], *[sizes[i + 1] for i in order]]
    dealt = dealt_sides(root, sides, [sizes[0], *[0 if is_light(side, n) else n for (side, _, _), n in zip(sides, sizes[1:])]])
    own = [i for i in dealt if set(sides[i][1]) <= set(root.columns) and even_keys(root, *sides[i])]
    largest = max(own, key=lambda i: sizes[i + 1], default=None)
    row = F.pmod(F.shiftright(row_hash(root), 32), F.lit(slices))  # not the bits that spread a hot key
    if largest is None:
        place = row
    else:
        _, left, right = sides[largest]
        apart = any_null(left) | F.xxhash64(*left).isin(dealt[largest])
        place = F.when(apart, row).otherwise(F.pmod(F.xxhash64(*left), F.lit(slices)))
    parts = []
    for k in range(slices):
        some = list(sides)
        if largest is not None:
            mine = (F.pmod(F.xxhash64(*right), F.lit(slices)) == k) | F.xxhash64(*right).isin(dealt[largest])
            some[largest] = (sides[largest][0].filter(mine), left, right)
        parts.append(joined(root.filter(place == k), some, dealt, tasks_for(root, -(-most // slices)), columns))
    return cut_in_turn(parts, "star"), True


def smallest_first(root: DataFrame, lefts: Sequence[Sequence[str]], columns: Sequence[Sequence[str]], sizes: Sequence[int]) -> list[int]:
    """The order of a star's sides in which the smallest of those whose left columns are there comes next."""
    there, order = set(root.columns), []
    while len(order) < len(lefts):
        ready = [i for i, left in enumerate(lefts) if i not in order and set(left) <= there]
        order.append(min(ready, key=lambda i: sizes[i]))
        there |= set(columns[order[-1]])
    return order


def is_light(df: DataFrame, rows: int) -> bool:
    """Whether the numbers, times and texts of a table of so many rows fill up to ``LIGHT_BYTES``, 16 bytes a value and the texts' own."""
    fixed = rows * 16 * len(df.columns)
    if fixed > LIGHT_BYTES or any(isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)) for f in df.schema):
        return False
    texts = [F.sum(F.octet_length(f.name)) for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))]
    return fixed + sum(n or 0 for n in df.agg(F.lit(0), *texts).first()) <= LIGHT_BYTES


def even_keys(owner: DataFrame, side: DataFrame, left: Sequence[str], right: Sequence[str]) -> bool:
    """Whether the keys are of types whose equal values have equal hashes; keys of other types are not spread."""
    kinds = [owner.schema[a].dataType.simpleString() for a in left]
    return set(kinds) <= {"bigint", "int", "string"} and kinds == [side.schema[b].dataType.simpleString() for b in right]


def dealt_sides(root: DataFrame, sides: Sequence[Side], sizes: Sequence[int]) -> dict[int, list[int]]:
    """The sides of more than ``SMALL_ROWS`` rows by their place in ``sides``, with the hashes of the hot keys of the table that has the left columns."""
    tables = [root, *[side for side, _, _ in sides]]
    dealt = {}
    for i, (side, left, right) in enumerate(sides):
        if sizes[i + 1] > SMALL_ROWS:
            owner = next((t for t in tables[: i + 1] if set(left) <= set(t.columns)), None)
            dealt[i] = hot_keys(owner.dropna(subset=list(left)), left) if owner is not None and even_keys(owner, side, left, right) else []
    return dealt


def joined(root: DataFrame, sides: Sequence[Side], dealt: Mapping[int, list[int]] | None, parts: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The joins of a star, those of the sides in ``dealt`` in ``parts`` tasks, the others by a broadcast; without ``dealt`` as planned.
    With ``columns``, what neither they nor a later join need is dropped after each join."""
    out = root
    for i, (side, left, right) in enumerate(sides):
        if dealt is not None and i in dealt:
            out = dealt_join(out, side, left, right, dealt[i], parts)
        else:
            match = [out[a] == side[b] for a, b in zip(left, right)]
            out = out.join(side if dealt is None else F.broadcast(side), match, "left")
        if columns is not None:
            later = {*columns, *[c for _, names, _ in sides[i + 1 :] for c in names]}
            out = out.select(*[c for c in out.columns if c in later])
    return out if columns is None else out.select(*columns)


def row_hash(df: DataFrame) -> Column:
    """A hash of a row's columns, but for those that cannot be named or hashed."""
    named = [f.name for f in df.schema if df.columns.count(f.name) == 1 and not re.search("map<|variant", f.dataType.simpleString())]
    return F.xxhash64(*[F.col(f"`{c}`") for c in named])


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def dealt_join(df: DataFrame, side: DataFrame, left: Sequence[str], right: Sequence[str], hot: Sequence[int], parts: int) -> DataFrame:
    """Left equi join of two large tables in ``parts`` tasks; ``hot`` are hashes of keys whose rows are spread."""
    row = row_hash(df)
    place = F.when(any_null(left), -1 - F.pmod(row, F.lit(1 << 20)))  # none of the places of keys
    copies = F.array(F.lit(0).cast("bigint"))
    if hot:
        place = place.when(F.xxhash64(*left).isin(hot), F.pmod(row, F.lit(SPREAD)))
        copies = F.when(F.xxhash64(*right).isin(hot), F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))).otherwise(copies)
    dealt = df.withColumn("_place", place.otherwise(0).cast("bigint")).repartition(parts, *left, "_place")
    other = side.withColumn("_side_place", F.explode(copies)).repartition(parts, *right, "_side_place")
    match = [*[dealt[a] == other[b] for a, b in zip(left, right)], dealt["_place"] == other["_side_place"]]
    return dealt.join(other, match, "left").drop("_place", "_side_place")


def with_figures(df: DataFrame, figures: DataFrame) -> DataFrame:
    """Adds the columns of a one-row aggregate to every row, as a scalar subquery: no join and no broadcast.

    More than one row in ``figures`` is an error at run time.
    """
    names = figures.columns
    out = df.withColumn("_figures", figures.select(F.struct(*names)).scalar())
    return out.select(*df.columns, *[F.col(f"_figures.{n}").alias(n) for n in names])


def join_back(
    df: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    size: str,
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Join rows to a table holding one row per key whose ``size`` column counts the rows of ``df`` with it.

    Rows are split by the class of their key. The ``hot_keys`` largest keys of ``hot_rows`` rows or more take their
    figures from a broadcast, whose entries that number bounds at any size of ``df``; a key that is not among them
    holds at most rows / ``hot_keys`` rows. Only the rows of all other keys are shuffled. Rows with a NULL key match
    nothing, as in a plain join, and stay with the hot ones. Both parts read the same aggregate.
    """
    names = [c for c in stats.columns if c not in keys]
    values = F.struct(*names).alias("_v")
    largest = stats.filter(F.col(size) >= hot_rows).orderBy(F.col(size).desc(), *keys).limit(hot_keys)
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    marked = df.join(F.broadcast(largest.select(*keys, values)), list(keys), "left")
    found = F.col("_v").isNotNull()
    cold = marked.filter(~found & ~missing).select(*df.columns).join(stats.select(*keys, values), list(keys), how)
    figures = [F.col(f"_v.{c}").alias(c) for c in names]
    stay = found if how == "inner" else found | missing
    return marked.filter(stay).select(*df.columns, *figures).union(cold.select(*df.columns, *figures))


def group_stats(df: DataFrame, keys: Sequence[str], how: str = "inner", size: str = "_size", **aggs: Column) -> DataFrame:
    """Rows with aggregates of their group attached: a window without ordering, but pre-aggregated, and without hot keys in the shuffle."""
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(size), *[c.alias(n) for n, c in aggs.items()])
    out = join_back(df, stats, keys, size, how)
    return out.drop("_size") if size == "_size" else out


def stored_ranges(df: DataFrame, order: Sequence[Column], rows: int | None = None) -> tuple[DataFrame, int]:
    """Rows in ranges that follow each other in ``order``, stored, and the number of ranges.

    ``_range`` numbers the ranges and ``_place`` the rows of each, both from 0. The cut points are whole tuples of the
    order's columns, of any type that Spark can sort, from a sample of the rows; so a value that very many rows share
    is cut by the columns after it, and the last one should be unique. There is a range per ``rows`` rows (``RANGE_ROWS``), or
    one per shuffle partition if that is more and the rows suffice. Smaller ``rows`` give at most ``MOST_RANGES`` ranges, which hold more
    rows in larger tables, so the sample, the tasks and the files do not grow with the table until a range has ``RANGE_ROWS``. The ranges are written once to the shared folder: what is
    read back is the same for every task and every attempt.
    """
    spark = df.sparkSession
    n = df.count()
    wide = min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // LEAST_ROWS)
    rows = rows or RANGE_ROWS
    wanted = -(-n // rows)
    parts = max(1, wide, wanted if wanted <= MOST_RANGES else max(MOST_RANGES, -(-n // max(rows, RANGE_ROWS))))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    stored = cut(ranged, "ranges")  # the upper half of _m is the partition, the lower 33 bits count its rows
    return stored.select(*df.columns, F.shiftright("_m", 33).cast("int").alias("_range"), F.col("_m").bitwiseAND((1 << 33) - 1).alias("_place")), parts


def pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, rows: int | None = None, descending: bool = False) -> DataFrame:
    """Adds ``_bucket`` and ``_cell``: rows of a key in ``order`` run through its (bucket, cell) pieces one after the other,
    and a piece holds about ``rows`` rows (``PIECE_ROWS``) at most, whatever their keys and times are (see ``stored_ranges`` for small
    ``rows`` in large tables).

    A bucket of a key with more rows than that is cut again into cells at sampled tuples of ``order``; all other buckets are
    one cell and are not moved. One aggregate finds the full buckets; there is at most one for ``rows`` rows, and at most
    ``FULL_BUCKETS`` of them are kept apart, the threshold rising with the table; so the broadcast of their names is bounded.
    Rows of a NULL key are in no sequence and are left out. ``bucket`` must not decrease along ``order`` (nor increase, with
    ``descending``).
    """
    rows = rows or PIECE_ROWS
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    named = df.filter(known).withColumn("_bucket", bucket)
    parts = [*keys, "_bucket"]
    sizes = named.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
    full = sizes.filter(F.col("_n") > rows).orderBy(F.col("_n").desc(), *parts).limit(FULL_BUCKETS).select(*parts)
    full = cut(full, "full-buckets")
    if full.isEmpty():
        return named.withColumn("_cell", F.lit(0))
    same = reduce(lambda a, b: a & b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in parts])
    apart = F.broadcast(full)
    rest = named.alias("a").join(apart.alias("b"), same, "left_anti").withColumn("_cell", F.lit(0))
    heavy = named.alias("a").join(apart.alias("b"), same, "left_semi")
    by = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]
    ranged, _ = stored_ranges(heavy, [*[F.col(c) for c in parts], *by], rows)
    return rest.unionByName(ranged.withColumnRenamed("_range", "_cell").drop("_place"))


def lag_in_key(
    df: DataFrame, keys: Sequence[str], ts: str, tie: str, columns: Sequence[str], grain: str = "day", rows: int | None = None
) -> DataFrame:
    """``prev_<c>`` for each column: its value in the row before this one, per key, ordered by (ts, tie).

    Rows are ordered inside the pieces of a key (see ``pieces``); the last row of each piece is handed to the next
    one. A task therefore sorts one piece, and the second window sees one row per piece.
    Rows with a NULL key or time belong to no sequence; filter them out first.
    """
    cells = pieces(df, keys, [ts, tie], F.date_trunc(grain, F.col(ts)), rows)
    parts = [*keys, "_bucket", "_cell"]
    payload = F.struct(*[F.col(c) for c in columns])
    last = latest_per_key(cells, parts, [F.col(ts).desc(), F.col(tie).desc()]).select(*parts, payload.alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_bucket", "_cell")
    before = last.select(*parts, F.lag("_last").over(across).alias("_before"))
    inside = cells.withColumn("_prev", F.lag(payload).over(Window.partitionBy(*parts).orderBy(ts, tie)))
    joined = inside.join(before, parts, "left").withColumn("_prev", F.coalesce("_prev", "_before"))
    picked = [F.col(f"_prev.{c}").alias(f"prev_{c}") for c in columns]
    return joined.select(*df.columns, *picked)


def carried(cells: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """(keys, ``_bucket``, ``_cell``, sums): for each piece of a key the sums over the pieces before it."""
    parts = [*keys, "_bucket", "_cell"]
    before = Window.partitionBy(*keys).orderBy("_bucket", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = cells.groupBy(*parts).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return totals.select(*parts, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums])


def number_rows(df: DataFrame, order: str, tie: str, descending: bool = False, name: str = "row_number", rows: int | None = None) -> DataFrame:
    """Global 1-based row number by (order, tie), columns of any type that can be sorted; ``tie`` must be unique and ascends.

    Rows are stored in ranges (see ``stored_ranges``), numbered inside each range, and shifted by the rows of earlier
    ranges. Null order values come first (ascending).
    """
    first = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_first()
    ranged, parts = stored_ranges(df, [first, F.col(tie).asc_nulls_first()], rows)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    # A row per range: its number is known, so the broadcast is of a checked size.
    joined = ranged.join(F.broadcast(offsets) if parts <= FULL_BUCKETS else offsets, "_range")
    return joined.select(*df.columns, (F.col("_offset") + F.col("_place") + 1).alias(name))


def running_total(df: DataFrame, groups: Sequence[str], value: str, weight: Column | None = None, rows: int | None = None) -> DataFrame:
    """(groups, value, weight, before, total): weight of the value, of smaller values and of the whole group.

    Ties share one row: repeated values are summed before the shuffle, so a value held by a third of the rows is
    one row here. ``df`` is read once; the distinct values are stored in ranges of (groups, value), so a task sorts a range
    and a window over ranges sees one row per range and group. Rows with a NULL group are left out.
    """
    weight = F.lit(1) if weight is None else weight
    distinct = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.sum(weight).alias("weight"))
    ranged, _ = stored_ranges(distinct, [*[F.col(g) for g in groups], F.col(value)], rows)
    parts = [*groups, "_range"]
    inside = Window.partitionBy(*parts).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(*parts).agg(F.sum("weight").alias("_w"))
    offsets = sizes.select(
        *parts, F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_offset"), F.sum("_w").over(Window.partitionBy(*groups)).alias("total")
    )
    ranged = ranged.withColumn("_inside", F.coalesce(F.sum("weight").over(inside), F.lit(0)))
    return (
        ranged.join(offsets, parts)
        .withColumn("before", F.col("_inside") + F.col("_offset"))
        .select(*groups, value, "weight", "before", "total")
    )


def percentiles(df: DataFrame, groups: Sequence[str], value: str, points: dict[str, float]) -> DataFrame:
    """Exact linear-interpolated percentiles per group, one output column per entry of ``points``.

    ``percentile`` would hold every distinct value of a group in one task; here only running totals move.
    """
    run = running_total(df, groups, value).withColumnRenamed("total", "_n")
    after = F.col("before") + F.col("weight")
    aggs = []
    for name, p in points.items():
        low = F.floor(F.lit(p) * (F.col("_n") - 1))
        high = F.ceil(F.lit(p) * (F.col("_n") - 1))
        aggs += [
            F.min(F.when(after > low, F.col(value))).cast("double").alias(f"_lo_{name}"),
            F.min(F.when(after > high, F.col(value))).cast("double").alias(f"_hi_{name}"),
        ]
    out = run.groupBy(*groups).agg(F.max("_n").alias("_n"), *aggs)
    shown = []
    for name, p in points.items():
        spot = F.lit(p) * (F.col("_n") - 1)
        step = (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (spot - F.floor(spot))
        shown.append((F.col(f"_lo_{name}") + step).alias(name))
    return out.select(*groups, *shown)


def chunked_list(
    df: DataFrame, keys: Sequence[str], item: str, width: int = 10_000, name: str = "items", separator: str = ","
) -> DataFrame:
    """All ids of each key as sorted text, cut by id range: chunk c holds the ids in [c x width, (c + 1) x width).

    A row holds at most ``width`` distinct ids however many the key has, so no list outgrows a task and none
    is shortened. ``item`` must be an integer id.
    """
    chunk = F.floor(F.col(item) / F.lit(width)).cast("bigint")
    return (
        df.groupBy(*keys, chunk.alias("chunk"))
        .agg(F.array_sort(F.collect_set(item)).alias("_items"))
        .withColumn(name, F.array_join(F.transform("_items", lambda x: x.cast("string")), separator))
        .withColumn(f"{name}_count", F.size("_items"))
        .drop("_items")
    )


def member_lists(
    df: DataFrame, keys: Sequence[str], item: str, width: int = 10_000, name: str = "items", separator: str = ",", rows: int | None = None
) -> DataFrame:
    """All distinct ids of each key, of any sortable type, as lists in order: ``piece`` p holds the ids with places
    p x width to (p + 1) x width - 1 within the key, as text joined by ``separator``, and ``<name>_count`` says how many.

    Distinct (key, id) rows are stored in ranges, so an id's place within its key is its place in the range, less the
    key's first one there, plus the key's rows in earlier ranges. A key that holds a third of all ids is many ranges and
    many pieces; no task holds more than a range and no row more than ``width`` ids. Null ids are left out, null keys are a key.
    """
    distinct = df.filter(F.col(item).isNotNull()).select(*keys, item).distinct()
    ranged, _ = stored_ranges(distinct, [*[F.col(k).asc_nulls_first() for k in keys], F.col(item).asc()], rows)
    in_range = ranged.groupBy("_range", *keys).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = in_range.select(
        F.col("_range").alias("_r"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    same = [F.col("_range") == F.col("_r"), *[F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]]
    placed = ranged.join(starts, reduce(lambda a, b: a & b, same))
    piece = F.floor((F.col("_place") + F.col("_shift")) / F.lit(width)).cast("bigint").alias("piece")
    lists = placed.groupBy(*keys, piece).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    texts = F.array_join(F.transform("_items", lambda x: x.cast("string")), separator)
    return lists.select(*keys, "piece", texts.alias(name), F.size("_items").alias(f"{name}_count"))
