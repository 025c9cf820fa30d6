"""Comparing a source system with a target system."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.functions.columns import any_of, count_if, first_match, flag_total
from crosswalk.functions.scale import distinct_rows, group_stats, highest, latest_per_key, star_rows, with_figures


@dataclass
class Edge:
    """One left join of a star: rows of ``df`` whose ``right`` columns equal the ``left`` columns so far."""

    df: DataFrame
    left: Sequence[str]
    right: Sequence[str]


def star_left_chain(root: DataFrame, edges: Sequence[Edge], select: Sequence[str], distinct: bool = True) -> DataFrame:
    """Chained left equi joins, one projection, copies dropped once.

    With ``distinct`` an edge none of whose columns are needed later can only repeat rows, so it is not joined.
    Joins of large tables are dealt by their rows and stored a slice at a time (``functions.scale.star_rows``), and so is the comparison
    of the stored rows that drops copies; joins of smaller ones are left to the planner.
    """
    needed = set(select)
    kept = []
    for edge in reversed(edges):
        if not distinct or needed & set(edge.df.columns):
            kept.append(edge)
            needed |= set(edge.left)
    kept.reverse()
    sides = [(e.df.select(*[c for c in e.df.columns if c in needed or c in e.right or not distinct]), e.left, e.right) for e in kept]
    out, large = star_rows(root, sides, select)
    if not distinct:
        return out
    return distinct_rows(out) if large else out.distinct()


def pivot_flags(rows: DataFrame, key: str, code: str, value: Column, codes: Mapping[str, str]) -> DataFrame:
    """A2: one boolean column per code: true when any row of the key has that code and the value is true."""
    return rows.groupBy(key).agg(
        *[F.coalesce(F.max(F.when(F.col(code) == c, value)), F.lit(False)).alias(name) for c, name in codes.items()]
    )


def enrich_latest(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, order: Sequence[Column], flags: Sequence[str],
    others: Sequence[str] = (), parents: DataFrame | None = None, parent_on: tuple[str, str] | None = None,
    parent_columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Each left row with the newest right row of its key; missing flags become FALSE.

    A parent may be looked up too; filter its deleted rows before passing it, so that a row whose parent is
    deleted is kept with an empty parent name.
    """
    newest = latest_per_key(right, [right_key], order).select(
        F.col(right_key).cast("string").alias("_key"), *[F.col(c).alias(c) for c in [*flags, *others]]
    )
    out = left.join(newest, F.col(left_key).cast("string") == F.col("_key"), "left").drop("_key")
    out = out.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags})
    if parents is not None:
        mine, theirs = parent_on
        side = parents.select(F.col(theirs).alias("_parent"), *[F.col(s).alias(t) for s, t in parent_columns.items()])
        out = out.join(side, F.col(mine) == F.col("_parent"), "left").drop("_parent")
    return out


def aggregate_many_to_one(
    df: DataFrame, key: str, id_col: str, flags: Mapping[str, str | None], updated: str, metadata: Sequence[str]
) -> DataFrame:
    """A1: one row per key. ``flags`` maps each flag to its enabled-at column.

    Counts, any-flag, earliest flag time, number of flags, multi marker, newest update, and the metadata of the
    newest row (ties: largest id). Rows are first reduced to one per (key, id), which counts the distinct ids on the way, then to
    one per key; the newest row comes from ``latest_per_key``, so metadata of all other rows stays where it is. The ids of a key
    are not collected here, since one key may own a third of all rows: ``functions.scale.member_lists`` lists them
    in bounded pieces.
    """
    stamps = {f"{f}_at": at for f, at in flags.items() if at}
    per_id = df.groupBy(key, id_col).agg(
        F.count(F.lit(1)).alias("_n"), F.max(updated).alias("_updated"), *[F.max(f).alias(f) for f in flags], *[F.min(at).alias(n) for n, at in stamps.items()]
    )
    out = per_id.groupBy(F.col(key).alias("_k")).agg(
        F.sum("_n").alias("active_count"), F.count(id_col).alias("unique_count"), F.max("_updated").alias("last_updated_at"),
        *[F.coalesce(F.max(f), F.lit(False)).alias(f) for f in flags], *[F.min(n).alias(n) for n in stamps],
    )
    newest = latest_per_key(df.select(key, id_col, updated, *metadata), [key], [F.col(updated).desc_nulls_last(), F.col(id_col).desc_nulls_last()])
    total = flag_total(list(flags))
    return newest.select(key, id_col, *metadata).join(out, F.col(key).eqNullSafe(F.col("_k"))).select(
        key, id_col, *metadata, *flags, *stamps, "last_updated_at", "active_count", "unique_count",
        total.alias("total_flag_count"), (F.col("active_count") > 1).alias("is_multi"), (total > 0).alias("has_any_flag"),
    )


def create_queue(source: DataFrame, target: DataFrame, source_key: str, target_key: str, deleted: Column) -> DataFrame:
    """Source keys without a live target row. Deleted targets are dropped before the join, not after it."""
    live = target.filter(~F.coalesce(deleted, F.lit(False))).select(F.col(target_key).alias("_key")).distinct()
    return source.filter(F.col(source_key).isNotNull()).join(live, F.col(source_key) == F.col("_key"), "left_anti")


def update_queue(
    source: DataFrame, target: DataFrame, source_key: str, target_key: str, deleted: Column, order: Sequence[Column],
    target_columns: Sequence[str],
) -> DataFrame:
    """Source rows with the newest live target row of their key."""
    live = target.filter(~F.coalesce(deleted, F.lit(False)) & F.col(target_key).isNotNull())
    newest = latest_per_key(live, [target_key], order).select(F.col(target_key).alias("_key"), *target_columns)
    return source.join(newest, F.col(source_key) == F.col("_key"), "inner").drop("_key")


def missing_in_target(source: DataFrame, target: DataFrame, source_id: str, target_id: str, condition: Column | None = None) -> DataFrame:
    """Source rows whose id, as text, is not in the target; optionally under a condition."""
    known = target.select(F.col(target_id).cast("string").alias("_id")).distinct()
    rows = source if condition is None else source.filter(condition)
    return rows.join(known, F.col(source_id).cast("string") == F.col("_id"), "left_anti")


def has_text(column: str) -> Column:
    return F.col(column).isNotNull() & (F.trim(column) != "")


def gap_profile(gap: DataFrame, status: str, created: str, key: str, months: int | None = None) -> DataFrame:
    """The gap by status, by creation month (all or the latest ones) and by whether a key is stored, as one long table."""
    base = gap.groupBy(
        F.col(status).alias("_status"), F.date_format(created, "yyyy-MM").alias("_month"), has_text(key).cast("string").alias("_key")
    ).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.array(
        *[F.struct(F.lit(kind).alias("profile"), F.col(c).alias("bucket")) for kind, c in
          (("status", "_status"), ("month", "_month"), ("has_key", "_key"))]
    )
    counts = base.select(F.inline(parts), "_n").groupBy("profile", "bucket").agg(F.sum("_n").alias("row_count"))
    latest = highest(counts.filter("profile = 'month' AND bucket IS NOT NULL"), [F.desc("bucket")], months)
    return counts.filter("profile <> 'month'").unionByName(latest)


def flag_mismatch(
    source: DataFrame, target: DataFrame, source_key: str, target_key: str, pairs: Mapping[str, str], null_safe: bool = True,
    condition: Column | None = None,
) -> DataFrame:
    """Target rows where a flag differs from the source; ``pairs`` maps target flag to source flag.

    A source that has no row counts as FALSE. With ``null_safe`` a NULL target flag differs from any value;
    without it such a comparison is skipped, as a plain ``!=`` does.
    """
    rows = target if condition is None else target.filter(condition)
    side = source.select(F.col(source_key).alias("_key"), *[F.col(s).alias(f"_s_{t}") for t, s in pairs.items()])
    out = rows.join(side, F.col(target_key).cast("string") == F.col("_key").cast("string"), "left")
    values = {t: F.coalesce(F.col(f"_s_{t}"), F.lit(False)) for t in pairs}
    if null_safe:
        differ = [~F.col(t).eqNullSafe(v) for t, v in values.items()]
    else:
        differ = [F.col(t) != v for t, v in values.items()]
    return out.filter(any_of(differ)).select(*target.columns, *[v.alias(f"source_{t}") for t, v in values.items()])


def flag_sync_rows(source: DataFrame, target: DataFrame, source_key: str, target_key: str, pairs: Mapping[str, str], condition: Column) -> DataFrame:
    """Backfill variant: every target row meeting a condition, with the source's flags."""
    side = source.select(F.col(source_key).alias("_key"), *[F.col(s).alias(f"_s_{t}") for t, s in pairs.items()])
    out = target.filter(condition).join(side, F.col(target_key).cast("string") == F.col("_key").cast("string"), "left")
    return out.select(*target.columns, *[F.coalesce(F.col(f"_s_{t}"), F.lit(False)).alias(f"source_{t}") for t in pairs])


def env_compare(a: DataFrame, b: DataFrame, key: str, columns: Sequence[str], a_name: str = "A", b_name: str = "B") -> DataFrame:
    """Full outer comparison of two environments: where each key is, and MATCH / MISMATCH per column.

    Each side is one row per key before the join, so copies neither multiply rows nor counts. A column is a mismatch
    if any value of the key in one environment differs from any in the other, and such a pair is shown; smallest and
    largest value decide that. NULL differs from nothing. ``repeated_keys`` reports the copies.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        ends = [f(c).alias(f"_{name}_{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))]
        return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_k{name}")).agg(*ends)

    both_sides = side(a, "a").join(side(b, "b"), F.col("_ka") == F.col("_kb"), "full_outer")
    ends = {(s, n, c): F.col(f"_{s}_{n}_{c}") for s in "ab" for n in ("low", "high") for c in columns}
    below = {c: F.coalesce(ends["a", "low", c] != ends["b", "high", c], F.lit(False)) for c in columns}
    shown = [F.when(below[c], ends[s, n, c]).otherwise(ends[s, m, c]).alias(f"{s}_{c}") for c in columns for s, n, m in (("a", "low", "high"), ("b", "high", "low"))]
    out = both_sides.select("_ka", "_kb", *shown)
    in_a, in_b = F.col("_ka").isNotNull(), F.col("_kb").isNotNull()
    differ = {c: F.col(f"a_{c}") != F.col(f"b_{c}") for c in columns}
    order = first_match(
        [(in_a & ~in_b, 1), (~in_a & in_b, 2), *[(differ[c], n) for n, c in enumerate(columns, 3)]], len(columns) + 3
    )
    both = F.when(in_a & in_b, "BOTH").when(in_a, f"{a_name}_ONLY").otherwise(f"{b_name}_ONLY")
    status = [F.when(differ[c], "MISMATCH").otherwise("MATCH").alias(f"{c}_status") for c in columns]
    values = [F.col(f"{s}_{c}") for c in columns for s in ("a", "b")]
    return out.select(F.coalesce("_ka", "_kb").alias(key), both.alias("data_source"), *values, *status, order.alias("sort_order"))


def repeated_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that an environment holds more than once, and rows without a key, with the rows of each."""
    sides = [df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).select(key, *[(F.col("_n") if n == m else F.lit(0)).alias(f"{m}_rows") for m in "ab"]) for n, df in (("a", a), ("b", b))]
    out = sides[0].unionByName(sides[1]).groupBy(key).agg(*[F.sum(f"{m}_rows").alias(f"{m}_rows") for m in "ab"])
    return out.filter(F.col(key).isNull() | (F.greatest("a_rows", "b_rows") > 1))


def env_compare_metrics(compared: DataFrame, columns: Sequence[str], a_name: str = "A", b_name: str = "B") -> DataFrame:
    """Counts in A, in B, in both, in one only, and mismatches per column; one pass, then one row each."""
    where = F.col("data_source")
    both = where == "BOTH"
    counts = {
        f"Total in {a_name}": both | (where == f"{a_name}_ONLY"),
        f"Total in {b_name}": both | (where == f"{b_name}_ONLY"),
        "In both": both,
        f"Only in {a_name}": where == f"{a_name}_ONLY",
        f"Only in {b_name}": where == f"{b_name}_ONLY",
        **{f"Mismatch {c}": both & (F.col(f"{c}_status") == "MISMATCH") for c in columns},
    }
    one = compared.agg(*[count_if(c).alias(f"m{n}") for n, c in enumerate(counts.values())])
    rows = [F.struct(F.lit(name).alias("metric"), F.col(f"m{n}").alias("row_count")) for n, name in enumerate(counts)]
    return one.select(F.inline(F.array(*rows)))


def env_mismatch_detail(compared: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows in both environments that differ, with text ``name: a -> b`` per differing column."""
    notes = [
        F.when(
            F.col(f"{c}_status") == "MISMATCH",
            F.concat(F.lit(f"{c}: "), F.col(f"a_{c}").cast("string"), F.lit(" -> "), F.col(f"b_{c}").cast("string")),
        )
        for c in columns
    ]
    rows = compared.filter((F.col("data_source") == "BOTH") & any_of([n.isNotNull() for n in notes]))
    return rows.select(key, F.concat_ws("; ", *notes).alias("differences"))


def partner_flag(
    df: DataFrame, key: str, credentials: DataFrame, credential_key: str, condition: Column, integrations: DataFrame | None = None,
    integration_on: tuple[str, str] | None = None,
) -> DataFrame:
    """0/1 flags for an owner with a matching credential and for a row known to an integration.

    Both sides are reduced to distinct keys first, so several credentials do not repeat rows.
    """
    owners = credentials.filter(condition).select(F.col(credential_key).alias("_owner")).distinct()
    out = df.join(owners, F.col(key) == F.col("_owner"), "left")
    out = out.withColumn("api_flag", F.col("_owner").isNotNull().cast("int")).drop("_owner")
    if integrations is None:
        return out
    mine, theirs = integration_on
    known = integrations.select(F.col(theirs).alias("_item")).distinct()
    out = out.join(known, F.col(mine) == F.col("_item"), "left")
    return out.withColumn("integration_flag", F.col("_item").isNotNull().cast("int")).drop("_item")


def orphan_check(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows with a missing or blank parent key, or whose parent does not exist; with the reason."""
    text = F.col(child_key).cast("string")
    empty = child.filter(text.isNull() | (F.trim(text) == "")).withColumn("reason", F.lit("missing key"))
    keys = parent.select(F.col(parent_key).alias("_key")).distinct()
    rest = child.filter(text.isNotNull() & (F.trim(text) != ""))
    lost = rest.join(keys, F.col(child_key) == F.col("_key"), "left_anti").withColumn("reason", F.lit("no parent"))
    return empty.unionByName(lost)


def orphan_counts(orphans: DataFrame, child: DataFrame) -> DataFrame:
    """All child rows, orphans and linked rows in one line."""
    found = orphans.agg(F.count(F.lit(1)).alias("orphan_rows"))
    total = child.agg(F.count(F.lit(1)).alias("total_rows"))
    return with_figures(total, found).withColumn("linked_rows", F.col("total_rows") - F.col("orphan_rows"))


def key_in_other_system(missing: DataFrame, other: DataFrame, stored_key: str, other_key: str, own_id: str, back_reference: str) -> DataFrame:
    """Does the stored key of a missing row exist elsewhere, and does a record there point back to it?

    Several records with the key give one answer: a match if any of them points back, empty if none points anywhere.
    """
    side = other.filter(has_text(other_key)).select(F.col(other_key).alias("_key"), F.col(back_reference).cast("string").alias("_back"))
    side = side.withColumn("_back", F.when(F.col("_back") != "", F.col("_back")))
    keys = side.groupBy("_key").agg(F.count("_back").alias("_n"))
    back = side.filter("_back IS NOT NULL").select("_key", "_back").distinct().withColumn("_hit", F.lit(True))
    rows = missing.filter(has_text(stored_key)).join(keys, F.col(stored_key) == F.col("_key"), "left").drop("_key")
    rows = rows.join(back, (F.col(stored_key) == F.col("_key")) & (F.col(own_id).cast("string") == F.col("_back")), "left")
    status = first_match([(F.col("_n").isNull(), "KEY NOT FOUND"), (F.col("_n") == 0, "BACK REFERENCE EMPTY"), (F.col("_hit").isNotNull(), "MATCHES")], "MISMATCH")
    return rows.select(*missing.columns, status.alias("match_status"))


def has_sibling(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that share their key with another row."""
    return group_stats(df, keys, size="group_size").filter("group_size > 1")


def method_overlap(a: DataFrame, b: DataFrame, key: str, a_name: str = "a", b_name: str = "b") -> DataFrame:
    """Number of distinct ids in a only, in b only and in both."""
    left = a.filter(F.col(key).isNotNull()).select(F.col(key).alias("_a")).distinct()
    right = b.filter(F.col(key).isNotNull()).select(F.col(key).alias("_b")).distinct()
    both = left.join(right, F.col("_a") == F.col("_b"), "full_outer")
    where = F.when(F.col("_b").isNull(), f"{a_name} only").when(F.col("_a").isNull(), f"{b_name} only").otherwise("both")
    return both.groupBy(where.alias("found_in")).agg(F.count(F.lit(1)).alias("ids"))


def seen_items(items: DataFrame, item_key: str, active: Column, exposures: DataFrame, user: str, exposed_item: str) -> tuple[DataFrame, DataFrame]:
    """The distinct active items, and the distinct (user, item) exposures to them."""
    live = items.filter(active).select(F.col(item_key).alias("_item")).filter(F.col("_item").isNotNull()).distinct()
    shown = exposures.select(F.col(user).alias("_user"), F.col(exposed_item).alias("_item")).dropna().distinct()
    return live, shown.join(live, "_item", "left_semi")


def not_yet_exposed(items: DataFrame, item_key: str, active: Column, exposures: DataFrame, user: str, exposed_item: str, users: DataFrame) -> DataFrame:
    """How many active items each user has not been shown, for every user of ``users`` (with the column ``user``).

    The items themselves are listed for one user by ``not_exposed_to``; for all users they would be users x items rows.
    """
    live, seen = seen_items(items, item_key, active, exposures, user, exposed_item)
    counts = seen.groupBy(F.col("_user").alias(user)).agg(F.count(F.lit(1)).alias("_seen"))
    every = users.select(user).filter(F.col(user).isNotNull()).distinct().join(counts, user, "left")
    total = with_figures(every, live.agg(F.count(F.lit(1)).alias("active_items")))
    return total.select(user, "active_items", (F.col("active_items") - F.coalesce("_seen", F.lit(0))).alias("unseen_items"))


def unexposed_users(items: DataFrame, item_key: str, active: Column, exposures: DataFrame, user: str, exposed_item: str, users: DataFrame) -> DataFrame:
    """J35 by item: how many of ``users`` have not been shown each active item."""
    live, seen = seen_items(items, item_key, active, exposures, user, exposed_item)
    known = users.select(F.col(user).alias("_user")).filter(F.col("_user").isNotNull()).distinct()
    counts = seen.join(known, "_user", "left_semi").groupBy("_item").agg(F.count(F.lit(1)).alias("_seen"))
    total = with_figures(live.join(counts, "_item", "left"), known.agg(F.count(F.lit(1)).alias("all_users")))
    return total.select(F.col("_item").alias(item_key), "all_users", (F.col("all_users") - F.coalesce("_seen", F.lit(0))).alias("unexposed_users"))


def not_exposed_to(items: DataFrame, item_key: str, active: Column, exposures: DataFrame, user: str, exposed_item: str, who: object) -> DataFrame:
    """J35 for one user: an anti join that works for a catalogue of any size."""
    seen = exposures.filter(F.col(user) == F.lit(who)).select(F.col(exposed_item).alias(item_key))
    return items.filter(active).join(seen, item_key, "left_anti")


def staged_checks(staged: DataFrame, keys: Sequence[str], domain: str, allowed: Sequence[str]) -> DataFrame:
    """Duplicate groups and values outside the domain among staged rows, as counted findings."""
    copies = staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
    text = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    dup = copies.select(F.lit("duplicate").alias("finding"), text.alias("detail"), "row_count")
    odd = staged.filter(~F.col(domain).isin(*allowed) | F.col(domain).isNull())
    bad = odd.groupBy(F.col(domain).alias("detail")).agg(F.count(F.lit(1)).alias("row_count"))
    return dup.unionByName(bad.withColumn("finding", F.lit("invalid value")))


def insert_missing(staged: DataFrame, target: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(target with the absent staged rows added, those rows). An anti join, so a NULL id cannot empty it."""
    absent = staged.join(target.select(key).distinct(), key, "left_anti")
    return target.unionByName(absent.select(*target.columns)), absent


def value_drift(a: DataFrame, b: DataFrame, key: str, json: str, path: str, value: str, tolerance: float, scale: int = 2) -> DataFrame:
    """Rows whose JSON number differs from the recomputed value by more than a tolerance."""
    stored = F.get_json_object(json, path).try_cast(f"decimal(18,{scale})")
    left = a.select(key, stored.alias("original_value"))
    right = b.select(key, F.col(value).cast(f"decimal(18,{scale})").alias("recomputed_value"))
    out = left.join(right, key).withColumn("difference", F.col("recomputed_value") - F.col("original_value"))
    return out.filter(F.abs("difference") > F.lit(tolerance)).orderBy(F.abs("difference").desc(), key)


def effective_access(
    entity_flags: DataFrame, user_flags: DataFrame, code: str, entity_state: str, user_state: str, on: Sequence[str], enabled: str = "enabled"
) -> DataFrame:
    """An entity's flag holds for a user unless the user's own flag says otherwise; no user flag means yes."""
    side = user_flags.select(*on, code, F.col(user_state).alias("_user_state"))
    out = entity_flags.join(side, [*on, code], "left")
    open_ = (F.col(entity_state) == enabled) & (F.col("_user_state").isNull() | (F.col("_user_state") == enabled))
    return out.withColumn("available", F.coalesce(open_, F.lit(False))).withColumnRenamed("_user_state", "user_state")
