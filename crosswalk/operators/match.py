"""Matching records of two systems and people across records.

No operator here lists all pairs of a group. Where many records share one address or identity, a pair list grows
with the square of the group; counts per group, one representative, and per-record figures derived from counts say
the same in linear space.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.functions.columns import address_key, count_if, first_match, norm_email, norm_name, norm_phone, percent
from crosswalk.functions.scale import join_back, latest_per_key, with_figures
from crosswalk.session import cut

# Duplicate labels
NO_DUPE, BOTH_DUPE, DUPE, OVERRIDDEN = "No Dupe", "Both Dupe", "Dupe", "Overridden"


@dataclass
class SiteColumns:
    id: str
    name: str = "name"
    street: str = "street"
    city: str = "city"
    state: str = "state"
    zip: str = "zip"


def with_address(df: DataFrame, c: SiteColumns) -> DataFrame:
    """Adds ``addr``: hash of the normalised address, NULL when a part is missing."""
    return df.withColumn("addr", address_key(F.col(c.street), F.col(c.city), F.col(c.state), F.col(c.zip)))


def match_direct(
    source: DataFrame, target: DataFrame, s: SiteColumns, t: SiteColumns, ref: str, override: str, deleted: str, skip_marker: str | None = None
) -> DataFrame:
    """Rows whose stored target id is a live target. The target's override id wins over the row's own id.

    Result: target_id, source_id, src_addr, tgt_addr, override_id, match_method, target_copies (1).
    """
    rows = source.filter(F.col(ref).isNotNull())
    if skip_marker:
        rows = rows.filter(~F.coalesce(F.col(s.name).like(skip_marker), F.lit(False)))
    rows = with_address(rows, s).select(F.col(s.id).alias("_own"), F.col(ref).alias("_ref"), F.col("addr").alias("src_addr"))
    live = with_address(target.filter(~F.col(deleted)), t).select(
        F.col(t.id).alias("target_id"), F.col(override).alias("override_id"), F.col("addr").alias("tgt_addr")
    )
    out = rows.join(live, F.col("_ref") == F.col("target_id"))
    return out.select(
        "target_id", F.coalesce("override_id", "_own").alias("source_id"), "src_addr", "tgt_addr", "override_id",
        F.lit("DIRECT").alias("match_method"), F.lit(1).cast("bigint").alias("target_copies"),
    )


def match_address(
    source: DataFrame, target: DataFrame, s: SiteColumns, t: SiteColumns, ref: str, override: str, deleted: str, skip_marker: str | None = None
) -> DataFrame:
    """Rows without a stored id, matched on the normalised address to live targets.

    A target overridden to a row matches that row alone. The other targets of an address come as one row per
    source row: the smallest target id and ``target_copies``, the number of targets there. So an address held by
    many rows on both sides yields rows, not rows x targets; links are only ever sent where the count is 1.
    """
    rows = source.filter(F.col(ref).isNull())
    if skip_marker:
        rows = rows.filter(~F.coalesce(F.col(s.name).like(skip_marker), F.lit(False)))
    rows = with_address(rows, s).filter(F.col("addr").isNotNull()).select(F.col(s.id).alias("source_id"), "addr")
    live = with_address(target.filter(~F.col(deleted)), t).filter(F.col("addr").isNotNull())
    live = live.select(F.col(t.id).alias("target_id"), F.col(override).alias("override_id"), "addr")
    method, one = F.lit("ADDRESS").alias("match_method"), F.lit(1).cast("bigint").alias("target_copies")

    tied = live.filter(F.col("override_id").isNotNull()).withColumnRenamed("override_id", "source_id")
    tied = rows.join(tied, ["source_id", "addr"]).select(
        "target_id", "source_id", F.col("addr").alias("src_addr"), F.col("addr").alias("tgt_addr"),
        F.col("source_id").alias("override_id"), method, one,
    )
    free = live.filter(F.col("override_id").isNull())
    targets = free.groupBy("addr").agg(F.count(F.lit(1)).alias("target_copies"), F.min("target_id").alias("target_id"))
    groups = rows.groupBy("addr").agg(F.count(F.lit(1)).alias("_rows")).join(targets, "addr")
    none = F.lit(None).cast(source.schema[s.id].dataType).alias("override_id")
    found = join_back(rows, groups, ["addr"], "_rows", "inner").select(
        "target_id", "source_id", F.col("addr").alias("src_addr"), F.col("addr").alias("tgt_addr"), none, method, "target_copies"
    )
    return tied.unionByName(found)


def label_duplicates(matches: DataFrame, target_name: str = "Target", source_name: str = "Source") -> DataFrame:
    """Copies of each address on either side, overrides per address, and the duplicate label.

    Copies count matched pairs (a row stands for ``target_copies`` pairs). A missing address is never a duplicate.
    """
    pairs = F.sum("target_copies")
    by_target = matches.filter(F.col("tgt_addr").isNotNull()).groupBy("tgt_addr").agg(
        F.count(F.lit(1)).alias("_t"), pairs.alias("target_copy_number"),
        F.sum(F.when(F.col("override_id").isNotNull(), F.col("target_copies")).otherwise(0)).alias("override_records"),
    )
    by_source = matches.filter(F.col("src_addr").isNotNull()).groupBy("src_addr").agg(
        F.count(F.lit(1)).alias("_s"), pairs.alias("source_copy_number")
    )
    out = join_back(matches, by_target, ["tgt_addr"], "_t").drop("_t")
    out = join_back(out, by_source, ["src_addr"], "_s").drop("_s")
    out = out.withColumns({
        "target_copy_number": F.coalesce("target_copy_number", F.lit(1)), "source_copy_number": F.coalesce("source_copy_number", F.lit(1)),
        "override_records": F.coalesce("override_records", F.lit(0)),
    })
    extra = (F.col("override_records") > 0) & F.col("override_id").isNull()
    many_t, many_s = F.col("target_copy_number") > 1, F.col("source_copy_number") > 1
    side = first_match(
        [(many_t & many_s, BOTH_DUPE), (many_t, f"{target_name} {DUPE}"), (many_s, f"{source_name} {DUPE}")], NO_DUPE
    )
    overridden = (F.col("override_records") > 0) & (side != NO_DUPE)
    label = F.when(overridden, F.concat(F.lit(f"{OVERRIDDEN} "), side)).otherwise(side)
    return out.withColumn("extra_duplicate_flag", extra.cast("int")).withColumn("dupe_status", label)


def duplicate_members(matches: DataFrame, target: DataFrame, t: SiteColumns, override: str, deleted: str) -> DataFrame:
    """Every record of either side that matches at an address which more than one record of a side holds.

    ``matches`` is the result of ``match_direct`` and ``match_address``, where one target stands for all of an address;
    ``target`` is the table it was made from. Result: addr, side (``source`` or ``target``), id (text), copies (records of that
    side there), other_copies. One row per member and address, so the result is linear in the records, not in the pairs.
    """
    by_address = (F.col("match_method") == "ADDRESS") & F.col("override_id").isNull()
    named = matches.filter(~by_address).select(F.col("tgt_addr").alias("addr"), F.lit("target").alias("side"), F.col("target_id").cast("string").alias("id"))
    shared = matches.filter(by_address).select(F.col("tgt_addr").alias("addr")).distinct()
    free = with_address(target.filter(~F.col(deleted) & F.col(override).isNull()), t).select("addr", F.lit("target").alias("side"), F.col(t.id).cast("string").alias("id"))
    sources = matches.select(F.col("src_addr").alias("addr"), F.lit("source").alias("side"), F.col("source_id").cast("string").alias("id"))
    members = named.unionByName(free.join(shared, "addr", "left_semi")).unionByName(sources).filter(F.col("addr").isNotNull()).distinct()
    sizes = members.groupBy("addr").agg(F.count(F.lit(1)).alias("_n"), count_if(F.col("side") == "target").alias("_t"), count_if(F.col("side") == "source").alias("_s"))
    out = join_back(members, sizes.filter((F.col("_t") > 1) | (F.col("_s") > 1)), ["addr"], "_n", "inner")
    of_target = F.col("side") == "target"
    return out.select("addr", "side", "id", F.when(of_target, F.col("_t")).otherwise(F.col("_s")).alias("copies"), F.when(of_target, F.col("_s")).otherwise(F.col("_t")).alias("other_copies"))


def duplicate_exceptions(labelled: DataFrame, partner_addresses: DataFrame) -> DataFrame:
    """One target with two source rows at a partner's address is not treated as a duplicate."""
    known = partner_addresses.select(F.col("addr").alias("src_addr")).distinct().withColumn("_partner", F.lit(True))
    out = labelled.join(known, "src_addr", "left")
    excused = F.coalesce(F.col("_partner"), F.lit(False)) & (F.col("target_copy_number") == 1) & (F.col("source_copy_number") == 2)
    return out.withColumn("final_status", F.when(excused, NO_DUPE).otherwise(F.col("dupe_status"))).drop("_partner")


def resolve_links(labelled: DataFrame) -> DataFrame:
    """Links to send: rows that are no duplicate, or overridden ones that are not extra copies.

    An overridden link replaces every other link of the same source id.
    """
    send = labelled.filter(
        (F.col("final_status") == NO_DUPE) | (F.col("override_id").isNotNull() & (F.col("extra_duplicate_flag") == 0))
    ).select("target_id", "source_id", "override_id", "match_method").distinct()
    fixed = send.filter(F.col("override_id").isNotNull())
    others = send.join(fixed.select("source_id").distinct(), "source_id", "left_anti")
    return others.unionByName(fixed)


def created_by(links: DataFrame, source: DataFrame, source_id: str, rules: Sequence[tuple[Column, object]], name: str = "created_by") -> DataFrame:
    """Links with a creator label from ordered rules over the source row's columns."""
    side = source.withColumnRenamed(source_id, "_sid")
    return links.join(side, F.col("source_id") == F.col("_sid")).select(*links.columns, first_match(rules).alias(name))


def match_version_counts(v1: DataFrame, v2: DataFrame, a: str = "target_id", b: str = "source_id") -> DataFrame:
    """Targets, sources and pairs per version, and the difference, from one aggregate per version."""
    def totals(df: DataFrame, tag: str) -> DataFrame:
        return df.agg(F.count_distinct(a).alias(f"t{tag}"), F.count_distinct(b).alias(f"s{tag}"), F.count(F.lit(1)).alias(f"n{tag}"))

    both = with_figures(totals(v1, "1"), totals(v2, "2"))
    def row(label: str, pick) -> Column:
        return F.struct(F.lit(label).alias("version"), *[pick(x).alias(n) for x, n in (("t", "targets"), ("s", "sources"), ("n", "records"))])

    rows = [
        row("V1", lambda x: F.col(f"{x}1")), row("V2", lambda x: F.col(f"{x}2")),
        row("Difference", lambda x: F.col(f"{x}2") - F.col(f"{x}1")),
    ]
    return both.select(F.inline(F.array(*rows)))


def match_version_pairs(v1: DataFrame, v2: DataFrame, keys: Sequence[str] = ("target_id", "source_id")) -> DataFrame:
    """Every pair with NEW, LOST or KEPT."""
    a = v1.select(*keys).distinct().withColumn("_1", F.lit(True))
    b = v2.select(*keys).distinct().withColumn("_2", F.lit(True))
    change = F.when(F.col("_1").isNull(), "NEW").when(F.col("_2").isNull(), "LOST").otherwise("KEPT")
    return a.join(b, list(keys), "full_outer").select(*keys, change.alias("change"))


def match_overlap(pairs: DataFrame) -> DataFrame:
    """Kept pairs and their share of each version."""
    one = pairs.agg(*[count_if(F.col("change") == c).alias(c) for c in ("KEPT", "NEW", "LOST")])
    return one.select(
        F.col("KEPT").alias("in_both"), F.col("NEW").alias("only_v2"), F.col("LOST").alias("only_v1"),
        percent(F.col("KEPT"), F.col("KEPT") + F.col("LOST")).alias("pct_of_v1"),
        percent(F.col("KEPT"), F.col("KEPT") + F.col("NEW")).alias("pct_of_v2"),
    )


def lost_pair_causes(pairs: DataFrame, source: DataFrame, source_id: str, ref: str) -> DataFrame:
    """Lost pairs by what the source row stores now."""
    side = source.select(F.col(source_id).alias("source_id"), F.col(ref).alias("_ref"), F.lit(True).alias("_row"))
    rows = pairs.filter("change = 'LOST'").join(side, "source_id", "left")
    cause = first_match(
        [
            (F.col("_row").isNull(), "source row gone"), (F.col("_ref").isNull(), "no stored id"),
            (F.col("_ref") == F.col("target_id"), "stored id is this target"),
        ],
        "stored id is another target",
    )
    return rows.groupBy(cause.alias("cause")).agg(F.count(F.lit(1)).alias("pairs"))


def match_distribution(versions: Mapping[str, DataFrame], by: str) -> DataFrame:
    """Rows and distinct ids per version and label."""
    def one(name: str, df: DataFrame) -> DataFrame:
        return df.groupBy(F.col(by).cast("string").alias("label")).agg(
            F.count(F.lit(1)).alias("records"), F.count_distinct("target_id").alias("targets"), F.count_distinct("source_id").alias("sources")
        ).withColumn("version", F.lit(name))

    return reduce(lambda a, b: a.unionByName(b), [one(n, d) for n, d in versions.items()])


# ---- identities -------------------------------------------------------------------------------------------------

# The compared fields, points per matching field, and the confidence bands
FIELDS = ("first_name", "last_name", "email", "phone")
WEIGHTS = {"first_name": 25, "last_name": 25, "email": 30, "phone": 20}
BANDS = [(90, "90-100 (Very High)"), (70, "70-89 (High)"), (50, "50-69 (Medium)"), (30, "30-49 (Low)"), (0, "0-29 (Very Low)")]
SUBSETS = [c for n in range(1, 5) for c in combinations(FIELDS, n)]


def subset_score(fields: Sequence[str]) -> int:
    return sum(WEIGHTS[f] for f in fields)


def band(score: Column) -> Column:
    return first_match([(score >= low, label) for low, label in BANDS[:-1]], BANDS[-1][1])


def band_of(score: int) -> str:
    return next(label for low, label in BANDS if score >= low)


def identity_normalise(df: DataFrame, keep: Sequence[str], first: Column, last: Column, email: Column, phone: Column) -> DataFrame:
    """The kept columns and the four comparable fields."""
    return df.select(
        *keep, norm_name(first).alias("first_name"), norm_name(last).alias("last_name"), norm_email(email).alias("email"),
        norm_phone(phone).alias("phone"),
    )


def _text(fields: Sequence[str]) -> Column:
    return F.concat_ws("\u0001", *fields)


def _hashes(text: Column) -> list[Column]:
    """A 128-bit key of a text as two differently seeded 64-bit hashes: fixed width, cheap to shuffle and compare."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


IDENT, SUBSET = ["i1", "i2"], ["mask", "h1", "h2"]
LEVELS = [[n for n, s in enumerate(SUBSETS) if len(s) in sizes] for sizes in ((1,), (2,), (3, 4))]


def _subset_keys(chosen: Mapping[int, Column]) -> Column:
    """Rows (mask, h1, h2) for each field subset whose condition holds and whose fields are all present."""
    parts = []
    for n, condition in chosen.items():
        present = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in SUBSETS[n]])
        parts.append(F.when(condition & present, F.struct(F.lit(n).alias("mask"), *_hashes(_text(SUBSETS[n])))))
    return F.inline(F.array_compact(F.array(*parts)))


def _identity(df: DataFrame) -> DataFrame:
    """Adds the key (i1, i2) of the four fields together; NULL is kept apart from any value."""
    known = [F.coalesce(F.col(f), F.lit("\u0000")) for f in FIELDS]
    return df.withColumns(dict(zip(IDENT, _hashes(F.concat_ws("\u0001", *known)))))


def _exact(weights: Mapping[int, int]) -> str:
    """SQL for sum of weight x (partners agreeing on exactly subset n), in terms of the counts c0..c14.

    c<m> counts partners agreeing on at least subset m; inclusion-exclusion turns the wanted sum into one linear
    combination, worked out here so that the plan holds a single short expression.
    """
    factors = [0] * len(SUBSETS)
    for n, weight in weights.items():
        for m, s in enumerate(SUBSETS):
            if set(SUBSETS[n]) <= set(s):
                factors[m] += weight * (-1) ** (len(s) - len(SUBSETS[n]))
    return " + ".join(f"({f} * c{m})" for m, f in enumerate(factors) if f) or "0L"


def shared_keys(df: DataFrame, against: DataFrame | None = None, group: str | None = None) -> DataFrame:
    """(identity, ``w``, subset key, ``partners``) for each distinct identity of ``df`` and each of its field subsets that
    partners share; ``w`` records have the identity. Stored.

    Equal identities are merged first. Subsets are built level by level, and larger ones only for identities all of whose
    smaller subsets are shared: what no partner has in common with a record on two fields, none has on three. Most
    identities thus end after their four single fields, instead of going into a shuffle 15 times.

    With ``group`` partners of the same group do not count; with ``against`` the partners are the records of that table.
    """
    tag = [group] if group else []

    def merge(rows: DataFrame, side: int) -> DataFrame:
        merged = _identity(rows).groupBy(*IDENT, *FIELDS, *tag).agg(F.count(F.lit(1)).alias("w"))
        return merged.withColumn("side", F.lit(side))

    rows = merge(df, 0) if against is None else merge(df, 0).unionByName(merge(against, 1))
    who = [*IDENT, *FIELDS, *tag, "w", "side"]
    found, allowed = [], F.lit(0)
    for level in LEVELS:
        smaller = {n: sum(1 << m for m in range(len(SUBSETS)) if len(SUBSETS[m]) == min(len(SUBSETS[k]) for k in level) - 1 and set(SUBSETS[m]) < set(SUBSETS[n])) for n in level}
        keyed = rows.select(*who, _subset_keys({n: allowed.bitwiseAND(need) == need for n, need in smaller.items()}))
        if group:
            parts = keyed.groupBy(*SUBSET, group).agg(F.count(F.lit(1)).alias("_rows"), F.sum("w").alias("g"))
            totals = parts.groupBy(*SUBSET).agg(F.sum("g").alias("n"), F.count(F.lit(1)).alias("_groups")).filter("_groups > 1")
            stats = join_back(parts, totals, SUBSET, "_groups", "inner").select(*SUBSET, group, "_rows", (F.col("n") - F.col("g")).alias("partners"))
        elif against is None:
            stats = keyed.groupBy(*SUBSET).agg(F.count(F.lit(1)).alias("_rows"), (F.sum("w") - 1).alias("partners")).filter("partners > 0")
        else:
            stats = keyed.groupBy(*SUBSET).agg(
                F.count(F.lit(1)).alias("_rows"), F.sum(F.col("w") * F.col("side")).alias("partners"), F.max(1 - F.col("side")).alias("_mine")
            ).filter("partners > 0 AND _mine = 1").drop("_mine")
        hits = cut(join_back(keyed, stats, [*SUBSET, *tag], "_rows", "inner").drop("_rows"), "shared-keys")
        found.append(hits.filter("side = 0"))
        rows = hits.groupBy(*who).agg(F.bit_or(F.expr("shiftleft(1, mask)")).alias("_shared"))
        allowed = F.col("_shared")
    return reduce(lambda x, y: x.unionByName(y), found).select(*IDENT, *tag, "w", *SUBSET, "partners")


def partner_counts(df: DataFrame, against: DataFrame | None = None, group: str | None = None) -> DataFrame:
    """Per distinct identity: records sharing it (``w``) and, as c0..c14, partners agreeing on at least each subset.

    Agreement on exactly a subset follows from those counts (see ``_exact``), so no pair is formed and
    the work stays linear however common a name is. Identities without any partner are left out.
    """
    tag = [group] if group else []
    rows = shared_keys(df, against, group)
    return rows.groupBy(*IDENT, *tag, "w").agg(
        *[F.expr(f"coalesce(sum(CASE WHEN mask = {m} THEN partners END), 0L)").alias(f"c{m}") for m in range(len(SUBSETS))]
    )


def _total(pick) -> Column:
    """Partners whose score is picked."""
    return F.expr(_exact({n: 1 for n, s in enumerate(SUBSETS) if pick(subset_score(s))}))


def identity_profile(df: DataFrame, key: str, against: DataFrame | None = None) -> DataFrame:
    """Per record: candidates sharing any field, how many score in each band, and the best score.

    The score of a pair is the sum of the points of its equal fields, so it is fixed by the subset they agree on.
    """
    counts = partner_counts(df, against)
    # A partner agreeing on at least a subset scores that much or more, so the largest such subset is the best score.
    best = F.expr("greatest(" + ", ".join(f"CASE WHEN c{n} > 0 THEN {subset_score(s)} ELSE 0 END" for n, s in enumerate(SUBSETS)) + ")")
    bands = [_total(lambda p, b=label: band_of(p) == b).alias(f"band_{low}") for low, label in BANDS]
    figures = counts.select(
        *IDENT, "w", _total(lambda p: True).alias("candidates"), best.alias("highest_score"), *bands,
        _total(lambda p: p >= 80).alias("auto_flag"), _total(lambda p: 50 <= p < 80).alias("manual_review"),
    )
    out = join_back(_identity(df), figures, IDENT, "w")
    names = ["candidates", "highest_score", *[f"band_{low}" for low, _ in BANDS], "auto_flag", "manual_review"]
    return out.fillna(0, names).select(key, *FIELDS, *names)


def identity_links(df: DataFrame, key: str, min_score: int = 50) -> DataFrame:
    """Every record linked to the first record of each group it scores ``min_score`` or more with.

    Groups share the fields of one subset. Linking to the smallest id spans the group with one row per member
    instead of all pairs. The fields on which a record agrees with that first record form a subset of their own, whose
    first record is the same one; so the union of the subsets found gives the match booleans, and the score.
    """
    bits = F.element_at(F.array(*[F.lit(sum(1 << FIELDS.index(f) for f in s)) for s in SUBSETS]), F.col("mask") + 1)
    merged = _identity(df).groupBy(*IDENT, *FIELDS).agg(F.count(F.lit(1)).alias("w"), F.min(key).alias("_first"))
    wanted = {n: F.lit(True) for n, fields in enumerate(SUBSETS) if subset_score(fields) >= min_score}
    keyed = merged.select(*IDENT, "w", "_first", _subset_keys(wanted))
    groups = keyed.groupBy(*SUBSET).agg(F.count(F.lit(1)).alias("_rows"), F.sum("w").alias("_n"), F.min("_first").alias("linked_id"))
    found = join_back(keyed.select(*IDENT, "w", *SUBSET), groups.filter("_n > 1").drop("_n"), SUBSET, "_rows", "inner")
    links = found.groupBy(*IDENT, "w", "linked_id").agg(F.bit_or(bits).alias("bits"))
    per = links.groupBy(*IDENT, "w").agg(F.collect_list(F.struct("linked_id", "bits")).alias("_l"))  # 15 entries at most
    rows = join_back(_identity(df).select(key, *IDENT), per, IDENT, "w", "inner").select(key, F.inline("_l"))
    same = {f: F.col("bits").bitwiseAND(1 << n) != 0 for n, f in enumerate(FIELDS)}
    score = reduce(lambda a, b: a + b, [c.cast("int") * WEIGHTS[f] for f, c in same.items()])
    out = rows.filter(F.col(key) != F.col("linked_id"))
    return out.select(key, "linked_id", *[c.alias(f"{f}_matched") for f, c in same.items()], score.alias("score"), band(score).alias("band"))


def identity_patterns(df: DataFrame) -> DataFrame:
    """Unordered pairs per match pattern with their score, from counts alone."""
    counts = partner_counts(df)
    totals = counts.agg(*[F.expr(f"coalesce(sum(c{n} * w), 0L)").alias(f"c{n}") for n in range(len(SUBSETS))])
    rows = [
        "struct(" + ", ".join(f"{str(f in s).lower()} AS {f}_matched" for f in FIELDS)
        + f", CAST(({_exact({n: 1})}) / 2 AS BIGINT) AS occurrences, {subset_score(s)} AS score)"
        for n, s in enumerate(SUBSETS)
    ]
    return totals.selectExpr(f"inline(array({', '.join(rows)}))").filter("occurrences > 0")


def identity_score_distribution(patterns: DataFrame) -> DataFrame:
    """Pairs per confidence band."""
    return patterns.groupBy(band(F.col("score")).alias("band")).agg(F.sum("occurrences").alias("match_count"))


def identity_match_rate(profile: DataFrame, min_score: int = 70) -> DataFrame:
    """Share of records with a match of at least ``min_score``."""
    hit = count_if(F.col("highest_score") >= min_score)
    total = F.count(F.lit(1))
    return profile.agg(total.alias("total"), hit.alias("with_matches"), percent(hit, total).alias("match_rate"))


def serial_entities(profile: DataFrame, at_least: int = 5, min_score: int = 0) -> DataFrame:
    """Records with many matches; ``min_score`` must be the lower end of a band."""
    total = reduce(lambda a, b: a + b, [F.col(f"band_{low}") for low, _ in BANDS if low >= min_score])
    return profile.withColumn("match_count", total).filter(F.col("match_count") >= at_least)


def cross_group_matches(df: DataFrame, key: str, group: str, min_score: int = 70, at_least: int = 3) -> DataFrame:
    """Records matching ``at_least`` records of other groups with ``min_score`` or more, and the mean score."""
    counts = partner_counts(df, group=group)
    strong = {n: subset_score(s) for n, s in enumerate(SUBSETS) if subset_score(s) >= min_score}
    total, points = F.expr(_exact({n: 1 for n in strong})), F.expr(_exact(strong))
    figures = counts.select(*IDENT, group, "w", total.alias("match_count"), points.alias("_points")).filter(F.col("match_count") >= at_least)
    out = join_back(_identity(df), figures, [*IDENT, group], "w", "inner")
    return out.select(key, group, "match_count", F.round(F.col("_points") / F.col("match_count"), 4).alias("avg_score"))


def account_lookup(
    accounts: DataFrame, users: DataFrame, account_id: str, name: str, modified: str, owners: Mapping[str, str], user_id: str, user_name: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The latest account per normalised name (one row, smallest id on ties) with the names of its owners.

    ``owners`` maps an output name to the account column holding that owner's user id. The result has unique
    ``name_key`` and can be joined under several roles (company, manager) without repeating rows.
    """
    key = F.trim(F.lower(F.col(name)))
    newest = latest_per_key(
        accounts.withColumn("name_key", key).filter("name_key <> ''"), ["name_key"], [F.col(modified).desc_nulls_last(), F.col(account_id)]
    )
    out = newest.select("name_key", account_id, name, *keep, *owners.values())
    for label, column in owners.items():
        side = users.select(F.col(user_id).alias("_u"), F.col(user_name).alias(label))
        out = out.join(side, F.col(column) == F.col("_u"), "left").drop("_u")
    return out.drop(*[c for c in set(owners.values()) if c not in keep])
