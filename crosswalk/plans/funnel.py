"""One row per applicant with channel use, verification outcomes, rulings and issues, and the KPI tables.

Every child table is reduced to one row per applicant before it is joined, so the reports are plain sums over
applicants: no repeated rows and no distinct counts over exploded joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.functions.columns import count_if, elapsed, first_match, moment, percent
from crosswalk.operators.aggregates import kpi_rows
from crosswalk.operators.history import feature_effective_join


@dataclass(frozen=True)
class Words:
    """What a report calls its findings."""

    paired: str = "channel with identity"
    channel_only: str = "channel, identity missing"
    identity_only: str = "identity without channel"
    neither: str = "neither"
    complete: str = "complete"
    no_identity: str = "identity step left out"
    no_result: str = "result step left out"
    other_way: str = "channel not used"
    accepted: str = "accepted"
    rejected: str = "rejected"
    waiting: str = "in review"
    undecided: str = "nothing to decide"
    nothing: str = "nothing sent"
    late: str = "late"
    on_time: str = "on time"
    no_reason: str = "no reason given"


@dataclass(frozen=True)
class Facts:
    """What is known of an applicant, as conditions on the columns of a report."""

    used: Column  # the main channel
    identified: Column  # there is an identity check
    decided: Column  # there is a result on income or assets
    accepted: Column
    rejected: Column


def facts(main: str) -> Facts:
    either = lambda end: (F.col(f"income_{end}") > 0) | (F.col(f"asset_{end}") > 0)
    return Facts(F.col(f"used_{main}") > 0, F.col("id_count") > 0, either("count"), either("accepted"), either("rejected"))


def eligible_applicants(applicants: DataFrame, features: DataFrame, key: str, submitted: str, enabled_at: str, since: str, created: str) -> DataFrame:
    """Applicants of entities with the feature, submitted on or after it was enabled, created since a moment."""
    rows = applicants.filter(F.col(created) >= moment(since))
    return feature_effective_join(rows, features, key, submitted, enabled_at)


def usage_flags(sources: DataFrame, applicant: str, submission: str, source_type: str, ts: str, channels: Mapping[str, str], main: str) -> DataFrame:
    """Per applicant: used each channel, submissions in all and by the main channel, first and last main time.

    ``channels`` maps an output name to a source type; ``main`` is one of the output names.
    """
    primary = F.col(source_type) == channels[main]
    # One row per submission first: both distinct counts become plain sums, with no row expansion for them.
    per = sources.groupBy(applicant, submission).agg(
        *[F.max((F.col(source_type) == v).cast("int")).alias(f"used_{n}") for n, v in channels.items()],
        F.min(F.when(primary, F.col(ts))).alias("_first"), F.max(F.when(primary, F.col(ts))).alias("_last"),
    )
    return per.groupBy(applicant).agg(
        *[F.max(f"used_{n}").alias(f"used_{n}") for n in channels], F.count(submission).alias("total_submissions"),
        count_if(F.col(submission).isNotNull() & (F.col(f"used_{main}") == 1)).alias(f"{main}_submissions"),
        F.min("_first").alias(f"first_{main}_at"), F.max("_last").alias(f"last_{main}_at"),
    )


def verification_outcomes(
    rows: DataFrame, applicant: str, id_col: str, kinds: Mapping[str, tuple[str, str]], accepted: str, rejected: str, condition: Column
) -> DataFrame:
    """Per applicant and kind of verification: how many, accepted, rejected, largest status text and distinct reasons.

    ``kinds`` maps a prefix to its status and reason columns; all kinds come from one aggregate over the rows. The channel
    condition restricts the rows counted, not the applicants kept. Reasons are listed per applicant, who has few;
    ``outcome_reasons`` has them as rows.
    """
    aggs = []
    for prefix, (status, reason) in kinds.items():
        aggs += [
            F.max((F.col(status) == accepted).cast("int")).alias(f"{prefix}_accepted"), F.max((F.col(status) == rejected).cast("int")).alias(f"{prefix}_rejected"),
            F.max(status).alias(f"{prefix}_status"), F.array_join(F.array_sort(F.collect_set(reason)), ", ").alias(f"{prefix}_reasons"),
        ]
    out = rows.filter(condition).groupBy(applicant).agg(F.count_distinct(id_col).alias("_n"), *aggs)
    return out.withColumns({f"{prefix}_count": F.col("_n") for prefix in kinds}).drop("_n")


def outcome_reasons(rows: DataFrame, applicant: str, kinds: Mapping[str, tuple[str, str]], condition: Column) -> DataFrame:
    """Kind, reason, and how many rows and applicants have it: a row per reason, however many there are."""
    each = F.array(*[F.struct(F.lit(prefix).alias("kind"), F.col(reason).alias("reason")) for prefix, (_, reason) in kinds.items()])
    per = rows.filter(condition).select(applicant, F.inline(each)).filter("reason IS NOT NULL").groupBy("kind", "reason", applicant).agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy("kind", "reason").agg(F.sum("_n").alias("rejections"), F.count(F.lit(1)).alias("applicants"))


def applicant_report(
    applicants: DataFrame, children: Sequence[DataFrame], applicant: str, submitted: str, main: str, as_of: str,
    issues: Sequence[tuple[Column, str]] = (), late_hours: int = 48, words: Words = Words(),
) -> DataFrame:
    """One row per applicant: pairing of channel and identity, results, recommendation, use, issue and timeliness.

    ``children`` have one row per applicant: ``usage_flags``, (applicant, id_count, id_passed), and ``verification_outcomes`` of
    income and asset. Applicants without child rows have counts of 0. ``issues`` are conditions, most pressing first, on the columns of the report
    (see ``facts``) with the name of the issue; ``duration_minutes`` is the time between first and last use of the main channel.
    """
    out = applicants
    for child in children:
        out = out.join(child, applicant, "left")
    out = out.fillna(0, [c for c in out.columns if c.startswith("used_") or c.endswith(("_count", "_accepted", "_rejected", "_submissions", "_passed"))])
    known = facts(main)
    hours = elapsed(F.col(submitted), moment(as_of), "hour")
    out = out.withColumns({"duration_minutes": elapsed(F.col(f"first_{main}_at"), F.col(f"last_{main}_at"), "minute"), "hours_since_submission": hours})
    with_channel = F.when(known.identified, words.paired).otherwise(words.channel_only)
    without = F.when(known.identified, words.identity_only).otherwise(words.neither)
    steps = F.when(~known.identified, words.no_identity).when(~known.decided, words.no_result).otherwise(words.complete)
    result = {p: F.when(F.col(f"{p}_accepted") > 0, words.accepted).otherwise(words.rejected) for p in ("income", "asset")}
    return out.withColumns({
        "pairing": F.when(known.used, with_channel).otherwise(without),
        "income_result": result["income"],
        "asset_result": result["asset"],
        "recommendation": first_match([(known.accepted, words.accepted), (known.rejected, words.rejected), (known.decided, words.waiting)], words.undecided),
        "usage": F.when(known.used, steps).otherwise(words.other_way),
        "issue": first_match(list(issues)) if issues else F.lit(None).cast("string"),
        "timeliness": F.when(hours > late_hours, words.late).otherwise(words.on_time),
    })


def ruling_reason(report: DataFrame, channels: Sequence[str], names: Mapping[str, str], words: Words = Words()) -> DataFrame:
    """Simple ruling and the reason behind it. ``names`` says what the income and asset results are called."""
    any_use = reduce(lambda a, b: a | b, [F.col(f"used_{c}") > 0 for c in channels])
    why = {p: F.when(F.col(f"{p}_reasons") != "", F.col(f"{p}_reasons")).otherwise(words.no_reason) for p in names}
    good = [(F.col(f"{p}_accepted") > 0, F.lit(f"{label} {words.accepted}")) for p, label in names.items()]
    bad = [(F.col(f"{p}_rejected") > 0, F.concat(F.lit(f"{label} {words.rejected}: "), why[p])) for p, label in names.items()]
    any_of = lambda found: reduce(lambda a, b: a | b, [c for c, _ in found])
    return report.withColumns({
        "ruling": first_match([(any_of(good), words.accepted), (any_of(bad), words.rejected), (any_use, words.waiting)], words.nothing),
        "reason": first_match([*good, *bad, (any_use, words.waiting)], words.nothing),
    })


def kpi_table(report: DataFrame, main: str, names: Mapping[str, str]) -> DataFrame:
    """The KPI rows, from one aggregate over the report."""
    known = facts(main)
    one = report.agg(
        F.count(F.lit(1)).alias("total"), count_if(known.used).alias("channel"), count_if(known.identified).alias("identity"),
        count_if(known.used & known.identified).alias("paired"), count_if(known.accepted).alias("passed"), count_if(known.rejected).alias("failed"),
        count_if(F.col("issue").isNotNull()).alias("issues"),
    )
    base = {"total": None, "channel": "total", "identity": "total", "paired": "channel", "passed": "channel", "failed": "channel", "issues": "total"}
    return kpi_rows(one, [(label, k, base[k], None if base[k] is None else f"Share of {base[k]}") for k, label in names.items()])


def issue_breakdown(report: DataFrame, applicant: str, place: str, submitted: str) -> DataFrame:
    """Applicants, places and time range per issue."""
    return report.filter(F.col("issue").isNotNull()).groupBy("issue").agg(
        F.count(F.lit(1)).alias("applicants"), F.count_distinct(place).alias("places"), F.min(submitted).alias("first_at"), F.max(submitted).alias("last_at")
    )


def issue_places(report: DataFrame, place: str) -> DataFrame:
    """The places each issue occurs at, as rows (a list would grow with the data)."""
    return report.filter(F.col("issue").isNotNull()).groupBy("issue", place).agg(F.count(F.lit(1)).alias("applicants"))


def place_performance(report: DataFrame, place: str, main: str) -> DataFrame:
    """Adoption, correlation and success rates per place."""
    known = facts(main)
    users = count_if(known.used)
    return report.groupBy(place).agg(
        F.count(F.lit(1)).alias("total_applicants"), users.alias("channel_users"), percent(users, F.count(F.lit(1))).alias("adoption_pct"),
        percent(count_if(known.used & known.identified), users).alias("id_correlation_pct"),
        percent(count_if(known.accepted), users).alias("success_pct"), count_if(F.col("issue").isNotNull()).alias("issues"),
    )
