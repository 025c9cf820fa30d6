"""Whole plans: pipeline tiers, ledger, funnel, monitoring, master rows."""

import pytest
from pyspark.sql import functions as F

from crosswalk.operators import aggregates as A
from crosswalk.operators import checks as K
from crosswalk.operators import usage as U
from crosswalk.plans import funnel, hygiene, master, medallion, monitoring


def test_silver_drops_excluded_and_null_names(spark, rows):
    df = spark.createDataFrame([(1, "Good", "c"), (2, None, "c"), (3, "A TEST B", "c"), (1, "Good", "c")], "id int, name string, company string")
    from crosswalk.operators.filters import exclusion_condition

    got = medallion.silver(df, exclusion_condition(["name"], ["% TEST %"]), {"name": F.col("name").isNotNull()})
    assert rows(medallion.gold(got, {"id": "property_id", "name": "property_name"}, {})) == [(1, "Good")]


def test_ledger_and_survivors_account_for_everyone(spark, rows):
    df = spark.createDataFrame([(1, "p", 10), (2, "p", 20), (3, "q", None), (4, None, 5)], "id int, parent string, units int")
    ledger = hygiene.exclusion_ledger({"a": spark.createDataFrame([(1,), (1,)], "x int"), "b": spark.createDataFrame([(1,), (3,)], "y int")}, "id")
    assert rows(ledger) == [(1, "a"), (1, "b"), (3, "b")]
    left = hygiene.survivors(df, ledger, "id")
    assert left.count() + ledger.select("id").distinct().count() == df.count()
    got = {r["step"]: (r["entities"], r["parents"], r["units"]) for r in hygiene.exclusion_waterfall(df, ledger, "id", "parent", "units").collect()}
    assert got == {"Before Filtering": (4, 2, 35), "After Filtering": (2, 1, 25), "Delta (Excluded)": (2, 1, 10)}


def test_feature_types_keep_entities_without_features_apart(spark, rows):
    e = spark.createDataFrame([(1, "n"), (2, "n"), (3, "n"), (4, "m")], "id int, name string")
    f = spark.createDataFrame([(3, "idv"), (3, "idv"), (4, "idv"), (4, "bank")], "eid int, code string")
    got = A.feature_family_type(e, f, "id", "eid", "code", F.col("code").contains("idv"), "IDV Only", ["bank", "idv"])
    assert rows(got, "id", "feature_type", "feature_count") == [(1, "No Features", 0), (2, "No Features", 0), (3, "IDV Only", 1), (4, "Mixed Features", 2)]


@pytest.fixture
def report(spark):
    people = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q")], "id int, place string").withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    rows = [(1, "s1", "BANK", 0), (1, "s2", "BANK", 2), (1, "s2", "DOC", 5), (2, "s3", "DOC", 0)]
    subs = spark.createDataFrame(rows, "id int, sid string, kind string, h int").withColumn("t", F.timestamp_seconds(F.col("h") * 3600).cast("timestamp_ntz"))
    checks = spark.createDataFrame([(1, 11, "ACCEPTED", None, "BANK"), (1, 12, "REJECTED", "blurry", "BANK"), (2, 13, "REJECTED", "old", "DOC")], "id int, cid int, st string, why string, kind string")
    usage = funnel.usage_flags(subs, "id", "sid", "kind", "t", {"bank": "BANK", "doc": "DOC"}, "bank")
    income = funnel.verification_outcomes(checks, "id", "cid", {"income": ("st", "why")}, "ACCEPTED", "REJECTED", F.col("kind") == "BANK")
    asset = funnel.verification_outcomes(checks, "id", "cid", {"asset": ("st", "why")}, "ACCEPTED", "REJECTED", F.lit(False))
    ids = spark.createDataFrame([(1, 2, 1)], "id int, id_count int, id_passed int")
    issues = [(F.col("bank_submissions") > 3, "many"), (F.col("duration_minutes") > 60, "long")]
    return funnel.applicant_report(people, [usage, ids, income, asset], "id", "at", "bank", "2024-01-03 01:00:00", issues)


def test_applicants_without_the_channel_stay_with_zero_counts(report, rows):
    w = funnel.Words()
    assert rows(report, "id", "used_bank", "bank_submissions", "income_count", "recommendation", "usage", "issue", "timeliness") == [
        (1, 1, 2, 2, w.accepted, w.complete, "long", w.late), (2, 0, 0, 0, w.undecided, w.other_way, None, w.late), (3, 0, 0, 0, w.undecided, w.other_way, None, w.late),
    ]
    assert rows(report, "id", "pairing", "income_result") == [(1, w.paired, w.accepted), (2, w.neither, w.rejected), (3, w.neither, w.rejected)]
    named = {"income": "earnings", "asset": "savings"}
    assert rows(funnel.ruling_reason(report, ["bank", "doc"], named), "id", "ruling", "reason") == [(1, w.accepted, "earnings accepted"), (2, w.waiting, w.waiting), (3, w.nothing, w.nothing)]


def test_outcome_reasons_are_rows(spark, rows):
    df = spark.createDataFrame([(1, "old", None, True), (1, "old", "thin", True), (2, "old", None, True), (3, "odd", None, False)], "id int, a string, b string, here boolean")
    got = funnel.outcome_reasons(df, "id", {"x": ("s", "a"), "y": ("s", "b")}, F.col("here"))
    assert rows(got, "kind", "reason", "rejections", "applicants") == [("x", "old", 3, 2), ("y", "thin", 1, 1)]


def test_kpi_rows(report):
    got = {r["metric"]: (r["count"], r["percentage"]) for r in funnel.kpi_table(report, "bank", {"total": "T", "channel": "C", "passed": "P"}).collect()}
    assert got == {"T": (3, "100%"), "C": (1, "33.33%"), "P": (1, "100.00%")}


def test_alerts_fire_on_faults_and_on_missing_values(spark):
    row = spark.createDataFrame([(89.99, 51, None, 100, 1001)], "coverage double, null_names int, sync_age_hours int, create_queue int, update_queue int")
    assert {r["rule"]: r["pass"] for r in monitoring.daily_alerts(row).collect()} == {"coverage": False, "null_names": False, "sync_age_hours": False, "create_queue": True, "update_queue": False}


def test_trends_of_notes_without_a_number(spark):
    df = spark.sql("SELECT 'MONITORING' AS sync_type, TIMESTAMP_NTZ '2024-01-30' AS execution_timestamp, 'Coverage: 95.5% | Gap: none' AS notes")
    assert tuple(monitoring.audit_trends(df, {"c": "Coverage", "g": "Gap", "x": "Absent"}, "2024-01-31 00:00:00").first())[1:] == (95.5, None, None)


def test_queue_health_bands(spark):
    queue = spark.range(60)
    activity = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 23:00:00' AS last_sync_at, 3L AS records_today")
    got = monitoring.queue_health({"create": queue, "update": queue.limit(0)}, {"create": activity, "update": activity}, "2024-01-02 02:30:00", 2).collect()
    w = monitoring.QueueRules()
    assert [(r["status"], r["assessment"]) for r in got] == [("create: long", "short"), (w.stale, "empty")]
    late = monitoring.queue_health({"update": queue}, {"update": activity.withColumn("records_today", F.lit(0))}, "2024-01-02 10:30:00", 10, monitoring.QueueRules({"update": (59, 1)})).first()
    assert late["status"] == "update: too long"
    quiet = monitoring.queue_health({"update": queue}, {"update": activity.withColumn("records_today", F.lit(0))}, "2024-01-02 10:30:00", 10).first()
    assert quiet["status"] == w.idle


def test_quality_suite_finds_an_induced_fault(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', TRUE, TIMESTAMP_NTZ '2024-01-01'), ('a', FALSE, NULL), ('b', FALSE, NULL) AS t(k, f, at)")
    good = spark.sql("SELECT * FROM VALUES ('a', TRUE, TIMESTAMP_NTZ '2024-01-01', 2L), ('b', FALSE, CAST(NULL AS TIMESTAMP_NTZ), 1L) AS t(k, f, f_at, active_count)")
    bad = good.withColumn("f", F.lit(False))
    def run(agg):
        return {r["test"]: r["pass"] for r in K.sync_quality_suite(rows, agg, agg.limit(1), agg.limit(1), "k", "f", "at", F.lit(True), 0).collect()}

    assert all(run(good).values())
    assert [t for t, ok in run(bad).items() if not ok] == ["any flag gives true"]


def test_manager_master_is_one_row_per_normalised_name(spark, rows):
    p = spark.sql("""SELECT * FROM VALUES (1, ' Acme', 7, 'ACTIVE'), (2, 'ACME', 8, 'DISABLED'), (3, ' ', 7, 'ACTIVE'), (4, NULL, 7, 'ACTIVE'), (5, 'Zed', 9, 'DISABLED') AS t(id, m, c, status)""")
    p = p.withColumn("a", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn("b", F.col("a"))
    got = master.manager_master(p, "m", "id", "c", "status", "a", "b", spark.createDataFrame([(8,)], "x int"))
    assert rows(got, "name_key", "is_active", "property_count", "company_count", "channel") == [("acme", True, 2, 2, "Partner"), ("zed", False, 1, 1, "Direct")]


def test_references_are_distinct_per_text_and_cover_all_clauses(spark, rows):
    df = spark.createDataFrame([(1, "SELECT 1"), (2, "insert into app.a.t select * from app.a.s join `app.a.s` x"), (3, None)], "id int, q string")
    got = U.references(df, "q", r"(?:from|join|into)\s+[`]?app\.(\w+\.\w+)", "n")
    assert rows(got, "id", "n") == [(2, "a.s"), (2, "a.t")]


def test_duplicate_triage_levels(spark, rows):
    df = spark.createDataFrame([(1, 2, None), (2, 2, True), (3, 0, False), (4, 0, True)], "id int, n int, here boolean")
    assert rows(A.duplicate_triage(df, "n", F.col("here")), "id", "priority_score", "priority_level") == [(1, 25, "P1 - URGENT"), (2, 20, "P2 - HIGH"), (3, 5, "P3 - MEDIUM"), (4, 0, "P4 - LOW")]


def test_exposure_keeps_unseen_items(spark, rows):
    items = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2024-01-01'), (2, TIMESTAMP_NTZ '2024-01-01') AS t(i, p)")
    views = spark.sql("SELECT * FROM VALUES (1, 'u', TIMESTAMP_NTZ '2024-01-01 02:00:00'), (1, 'u', TIMESTAMP_NTZ '2024-01-01 04:00:00') AS t(vi, u, v)")
    assert rows(A.exposure_metrics(items, views, "i", "vi", "u", "p", "v"), "i", "views", "unique_users", "avg_hours_to_view") == [(1, 2, 1, 3.0), (2, 0, 0, None)]


def test_empty_frames_give_one_row_of_nothing(spark):
    empty = spark.createDataFrame([], "status string, p int")
    got = A.kpi_summary(empty, "status", {"passed": "PASS"}, {"parents": "p"}, ["passed"]).first()
    assert tuple(got) == (0, 0, 0, None)
