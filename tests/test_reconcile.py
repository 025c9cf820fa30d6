"""Two-system comparison on small frames: nulls, deleted rows, ties, repeated keys, empty sides."""

import pytest
from pyspark.sql import functions as F

from crosswalk.operators import checks as K
from crosswalk.operators import reconcile as R


@pytest.fixture
def source(spark):
    data = [(1, "k1", True, "2024-01-01"), (2, "k1", None, "2024-01-05"), (3, "k1", False, "2024-01-05"), (4, "k2", None, None), (5, None, True, "2024-01-01"), (3, "k1", False, "2024-01-05")]
    return spark.createDataFrame(data, "id int, key string, flag boolean, d string").withColumn("t", F.col("d").cast("timestamp_ntz"))


@pytest.fixture
def target(spark):
    data = [("t1", "k1", False, "2024-01-01", None), ("t2", "k1", False, "2024-01-09", True), ("t3", "k2", True, "2024-01-01", False), ("t4", "k9", False, None, True)]
    return spark.createDataFrame(data, "tid string, key string, deleted boolean, m string, flag boolean")


def aggregated(source):
    return R.aggregate_many_to_one(source, "key", "id", {"flag": "t"}, "t", ["d"])


def test_aggregate_many_to_one(source, rows):
    got = aggregated(source)
    assert rows(got, "key", "id", "flag", "active_count", "unique_count", "is_multi", "total_flag_count") == [
        ("k1", 3, True, 4, 3, True, 1), ("k2", 4, False, 1, 1, False, 0), (None, 5, True, 1, 1, False, 1),
    ]


def test_create_queue_treats_a_deleted_target_as_absent(source, target, rows):
    got = R.create_queue(aggregated(source), target, "key", "key", F.col("deleted"))
    assert rows(got, "key") == [("k2",)]


def test_update_queue_takes_the_newest_live_target(source, target, rows):
    got = R.update_queue(aggregated(source), target, "key", "key", F.col("deleted"), [F.col("m").desc_nulls_last()], ["tid"])
    assert rows(got, "key", "tid") == [("k1", "t2")]


def test_create_and_update_cover_every_key(source, target):
    agg = aggregated(source).filter("key IS NOT NULL")
    n = R.create_queue(agg, target, "key", "key", F.col("deleted")).count()
    m = R.update_queue(agg, target, "key", "key", F.col("deleted"), [F.col("m").desc_nulls_last()], ["tid"]).count()
    assert n + m == agg.count()


def test_flag_mismatch_null_safe_or_plain(source, target, rows):
    agg = aggregated(source)
    safe = R.flag_mismatch(agg, target, "key", "key", {"flag": "flag"})
    plain = R.flag_mismatch(agg, target, "key", "key", {"flag": "flag"}, null_safe=False)
    assert rows(safe, "tid") == [("t1",), ("t4",)] and rows(plain, "tid") == [("t4",)]


def test_pivot_flags(spark, rows):
    df = spark.createDataFrame([(1, "a", "on"), (1, "b", None), (2, "b", "off"), (2, "c", "on")], "id int, code string, state string")
    got = R.pivot_flags(df, "id", "code", F.col("state") == "on", {"a": "fa", "b": "fb"})
    assert rows(got) == [(1, True, False), (2, False, False)]


def test_enrich_latest_defaults_and_deleted_parent(spark, rows):
    left = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, pid int")
    right = spark.createDataFrame([("1", 1, True), ("1", 2, None), ("9", 1, True)], "ref string, v int, flag boolean")
    parents = spark.createDataFrame([(10, "P", False), (20, "Q", True)], "id int, name string, gone boolean").filter("NOT gone")
    got = R.enrich_latest(left, right, "id", "ref", [F.desc("v")], ["flag"], ["v"], parents, ("pid", "id"), {"name": "pname"})
    assert rows(got, "id", "flag", "v", "pname") == [(1, False, 2, "P"), (2, False, None, None), (3, False, None, None)]


def test_star_chain_skips_edges_that_only_repeat_rows(spark, rows):
    root = spark.createDataFrame([(1, 7), (2, None)], "id int, fk int")
    dim = spark.createDataFrame([(7, 3, "seven")], "dk int, far int, label string")
    far = spark.createDataFrame([(3, "f")], "fk2 int, name string")
    many = spark.createDataFrame([(1, "x"), (1, "y")], "mid int, w string")
    edges = [R.Edge(dim, ["fk"], ["dk"]), R.Edge(far, ["far"], ["fk2"]), R.Edge(many, ["id"], ["mid"])]
    got = R.star_left_chain(root, edges, ["id", "name"])
    assert rows(got) == [(1, "f"), (2, None)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2


def test_env_compare_keeps_one_sided_rows(spark, rows):
    a = spark.createDataFrame([(1, True), (2, None), (3, True), (None, True)], "k int, f boolean")
    b = spark.createDataFrame([(1, False), (2, True), (4, True)], "k int, f boolean")
    got = R.env_compare(a, b, "k", ["f"])
    assert rows(got, "k", "data_source", "f_status", "sort_order") == [(1, "BOTH", "MISMATCH", 3), (2, "BOTH", "MATCH", 4), (3, "A_ONLY", "MATCH", 1), (4, "B_ONLY", "MATCH", 2)]
    assert dict(rows(R.env_compare_metrics(got, ["f"]))) == {"Total in A": 3, "Total in B": 3, "In both": 2, "Only in A": 1, "Only in B": 1, "Mismatch f": 1}


def test_partner_flag_does_not_repeat_rows(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, owner string")
    creds = spark.createDataFrame([("a", True), ("a", True), ("b", False)], "o string, live boolean")
    items = spark.createDataFrame([(2,), (2,)], "i int")
    assert rows(R.partner_flag(df, "owner", creds, "o", F.col("live"), items, ("id", "i")), "id", "api_flag", "integration_flag") == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]


def test_orphans(spark, rows):
    child = spark.createDataFrame([(1, "p"), (2, ""), (3, None), (4, "x")], "id int, pk string")
    parent = spark.createDataFrame([("p",), (None,)], "k string")
    assert rows(R.orphan_check(child, parent, "pk", "k"), "id", "reason") == [(2, "missing key"), (3, "missing key"), (4, "no parent")]


def test_exposure_counts_include_users_without_any(spark, rows):
    items = spark.createDataFrame([("a", True), ("b", True), ("c", False), (None, True)], "item string, live boolean")
    seen = spark.createDataFrame([(1, "a"), (1, "a"), (1, "c"), (2, "a"), (2, "b"), (3, "zz"), (None, "a"), (9, "a")], "u int, s string")
    users = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,), (None,)], "u int")
    args = (items, "item", F.col("live"), seen, "u", "s", users)
    assert rows(R.not_yet_exposed(*args)) == [(1, 2, 1), (2, 2, 0), (3, 2, 2), (4, 2, 2)]
    assert rows(R.unexposed_users(*args)) == [("a", 4, 2), ("b", 4, 3)]


def test_back_reference_of_repeated_records(spark, rows):
    missing = spark.createDataFrame([(1, "k"), (2, "k"), (3, "e"), (4, "zz"), (5, None)], "id int, key string")
    other = spark.createDataFrame([("k", "1"), ("k", "7"), ("k", None), ("e", ""), ("e", None), (None, "4")], "ok string, back string")
    got = R.key_in_other_system(missing, other, "key", "ok", "id", "back")
    assert rows(got, "id", "match_status") == [(1, "MATCHES"), (2, "MISMATCH"), (3, "BACK REFERENCE EMPTY"), (4, "KEY NOT FOUND")]


def test_insert_missing_with_a_null_id_in_the_target(spark, rows):
    target = spark.createDataFrame([(1, "x"), (None, "y")], "id int, v string")
    staged = spark.createDataFrame([(1, "new"), (2, "z")], "id int, v string")
    full, absent = R.insert_missing(staged, target, "id")
    assert rows(absent, "id") == [(2,)] and full.count() == 3


def test_value_drift_with_bad_json(spark, rows):
    a = spark.createDataFrame([(1, '{"p": "10.50"}'), (2, '{"p": "abc"}'), (3, None), (4, '{"p": 500}')], "k int, j string")
    b = spark.createDataFrame([(1, 10.6), (2, 3.0), (3, 4.0), (4, 10.0)], "k int, v double")
    assert rows(R.value_drift(a, b, "k", "j", "$.p", "v", 1), "k") == [(4,)]


def test_effective_access(spark, rows):
    ef = spark.createDataFrame([(1, "c", "enabled"), (2, "c", "enabled"), (3, "c", "off"), (4, "c", None)], "e int, code string, s string")
    uf = spark.createDataFrame([(2, "c", "off"), (3, "c", "enabled")], "e int, code string, us string")
    assert rows(R.effective_access(ef, uf, "code", "s", "us", ["e"]), "e", "available") == [(1, True), (2, False), (3, False), (4, False)]


def test_expect_drops_null_results_and_counts_them(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    rule = {"positive": F.col("v") > 0}
    assert rows(K.expect(df, rule), "id") == [(1,)]
    assert rows(K.expectation_counts(df, {"known": F.col("v").isNotNull()}, rule)) == [("known", "warn", 2, 1), ("positive", "drop", 1, 2)]


def test_snapshot_diff(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "w")], "k int, v string")
    assert rows(K.snapshot_diff(a, b, "k", ["v"])) == [(2, "changed"), (3, "removed"), (4, "added")]
    assert K.snapshot_diff(a, a, "k", ["v"]).count() == 0


def test_parity_of_a_table_with_itself_and_with_a_change(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "q")], "k int, v string, n string")
    same = K.dataset_parity(a, a, ["v"], ["n"], None)
    assert same.filter("difference <> 0").count() == 0 and K.key_differences(a, a, ["k"], ["v", "n"]).count() == 0
    b = a.withColumn("v", F.lit("x"))
    assert {r["check_name"] for r in K.dataset_parity(a, b, ["v"], ["n"], None).filter("difference <> 0").collect()} == {"distinct v"}


def test_key_profile(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(K.key_profile(df, "k")) == [(5, 2, 1, 2, 1)]


def test_compare_fields(spark, rows):
    a = spark.createDataFrame([(1, " x ", True), (2, "y", False), (3, "z", None)], "id int, name string, on boolean")
    b = spark.createDataFrame([("1", "x", "T"), ("2", "null", "0"), ("9", "q", "1")], "rid string, label string, flag string")
    got = K.compare_fields(a, b, "id", "rid", {"name": "label", "on": "flag"}, {"on": "bool"})
    assert rows(K.field_mismatches(got)) == [("2", "name", "y", None)]
    assert rows(K.compare_summary(got, 2)) == [(1, 1, 1, 1)]


def test_schema_diff(spark, rows):
    a = spark.createDataFrame([(1, None, 1.0)], "x int, y string, z double")
    b = spark.createDataFrame([], "x bigint, y string, w int")
    assert rows(K.schema_diff(a, b), "column_name", "status", "a_filled", "b_filled") == [
        ("w", "only in b", None, 0), ("x", "type differs", 1, 0), ("y", "same", 0, 0), ("z", "only in a", 1, None),
    ]


def test_sample_lookup(spark, rows):
    a = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "k int, v string")
    assert rows(K.sample_lookup(a, a.filter("k = 2"), "k", ["v"], 2)) == [(1, "a", False, None), (2, "b", True, "b")]


def test_flag_transitions_count_null_as_false(spark, rows):
    new = spark.createDataFrame([(1, True), (2, None), (3, False)], "k int, f boolean")
    cur = spark.createDataFrame([(1, None), (2, True), (3, None), (4, True)], "k int, f boolean")
    assert rows(K.flag_transitions(new, cur, "k", ["f"])) == [("f", 2, 1, 1, 3, 66.7)]
    assert rows(K.update_impact(new, cur, "k", ["f"])) == [("f", 3, 3, 100.0)]


def test_compare_fields_with_null_and_repeated_keys(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "x"), (3, None), (None, "n"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (3, None), (4, "z"), (None, "n")], "k int, v string")
    got = K.compare_fields(a, b, "k", "k", {"v": "v"})
    assert rows(got) == [
        ("1", "both", "v", "y", "x", False), ("2", "both", "v", "x", "x", True), ("3", "both", "v", None, None, True), ("4", "only in b", "v", None, "z", False),
        (None, "only in a", "v", "n", None, False), (None, "only in b", "v", None, "n", False),
    ]
