"""Selection, text rules and column expressions on small frames with nulls, blanks and ties."""

import pytest
from pyspark.sql import functions as F

from crosswalk.functions import columns as C
from crosswalk.operators import filters as L
from crosswalk.operators import windows as W


@pytest.fixture
def names(spark):
    data = [
        (1, "Oak Test House", "c1"), (2, "QA Tower", "c1"), (3, None, "c2"), (4, "Plain", "c2"), (5, "", "c3"), (6, "Contest Hall", "c3"), (7, "exact one", "c4"),
    ]
    return spark.createDataFrame(data, "id int, name string, company string")


def test_null_text_is_no_match(names, rows):
    got = L.exclusion_filter(names, ["name"], ["% TEST %", "%QA%"], ["EXACT ONE"])
    assert rows(got, "id") == [(3,), (4,), (5,), (6,)]


def test_exempt_id_wins_over_a_match(names, rows):
    got = L.exclusion_filter(names, ["name"], ["% TEST %", "%QA%"], ids={"company": ["c2"]}, exempt={"company": ["c1"]})
    assert rows(got, "id") == [(1,), (2,), (5,), (6,), (7,)]


def test_keyword_rules_first_match_and_counts(names, rows):
    rules = [("contains", "test", "test"), ("regex", "^qa[ _-]", "qa"), ("ends", "house", "house")]
    assert rows(L.keyword_classifier(names, "name", rules, "other"), "id", "detection") == [(1, "test"), (2, "qa"), (6, "test")]
    assert rows(L.keyword_counts(names, "name", rules)) == [("house", 1), ("qa", 1), ("test", 2)]


def test_suspicion_score_ignores_null_signals(spark, rows):
    df = spark.createDataFrame([(1, None, "ab"), (2, 0, "long name"), (3, 0, "1ab")], "id int, unit int, name string")
    signals = {"no_units": F.col("unit") == 0, "digit": F.col("name").rlike("^[0-9]"), "short": F.length("name") < 5}
    assert rows(L.suspicion_score(df, signals, [F.col("id")]), "id", "suspicion_score") == [(3, 3)]


@pytest.mark.parametrize(
    "text, number, legacy, base",
    [
        ("Oak Phase 2", 2, 2, "oak"), ("Oak Phase IV", 4, 0, "oak"), ("Oak Phase 10", 10, 1, "oak"), ("Oak phase ii North", 2, 0, "oaknorth"), ("Oak", None, 0, "oak"),
        ("Oak Phase Village", None, 0, "oakphasevillage"), ("Oak phase3 ", 3, 3, "oak"), (None, None, 0, None), ("Phase x", 10, 0, ""),
        ("Oak Phase XI", 11, 0, "oak"), ("Oak Phase XLIX", 49, 0, "oak"), ("Oak Phase MCMXCIV", 1994, 0, "oak"), ("Oak Phase IIX", None, 0, "oakphaseiix"),
        ("Oak Phase 30000000000", 30000000000, 3, "oak"), ("Éclair Straße 東京 Phase 2", 2, 2, "eclairstraße東京"),
    ],
)
def test_series_number(spark, text, number, legacy, base):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(C.series_number(F.col("t")), C.series_number(F.col("t"), legacy=True), C.series_base(F.col("t"))).first()
    assert tuple(got) == (number, legacy, base)


def test_first_match_skips_null_conditions(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 50)], "id int, v int")
    assert rows(df.select("id", C.first_match([(F.col("v") > 10, "big"), (F.col("v") > 1, "some")], "none"))) == [(1, "none"), (2, "some"), (3, "big")]


def test_optional_filter_none_means_all(names, rows):
    assert L.optional_filter(names, {"company": None}).count() == 7
    assert rows(L.optional_filter(names, {"company": "c1"}), "id") == [(1,), (2,)]


def test_time_ranges_are_half_open(spark, rows):
    data = [(1, "2024-01-01 00:00:00"), (2, "2024-01-01 23:59:59"), (3, "2024-01-02 00:00:00"), (4, None)]
    df = spark.createDataFrame(data, "id int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert rows(df.filter(L.today("t", "2024-01-01 00:00:00")), "id") == [(1,), (2,)]
    assert rows(df.filter(L.relative_time("t", 24, "HOURS", "2024-01-02 00:00:00")), "id") == [(1,), (2,)]


def test_elapsed_counts_across_midnight_and_truncates(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 23:30:00' AS a, TIMESTAMP_NTZ '2024-01-02 01:29:59' AS b")
    got = df.select(C.elapsed(F.col("a"), F.col("b"), "hour"), C.elapsed(F.col("b"), F.col("a"), "minute")).first()
    assert tuple(got) == (1, -119)


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([], "v int")
    assert df.agg(C.percent(F.count(F.lit(1)), F.count(F.lit(1)))).first()[0] is None


def test_address_key_parts(spark):
    data = [(" 1 Main st", "Town", "ca", "123"), ("1 MAIN ST ", "town ", "CA", "00123-99"), ("1 Main St", "Town", "CA", None), ("1 Main St", " ", "CA", "00123")]
    df = spark.createDataFrame(data, "s string, c string, t string, z string")
    a, b, c, d = [r[0] for r in df.select(C.address_key(F.col("s"), F.col("c"), F.col("t"), F.col("z"))).collect()]
    assert a == b and a is not None and c is None and d is None


def test_identity_normalisers(spark):
    df = spark.createDataFrame([(" O'Neil ", "J.Doe+x@Mail.Com", "(555) 123-4567"), ("", "no at", "none"), ("José 東京", None, None)], "n string, e string, p string")
    got = [tuple(r) for r in df.select(C.norm_name(F.col("n")), C.norm_email(F.col("e")), C.norm_phone(F.col("p"))).collect()]
    assert got == [("oneil", "jdoe@mail.com", "5551234567"), (None, None, None), ("jose 東京", None, None)]


def test_norm_value(spark):
    df = spark.createDataFrame([("null",), (" ",), ("T",), ("0",), ("2024-01-02 03:04",)], "v string")
    assert [r[0] for r in df.select(C.norm_value(F.col("v"), "bool")).collect()] == [None, None, "true", "false", "2024-01-02 03:04"]
    assert df.select(C.norm_value(F.col("v"), "date")).collect()[4][0] == "2024-01-02"


def test_rollout_is_repeatable_and_near_its_share(spark):
    df = spark.range(20_000)
    a = L.rollout_sample(df, "id", "s1", 10)
    assert a.count() == L.rollout_sample(df, "id", "s1", 10).count() == a.intersect(L.rollout_sample(df.repartition(7), "id", "s1", 10)).count()
    assert 1800 < a.count() < 2200
    assert L.rollout_sample(df, "id", "s2", 10).intersect(a).count() < 400


@pytest.fixture
def versions(spark):
    data = [(1, "a", "2024-01-01"), (2, "a", "2024-01-03"), (3, "a", "2024-01-03"), (4, "b", None), (5, "b", "2024-01-01"), (6, None, "2024-01-01"), (7, None, "2024-01-01")]
    return spark.createDataFrame(data, "id int, k string, d string").withColumn("t", F.col("d").cast("timestamp_ntz"))


def test_rank_keeps_ties(versions, rows):
    assert rows(W.rank_keep_ties(versions, ["k"], "t"), "id") == [(2,), (3,), (5,)]


def test_running_copy_number_counts_peers_together(versions, rows):
    got = W.running_copy_number(versions, ["k"], "d")
    assert rows(got, "id", "copy_number") == [(1, 3), (2, 2), (3, 2), (4, 2), (5, 1), (6, 1), (7, 1)]


def test_newest_in_group(versions, rows):
    assert rows(W.newest_in_group(versions, ["k"], "t").filter("is_newest"), "id") == [(2,), (3,), (5,)]


def test_latest_by_greatest_defaults_missing_times(spark, rows):
    df = spark.sql("""SELECT * FROM VALUES (1, 'a', NULL, TIMESTAMP_NTZ '2024-01-02'), (2, 'a', TIMESTAMP_NTZ '2024-01-03', NULL), (3, 'b', NULL, NULL), (4, 'b', NULL, NULL) AS t(id, k, x, y)""")
    assert rows(W.latest_by_greatest(df, ["k"], ["x", "y"], [F.col("id")]), "id") == [(2,), (3,)]


def test_difference_with_null_in_the_list(spark, rows):
    a, b = spark.createDataFrame([(1,), (2,), (None,)], "k int"), spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(W.difference(a, b, ["k"])) == [(2,), (None,)]
    assert rows(W.intersection(a, b, ["k"])) == [(1,)]


def test_percent_of_total_of_no_rows(spark):
    df = spark.createDataFrame([], "k string, n bigint")
    assert W.percent_of_total(df, "n").count() == 0


def test_csv_columns_are_found_by_header(spark, rows, tmp_path):
    from pyspark.sql.types import StructType

    from crosswalk.sources.tables import read_csv_clean

    (tmp_path / "in.csv").write_text(" b ,more,a\n1,x,p\n1,x,p\n2,y, \n")
    schema = StructType.fromDDL("a string, b int")
    assert rows(read_csv_clean(spark, str(tmp_path / "in.csv"), schema, "a", {"b": "n"})) == [("p", 1)]
    with pytest.raises(ValueError, match="c"):
        read_csv_clean(spark, str(tmp_path / "in.csv"), StructType.fromDDL("a string, c int"), "a")
