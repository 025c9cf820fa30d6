"""Events in time order against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from crosswalk.operators import history as H


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(5)
    data = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(20)}", rng.choice("abc"), f"2024-01-{1 + rng.randrange(9):02d} {rng.randrange(3):02d}:00:00") for i in range(400)]
    return spark.createDataFrame(data, "id int, k string, s string, d string").withColumn("t", F.col("d").cast("timestamp_ntz")).drop("d").cache()


def test_pair_average_equals_all_pairs(log):
    recs = log.collect()
    spans = [(b["t"] - a["t"]).total_seconds() / 60 for a in recs for b in recs if a["k"] == b["k"] and a["s"] == "a" and b["s"] == "b" and b["t"] > a["t"]]
    got = H.pair_average(log, "k", "s", "t", "a", "b").first()
    assert got["pairs"] == len(spans) and got["avg_minutes"] == pytest.approx(sum(spans) / len(spans), abs=1e-3)


@pytest.mark.parametrize("rows", [20, 1000])
def test_pair_average_of_a_hot_hour(log, rows):
    """A key with a third of all events in one hour, cut into pieces, with starts and ends at equal times."""
    hot = log.withColumn("t", F.when(F.col("k") == "hot", F.timestamp_seconds(F.lit(1704070800) + F.col("id") % 40).cast("timestamp_ntz")).otherwise(F.col("t")))
    recs = hot.collect()
    spans = [(b["t"] - a["t"]).total_seconds() / 60 for a in recs for b in recs if a["k"] == b["k"] and a["s"] == "a" and b["s"] == "b" and b["t"] > a["t"]]
    got = H.pair_average(hot, "k", "s", "t", "a", "b", "hour", rows).first()
    assert got["pairs"] == len(spans) and got["avg_minutes"] == pytest.approx(sum(spans) / len(spans), abs=1e-3)


@pytest.mark.parametrize("size", [15, 1000])
@pytest.mark.parametrize("open_covers", [False, True])
def test_period_gaps_of_a_hot_month_equal_brute_force(spark, size, open_covers):
    """One key holds most periods, nearly all of them in one month; some have no end."""
    rng = random.Random(3)
    at = lambda hours: f"2024-{1 + hours // 720:02d}-{1 + hours // 24 % 30:02d} {hours % 24:02d}:00:00"
    data = []
    for i in range(240):
        start = rng.randrange(720) if i % 4 else 1440 + rng.randrange(2800)
        data.append((i, "hot" if i % 5 else f"k{i % 3}", at(start), None if rng.random() < 0.02 else at(min(start + rng.choice([1, 2, 30]), 8600))))
    df = spark.createDataFrame(data, "id int, k string, a string, b string").select("id", "k", F.col("a").cast("timestamp_ntz").alias("s"), F.col("b").cast("timestamp_ntz").alias("e"))
    recs = sorted(df.collect(), key=lambda r: (r["k"], r["s"], r["id"]))
    want = set()
    for n, r in enumerate(recs):
        before = [x for x in recs[:n] if x["k"] == r["k"]]
        if open_covers and any(x["e"] is None for x in before):
            continue
        ended = [(x["e"], x["id"]) for x in before if x["e"] is not None]
        if ended and (r["s"] - max(ended)[0]).total_seconds() > 2 * 86400:
            want.add((max(ended)[1], r["id"]))
    got = H.period_gaps(df, "k", "s", "e", "id", 2, open_covers=open_covers, rows=size)
    assert {(r["after_id"], r["before_id"]) for r in got.collect()} == want and want


@pytest.mark.parametrize("rows", [30, 1000])
def test_time_in_status_of_a_hot_hour(log, rows):
    hot = log.withColumn("t", F.when(F.col("k") == "hot", F.timestamp_seconds(F.lit(1704070800) + F.col("id") % 7).cast("timestamp_ntz")).otherwise(F.col("t")))
    got = {r["id"]: (r["prev_s"], r["seconds_since"]) for r in H.time_in_status(hot, "k", "s", "t", "id", "hour", rows).collect()}
    recs = sorted(hot.collect(), key=lambda r: (r["k"], r["t"], r["id"]))
    for before, r in zip([None, *recs], recs):
        same = before is not None and before["k"] == r["k"]
        assert got[r["id"]] == ((before["s"], int((r["t"] - before["t"]).total_seconds())) if same else (None, None))


def test_pair_events_first_to_first_later(log):
    recs = log.collect()
    for r in H.pair_events(log, "k", "s", "t", "a", "b").collect():
        start = min(x["t"] for x in recs if x["k"] == r["k"] and x["s"] == "a")
        assert r["started_at"] == start and r["finished_at"] == min(x["t"] for x in recs if x["k"] == r["k"] and x["s"] == "b" and x["t"] > start)


def test_still_in_state_equals_not_exists(log):
    recs = log.collect()
    want = {(a["k"], a["t"]) for a in recs if a["s"] == "a" and not any(b["k"] == a["k"] and b["s"] == "c" and b["t"] > a["t"] for b in recs)}
    assert {(r["k"], r["since"]) for r in H.still_in_state(log, ["k"], "s", "t", "a", ["c"]).collect()} == want


def test_period_gaps_of_adjacent_periods(spark, rows):
    data = [(1, "p", "2024-01-01", "2024-01-05"), (2, "p", "2024-01-20", "2024-01-25"), (3, "p", "2024-01-28", "2024-02-25"), (4, "p", "2024-05-01", "2024-05-02"), (5, "q", "2024-01-01", "2024-01-02")]
    df = spark.createDataFrame(data, "id int, k string, a string, b string").select("id", "k", F.col("a").cast("timestamp_ntz").alias("s"), F.col("b").cast("timestamp_ntz").alias("e"))
    assert rows(H.period_gaps(df, "k", "s", "e", "id", 7), "after_id", "before_id", "gap_days") == [(1, 2, 15.0), (3, 4, 66.0)]


def test_period_gaps_of_nested_periods(spark, rows):
    """A long period covers what comes after a short one inside it, across months too."""
    data = [(1, "p", "2024-01-01", "2024-04-30"), (2, "p", "2024-01-02", "2024-01-05"), (3, "p", "2024-02-20", "2024-02-25"), (4, "p", "2024-05-20", "2024-05-21"), (5, "p", "2024-07-01", None), (6, "p", "2024-08-01", "2024-08-02")]
    df = spark.createDataFrame(data, "id int, k string, a string, b string").select("id", "k", F.col("a").cast("timestamp_ntz").alias("s"), F.col("b").cast("timestamp_ntz").alias("e"))
    assert rows(H.period_gaps(df, "k", "s", "e", "id", 7), "after_id", "before_id", "gap_days") == [(1, 4, 20.0), (4, 5, 41.0), (4, 6, 72.0)]


def test_overridden_decisions_need_a_later_override(spark, rows):
    data = [(1, "d", 1, "CLEAN", 1), (2, "d", 3, "FRAUD", 2), (3, "d", 3, "EDITED", 3), (4, "d", 1, "CLEAN", 9), (5, "e", 1, "CLEAN", 1), (6, "f", 3, "FRAUD", 5), (7, "f", 1, "CLEAN", 5)]
    df = spark.createDataFrame(data, "id int, doc string, kind int, label string, h int").withColumn("t", F.timestamp_seconds(F.col("h") * 3600).cast("timestamp_ntz"))
    assert rows(H.overridden_decisions(df, "doc", "kind", "label", "t", "id", 1, 3), "id", "original_label", "override_label") == [(1, "CLEAN", "EDITED")]


def test_eligible_next_equals_ranking_all_permitted_items(spark, rows):
    items = spark.sql("""SELECT * FROM VALUES (1, 'x', 2, TIMESTAMP_NTZ '2024-01-01'), (2, 'x', 1, TIMESTAMP_NTZ '2024-01-03'), (3, 'y', 1, TIMESTAMP_NTZ '2024-01-02'), (4, 'z', 0, TIMESTAMP_NTZ '2024-01-01'),
      (5, 'x', 0, TIMESTAMP_NTZ '2024-09-01') AS t(id, w, p, due)""")
    perms = spark.createDataFrame([("r1", "x"), ("r1", "y"), ("r2", "x"), ("r3", "none"), ("r1", "x")], "who string, w string")
    got = H.eligible_next(items, perms, F.lit(True), "w", "who", "id", "due", "2024-02-01 00:00:00", F.col("p"))
    assert rows(got, "who", "id") == [("r1", 3), ("r2", 2)]


def test_cross_service_context_is_one_row_per_document(spark, rows):
    docs = spark.createDataFrame([(1,), (2,)], "id int")
    a = spark.createDataFrame([("1", 1, "old"), ("1", 2, "new"), ("7", 1, "x")], "doc string, n int, v string")
    b = spark.createDataFrame([(1, 5, 9), (1, 6, 8)], "doc int, n int, w int")
    got = H.cross_service_context(docs, "id", {"a": (a, "doc", "n", ["v"]), "b": (b, "doc", "n", ["w"])})
    assert rows(got, "id", "a_records", "a_v", "b_records", "b_w") == [(1, 2, "new", 2, 8), (2, 0, None, 0, None)]
