"""Tables changed by runs: repeated and failed runs, member lists, storage figures, and limits that mean all rows."""

import os

import pytest
from pyspark.sql import functions as F

from crosswalk.functions import scale
from crosswalk.operators import aggregates as A
from crosswalk.operators import checks as K
from crosswalk.operators import filters as L
from crosswalk.operators import reconcile as R
from crosswalk.operators import usage as U
from crosswalk.plans import inventory
from crosswalk.sources import runs, sinks


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_a_repeated_run_adds_nothing_and_a_new_one_replaces(spark, tmp_path):
    base = f"{tmp_path}/t"
    assert ids(sinks.materialise(spark.range(3), base, run_id="a")) == [0, 1, 2]
    assert ids(sinks.materialise(spark.range(9), base, run_id="a")) == [0, 1, 2]
    assert ids(sinks.materialise(spark.range(5), base, ["id"], "b")) == [0, 1, 2, 3, 4]
    assert ids(sinks.materialise(spark.range(3), base, run_id="a")) == [0, 1, 2, 3, 4]  # an old run, again
    assert ids(sinks.materialise(spark.range(2), base)) == [0, 1]
    assert ids(runs.read_runs(spark, base, spark.range(1).schema)) == [0, 1]


def test_a_failed_run_leaves_the_old_table(spark, tmp_path):
    base = f"{tmp_path}/t"
    before = sinks.materialise(spark.range(3), base, run_id="a")
    broken = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.materialise(broken, base, run_id="b")
    assert ids(before) == ids(runs.read_runs(spark, base, before.schema)) == [0, 1, 2]
    assert ids(sinks.materialise(spark.range(4), base, run_id="b")) == [0, 1, 2, 3]


def test_a_broken_pointer_is_not_believed(spark, tmp_path):
    base = f"{tmp_path}/t"
    for n in (1, 2):
        sinks.materialise(spark.range(n), base, run_id=str(n))
    slot = f"{base}/pointer-0"  # number 2
    part = next(f for f in os.listdir(slot) if f.startswith("part-"))
    with open(f"{slot}/{part}", "w") as f:
        f.write('{"number": 2, "li')
    os.remove(f"{slot}/.{part}.crc")
    assert ids(runs.read_runs(spark, base, spark.range(1).schema)) == [0]


def test_rows_of_the_state_before_stay_and_older_ones_go(spark, tmp_path):
    base = f"{tmp_path}/t"
    for n in range(6):
        before = sinks.materialise(spark.range(n + 1), base, run_id=str(n))
    assert ids(before) == list(range(6))
    assert len([f for f in os.listdir(base) if f.startswith("rows-")]) == 2


def test_audit_runs_are_appended_once(spark, tmp_path):
    row = spark.createDataFrame([("a", "s", "t", "2024-01-01", "5", "4", "1", "20.0", "me", None)], ", ".join(f"{f.name} string" for f in sinks.AUDIT_SCHEMA))
    for run in ("1", "2", "1", "2", "3", "1"):
        log = sinks.append_audit(row, f"{tmp_path}/log", run)
    assert log.count() == 3 and log.schema == sinks.AUDIT_SCHEMA


def test_a_repeated_backup_keeps_the_first_snapshot(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "k1", "off"), (2, "k2", "on")], "id int, k string, s string")
    cleared, _ = sinks.backup_then_clear(df, F.col("s") == "off", "k", ["id", "k"], f"{tmp_path}/bk", "r")
    again, backup = sinks.backup_then_clear(cleared, F.col("s") == "off", "k", ["id", "k"], f"{tmp_path}/bk", "r")
    assert rows(sinks.restore_from_backup(again, backup, "id", "k")) == rows(df)


@pytest.mark.parametrize("size", [40, None])
def test_member_lists_are_whole_ordered_and_bounded(spark, size):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        F.when(F.col("id") % 50 != 9, F.concat(F.lit("m"), F.col("id") % 400)).alias("m"),
    )
    got = scale.member_lists(df, ["k"], "m", 25, rows=size).collect()
    want = {}
    for r in df.filter("m IS NOT NULL").distinct().collect():
        want.setdefault(r["k"], []).append(r["m"])
    found = {}
    for r in sorted(got, key=lambda r: r["piece"]):
        items = r["items"].split(",")
        assert len(items) == r["items_count"] <= 25
        assert r["piece"] * 25 == len(found.setdefault(r["k"], []))
        found[r["k"]] += items
    assert found == {k: sorted(v) for k, v in want.items()}


def test_storage_figures_equal_the_files(spark, tmp_path):
    spark.range(1000).repartition(4).write.parquet(f"{tmp_path}/in/a.parquet")
    spark.range(10).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(f"{tmp_path}/in/b")
    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/one")
    part = next(f for f in os.listdir(f"{tmp_path}/one") if f.startswith("part-"))
    os.link(f"{tmp_path}/one/{part}", f"{tmp_path}/in/c.parquet")
    sizes = {}
    for top, _, names in os.walk(f"{tmp_path}/in"):
        for n in names:
            if n.endswith(".parquet"):
                path = os.path.join(top, n)
                sizes.setdefault(os.path.relpath(path, f"{tmp_path}/in").split("/")[0].removesuffix(".parquet"), []).append(os.path.getsize(path))
    for root in (f"{tmp_path}/in", f"file://{tmp_path}/in/"):
        got = {r["table_name"]: (r["files"], r["bytes"], r["smallest"], r["largest"]) for r in inventory.storage_stats(spark, root).collect()}
        assert got == {n: (len(s), sum(s), min(s), max(s)) for n, s in sizes.items()} and set(got) == {"a", "b", "c"}


def test_no_limit_means_all_rows(spark):
    df = spark.range(300).select("id", F.lit(1).alias("one"), (F.col("id") % 40).alias("v"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"), F.concat(F.lit('{"a": "'), "id", F.lit('"}')).alias("j"))
    assert L.suspicion_score(df, {"x": F.lit(1), "y": F.lit(1)}, [F.col("id")]).count() == 300
    assert A.recent_detail(df, "t", "id", ["id"], {}, "2024-01-01 00:00:00").count() == 300
    assert A.json_key_stats(df, "j", "$.a", "v").count() == 300
    assert A.table_inventory(df, "one", "v", "v", "id").count() == 300
    assert A.case_rate(df, df, "id", "id", "id", 0).count() == 300
    assert K.change_impact(df, ["v", "one"], "id", ["t"]).count() == 592
    assert K.change_impact(df, ["v", "one"], "id", ["t"], 7).count() == 14
    assert K.sample_lookup(df, df, "id", ["v"]).count() == 300
    months = spark.range(50).select("id", F.add_months(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"), F.lit("s").alias("s"), F.lit("k").alias("k"))
    assert R.gap_profile(months, "s", "d", "k").count() == 52 and R.gap_profile(months, "s", "d", "k", 12).count() == 14
    found = U.column_keyword_search({"t": df}, {"f": ["v", "one"]})
    assert U.top_values({"t": df}, found).count() == 41 and U.top_values({"t": df}, found, 5).count() == 6
