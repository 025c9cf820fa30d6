"""Streams: restart, late and out-of-order changes, repeated batches; sinks that write files."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from crosswalk.session import cut, scratch_dir
from crosswalk.sources import sinks, tables
from crosswalk.streaming import changes as S

SCHEMA = "id int, v string, _change_type string, _commit_version bigint"


def feed(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def live(spark, base):
    got = S.read_snapshot(spark, base, feed(spark).schema, ["id"], ["_commit_version"])
    return sorted((r["id"], r["v"]) for r in got.collect())


@pytest.mark.parametrize("merge_every", [1, 2, 100])
def test_snapshot_stream_restarts_and_takes_late_changes(spark, tmp_path, merge_every):
    base, src, mark = f"{tmp_path}/snap", f"{tmp_path}/in", f"{tmp_path}/mark"

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        S.stream_snapshot(stream, ["id"], ["_commit_version"], base, mark, merge_every).awaitTermination()

    feed(spark, (1, "a", "insert", 1), (2, "b", "insert", 2), (1, "a2", "update", 5)).coalesce(1).write.mode("append").parquet(src)
    run()
    assert live(spark, base) == [(1, "a2"), (2, "b")]
    feed(spark, (2, None, "delete", 9)).coalesce(1).write.mode("append").parquet(src)
    run()
    feed(spark, (1, "late", "update", 3), (2, "late", "update", 8), (3, "c", "insert", 10)).coalesce(1).write.mode("append").parquet(src)
    run()  # older versions arrive late: neither the newer row nor the delete is undone
    run()  # nothing new
    assert live(spark, base) == [(1, "a2"), (3, "c")]
    batch = S.apply_changes(spark.read.schema(SCHEMA).parquet(src), ["id"], ["_commit_version"])
    assert sorted((r["id"], r["v"]) for r in batch.collect()) == live(spark, base)


def test_an_unfinished_folder_is_not_read(spark, tmp_path):
    base = f"{tmp_path}/snap"
    feed(spark, (1, "a", "insert", 1)).write.parquet(f"{base}/delta=0")
    feed(spark, (1, "broken", "update", 7)).write.parquet(f"{base}/delta=1")
    os.remove(f"{base}/delta=1/_SUCCESS")
    assert live(spark, base) == [(1, "a")]


def test_merge_changes_keeps_delete_markers(spark):
    snap = S.newest_changes(feed(spark, (1, "a", "insert", 1), (1, None, "delete", 4)), ["id"], ["_commit_version"])
    merged = S.merge_changes(snap, feed(spark, (1, "old", "update", 2)), ["id"], ["_commit_version"])
    assert [tuple(r) for r in merged.collect()] == [(1, None, "delete", 4)]


def test_bronze_streams_continue_where_they_stopped(spark, tmp_path):
    schema = StructType([StructField("a", StringType())])
    one = spark.createDataFrame([("x",), ("y",)], schema)
    one.write.parquet(f"{tmp_path}/in/t")
    args = (spark, {"t": schema}, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/check")
    S.run_all(S.stream_bronze(*args))
    one.limit(1).write.mode("append").parquet(f"{tmp_path}/in/t")
    S.run_all(S.stream_bronze(*args))
    S.run_all(S.stream_bronze(*args))
    got = spark.read.parquet(f"{tmp_path}/out/t")
    assert got.count() == 3 and got.select("_source_table").distinct().count() == 1


class Session:
    """As much of a session as ``scratch_dir`` reads."""

    def __init__(self, master, conf=None, checkpoint=None):
        self.conf = conf or {}
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda _: checkpoint})()


def test_scratch_is_in_the_shared_folder_and_never_local_on_a_cluster(spark):
    assert scratch_dir(Session("yarn", {"spark.checkpoint.dir": "hdfs:///tmp/x/"}), "t").startswith("hdfs:///tmp/x/t-")
    assert scratch_dir(Session("yarn", checkpoint="s3a://b/c"), "t").startswith("s3a://b/c/t-")
    with pytest.raises(ValueError):
        scratch_dir(Session("spark://host:7077"), "t")
    assert cut(spark.range(3), "t").count() == 3


def test_csv_is_trimmed_and_blank_keys_go(spark, tmp_path, rows):
    (tmp_path / "f.csv").write_text(" Status ,Name, Key\nLIVE,a, k1 \nLIVE,a,k1\nNEW,b,  \nNEW,c,\n")
    schema = StructType([StructField(n, StringType()) for n in (" Status ", "Name", " Key")])
    got = tables.read_csv_clean(spark, f"{tmp_path}/f.csv", schema, "Key")
    assert got.columns == ["Status", "Name", "Key"] and rows(got) == [("LIVE", "a", "k1")]


def test_batches_are_numbered_without_gaps(spark, tmp_path, rows):
    df = spark.range(0, 1230, 3).withColumnRenamed("id", "key")
    sinks.batch_export(df, "key", f"{tmp_path}/b", 50)
    got = rows(sinks.batch_summary(spark.read.csv(f"{tmp_path}/b", header=True, schema="key bigint, record_number bigint, batch bigint")))
    assert len(got) == 9 and sorted(got)[0] == (1, 1, 50, 50) and sorted(got)[-1] == (9, 401, 410, 10)


def test_payload_leaves_out_nulls(spark):
    df = spark.createDataFrame([(1, None, 7), (2, "b", None)], "id int, name string, pid int")
    side = spark.createDataFrame([(7, "P")], "k int, label string")
    got = sinks.payload_projection(df, {"id": "ext_id", "name": "title"}, {"kind": "x"}, side, ("pid", "k"), {"label": "parent"}).orderBy("ext_id").collect()
    assert [r["payload"] for r in got] == ['{"ext_id":1,"parent":"P","kind":"x"}', '{"ext_id":2,"title":"b","kind":"x"}']


def test_archive_run_twice_moves_rows_once(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES (1, 'done', TIMESTAMP_NTZ '2024-01-01'), (2, 'done', TIMESTAMP_NTZ '2024-03-01'), (3, 'open', TIMESTAMP_NTZ '2024-01-01'), (4, NULL, NULL) AS t(id, s, t)")
    for _ in range(2):
        kept, archive = sinks.archive_expired(df, "s", ["done"], "t", 30, "2024-03-02 00:00:00", "r1", f"{tmp_path}/arch")
    assert archive.count() == 1 and kept.count() == 3


def test_backup_and_restore(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "k1", "off"), (2, "k2", "on"), (3, None, None)], "id int, k string, s string")
    cleared, backup = sinks.backup_then_clear(df, F.col("s") == "off", "k", ["id", "k"], f"{tmp_path}/bk")
    assert rows(cleared, "id", "k") == [(1, None), (2, "k2"), (3, None)]
    assert rows(sinks.restore_from_backup(cleared, backup, "id", "k")) == rows(df)


def test_audit_rows_are_typed_and_appended(spark, tmp_path):
    row = spark.createDataFrame([("a", "s", "t", "2024-01-01", "5", "4", "1", "20.0", "me", None)], ", ".join(f"{f.name} string" for f in sinks.AUDIT_SCHEMA))
    sinks.append_audit(row, f"{tmp_path}/log")
    got = sinks.append_audit(row, f"{tmp_path}/log")
    assert got.schema == sinks.AUDIT_SCHEMA and got.agg(F.sum("records_processed")).first()[0] == 10


def test_catalog_tables_and_views(spark, rows):
    tables.register_views({"stacked_a": spark.range(3)})
    tables.register_views({"stacked_b": spark.sql("SELECT id * 2 AS id FROM stacked_a")})
    assert rows(tables.read_table(spark, None, "stacked_b")) == [(0,), (2,), (4,)]


def test_both_images_and_equal_versions(spark, rows):
    schema = "id int, version int, v int, _change_type string"
    feed = [
        (1, 1, 10, "insert"), (1, 2, 10, "update_preimage"), (1, 2, 11, "update_postimage"), (2, 1, 20, "insert"), (2, 2, 20, "update_preimage"), (2, 3, 20, "delete"),
        (3, 1, 30, "delete"), (3, 1, 31, "insert"), (4, 1, 40, "insert"), (4, 1, 41, "insert"),
    ]
    found = [rows(S.apply_changes(spark.createDataFrame(data, schema).repartition(n), ["id"], ["version"]), "id", "v") for data, n in ((feed, 1), (feed[::-1], 3))]
    assert found[0] == found[1] and found[0][:2] == [(1, 11), (3, 31)] and [r[0] for r in found[0]] == [1, 3, 4]


@pytest.fixture
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_fifty_batches_touch_as_many_folders_as_ten(spark, tmp_path, few_partitions, monkeypatch):
    """What a batch asks of storage does not grow with the age of the snapshot, nor does what lies there."""
    base, listed, read, removed = f"{tmp_path}/snap", [], [], []
    real = S.generation
    monkeypatch.setattr(S, "generation", lambda b, state: read.append(len(real(b, state))) or real(b, state))
    monkeypatch.setattr(S, "finished_folders", lambda *a: pytest.fail("lists the folder"))
    remove = S.remove_folders
    monkeypatch.setattr(S, "remove_folders", lambda spark, paths: removed.append(len(list(paths))) or remove(spark, paths))
    want = {}
    for n in range(50):
        rows = [(n % 7, f"v{n}", "delete" if n % 5 == 0 else "update", n), (100 + n, "x", "insert", n), (3, "late", "update", n - 40)]
        for i, v, kind, version in rows:
            if version >= want.get(i, (-1000,))[0]:
                want[i] = (version, v, kind)
        batch = feed(spark, *rows)
        S.add_batch(batch, n, ["id"], ["_commit_version"], base, 5)
        if n % 9 == 0:
            S.add_batch(feed(spark, (1, "twice", "update", 10**6)), n, ["id"], ["_commit_version"], base, 5)  # the same number again
        listed.append(len(os.listdir(base)))
    assert max(listed[10:20]) == max(listed[40:]) <= 16 and max(read) <= 6 and max(removed) <= 6
    assert live(spark, base) == sorted((i, v) for i, (_, v, kind) in want.items() if kind != "delete")


def test_a_batch_that_fails_before_the_pointer_is_written_again(spark, tmp_path, monkeypatch):
    base = f"{tmp_path}/snap"
    S.add_batch(feed(spark, (1, "a", "insert", 1)), 0, ["id"], ["_commit_version"], base, 2)
    real = S.write_pointer
    monkeypatch.setattr(S, "write_pointer", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        S.add_batch(feed(spark, (1, "half", "update", 2)), 1, ["id"], ["_commit_version"], base, 2)
    assert live(spark, base) == [(1, "a")]
    monkeypatch.setattr(S, "write_pointer", real)
    S.add_batch(feed(spark, (1, "b", "update", 2)), 1, ["id"], ["_commit_version"], base, 2)
    assert live(spark, base) == [(1, "b")]


def test_live_counts_over_fifty_batches_drop_old_state(spark, tmp_path, few_partitions):
    """A day a batch, with a late row that the watermark still admits: totals are right and state stays small."""
    src, base, mark = f"{tmp_path}/in", f"{tmp_path}/counts", f"{tmp_path}/mark"
    schema, want, kept = "at timestamp, kind string", {}, []

    def stamp(day, hour=12):
        return F.timestamp_seconds(F.lit(1704067200 + day * 86400 + hour * 3600)).alias("at")

    for start in range(0, 50, 10):
        for day in range(start, start + 10):
            parts = [spark.range(3).select(stamp(day), F.lit("new").alias("kind")), spark.range(2).select(stamp(day, 3), F.lit("old").alias("kind"))]
            if day % 10 == 5:
                parts.append(spark.range(1).select(stamp(day - 2), F.lit("new").alias("kind")))
            for p in parts:
                for r in p.selectExpr("cast(cast(at as date) as string) AS day", "kind").collect():
                    want[r["day"], r["kind"]] = want.get((r["day"], r["kind"]), 0) + 1
            whole = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0].unionByName(parts[1]).unionByName(parts[2])
            whole.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        query = S.stream_live_counts(stream, "at", "kind", base, mark, "4 days", 5)
        query.awaitTermination()
        kept += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    got = {(r["day"], r["kind"]): r["row_count"] for r in S.read_live_counts(spark, base, "kind").collect()}
    assert got == want and len(want) == 100
    assert max(kept) <= 14 and kept[-1] <= 12
