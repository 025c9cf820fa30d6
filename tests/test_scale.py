"""The scaling helpers against plain Spark or plain Python, with hot keys, ties and nulls."""

import pathlib
import random
import statistics
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from crosswalk.functions import scale
from crosswalk.operators import checks, reconcile
from crosswalk.plans import medallion
from crosswalk.session import cut, cut_in_turn, sized_settings, stored


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a third under NULL; equal values are frequent."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rng.randrange(300)}"
        data.append((i, key, rng.choice([1, 1, 1, 1, 2, 3, 50, rng.randrange(1000)]), f"2024-01-{1 + rng.randrange(20):02d} {rng.randrange(24):02d}:00:00"))
    df = spark.createDataFrame(data, "id bigint, key string, v int, at string").withColumn("ts", F.col("at").cast("timestamp_ntz")).drop("at")
    return df.cache()


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot_rows", [1, 50, 10**9])
def test_join_back_equals_plain_join(skewed, rows, how, hot_rows):
    stats = skewed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top")).filter("key IS NULL OR key <> 'k7'")
    got = scale.join_back(skewed, stats, ["key"], "n", how, hot_rows=hot_rows)
    few = scale.join_back(skewed, stats, ["key"], "n", how, hot_rows=hot_rows, hot_keys=1)
    assert rows(got) == rows(few) == rows(skewed.join(stats, "key", how).select(*got.columns))


def test_join_back_keeps_hot_and_null_rows_where_they_are(spark, tmp_path):
    """100,000 equal rows under one key, as many under NULL: each stays in the partition that read it."""
    same = spark.range(0, 100_000, 1, 20).select(F.lit("hot").alias("key"))
    none = spark.range(0, 100_000, 1, 20).select(F.lit(None).cast("string").alias("key"))
    cold = spark.range(0, 1000, 1, 2).select(F.concat(F.lit("k"), "id").alias("key"))
    df = same.unionByName(none).unionByName(cold)
    stats = df.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = scale.join_back(df, stats, ["key"], "n", hot_rows=1000)
        plan = out._jdf.queryExecution().executedPlan().toString()
        out.withColumn("part", F.spark_partition_id()).write.parquet(str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1 and "BroadcastHashJoin" in plan
    held = spark.read.parquet(str(tmp_path / "out")).groupBy("key", "n", "part").count().collect()
    for key, n in (("hot", 100_000), (None, None)):
        sizes = [r["count"] for r in held if r["key"] == key]
        assert {r["n"] for r in held if r["key"] == key} == {n} and sum(sizes) == 100_000 and max(sizes) <= 5000


def test_group_stats_equals_window(skewed, rows):
    window = Window.partitionBy("key")
    want = skewed.filter("key IS NOT NULL").withColumn("n", F.count(F.lit(1)).over(window)).withColumn("top", F.max("v").over(window))
    got = scale.group_stats(skewed, ["key"], size="n", top=F.max("v"))
    assert rows(got, "id", "n", "top") == rows(want, "id", "n", "top")


def test_latest_per_key_prunes_before_the_shuffle(skewed):
    df = scale.latest_per_key(skewed, ["key"], [F.col("ts").desc_nulls_last(), F.col("id")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan and plan.index("Final") < plan.index("Partial")


@pytest.mark.parametrize("grain", ["day", "month"])
def test_lag_in_key_equals_window_lag(skewed, rows, grain):
    window = Window.partitionBy("key").orderBy("ts", "id")
    want = skewed.withColumn("prev_v", F.lag("v").over(window)).withColumn("prev_id", F.lag("id").over(window)).filter("key IS NOT NULL")
    got = scale.lag_in_key(skewed.filter("key IS NOT NULL"), ["key"], "ts", "id", ["v", "id"], grain)
    assert rows(got, "id", "prev_v", "prev_id") == rows(want, "id", "prev_v", "prev_id")


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(scale, "RANGE_ROWS", 150)
    monkeypatch.setattr(scale, "PIECE_ROWS", 150)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("order", ["v", "key", "ts", "wide", "big", "part"])
def test_number_rows_equals_one_window(skewed, rows, small_ranges, descending, order):
    """Numbers, text, times, decimals, longs above 2^53 that differ in the last place, and structs; with nulls and ties."""
    df = skewed.withColumns({"wide": F.col("v").cast("decimal(30,10)"), "big": F.lit(1 << 60) + F.col("v"), "part": F.struct("v", "key")})
    first = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_first()
    want = df.withColumn("n", F.row_number().over(Window.orderBy(first, "id")))
    got = scale.number_rows(df, order, "id", descending, "n")
    assert rows(got, "id", "n") == rows(want, "id", "n")


def test_ranges_follow_the_rows_and_cut_a_frequent_value_again(skewed, small_ranges):
    ranged, parts = scale.stored_ranges(skewed, [F.col("v"), F.col("id")])
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert parts == 20 and len(sizes) >= 15 and max(sizes) < 600 and sum(sizes) == 3000
    assert ranged.filter("v = 1").select("_range").distinct().count() >= 5  # two thirds of the rows hold the value 1
    few, parts = scale.stored_ranges(skewed, [F.col("v"), F.col("id")], rows=1500)
    assert parts == 2 and few.count() == 3000


def test_number_rows_with_many_nulls(skewed, rows, small_ranges):
    df = skewed.withColumn("v", F.when(F.col("key").isNotNull(), F.col("v")))
    want = df.withColumn("n", F.row_number().over(Window.orderBy(F.col("v").asc_nulls_first(), "id")))
    assert rows(scale.number_rows(df, "v", "id", name="n"), "id", "n") == rows(want, "id", "n")


def test_number_rows_of_no_rows(spark):
    empty = spark.createDataFrame([], "id bigint, v int")
    assert scale.number_rows(empty, "v", "id").count() == 0


def test_pieces_of_a_hot_hour_are_many_and_bounded(skewed, small_ranges):
    """A third of all rows in one key and hour."""
    one_hour = skewed.withColumn("ts", F.when(F.col("key") == "hot", F.lit("2024-01-05 03:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")))
    cells = scale.pieces(one_hour, ["key"], ["ts", "id"], F.date_trunc("hour", "ts"))
    hot = [r["count"] for r in cells.filter("key = 'hot'").groupBy("_bucket", "_cell").count().collect()]
    assert len(hot) >= 5 and max(hot) <= 450 and sum(hot) == 1000
    assert cells.filter("key <> 'hot'").select("_cell").distinct().collect() == [(0,)]
    assert cells.count() == skewed.filter("key IS NOT NULL").count()


@pytest.mark.parametrize("grain", ["hour", "year"])
def test_lag_over_a_hot_hour_equals_window_lag(skewed, rows, small_ranges, grain):
    one_hour = skewed.withColumn("ts", F.when(F.col("id") % 2 == 0, F.lit("2024-01-05 03:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")))
    window = Window.partitionBy("key").orderBy("ts", "id")
    want = one_hour.withColumn("prev_v", F.lag("v").over(window)).filter("key IS NOT NULL")
    got = scale.lag_in_key(one_hour.filter("key IS NOT NULL"), ["key"], "ts", "id", ["v"], grain)
    assert rows(got, "id", "prev_v") == rows(want, "id", "prev_v")


def test_running_total_equals_window(skewed, rows, small_ranges):
    per = skewed.groupBy("key", "v").agg(F.count(F.lit(1)).alias("weight"))
    window = Window.partitionBy("key").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    want = per.withColumn("before", F.coalesce(F.sum("weight").over(window), F.lit(0))).filter("key IS NOT NULL")
    got = scale.running_total(skewed.filter("key IS NOT NULL"), ["key"], "v")
    assert rows(got, "key", "v", "weight", "before") == rows(want, "key", "v", "weight", "before")


def test_percentiles_are_exact(skewed):
    values = sorted(r[0] for r in skewed.select("v").collect())
    got = scale.percentiles(skewed, [], "v", {"median": 0.5, "p95": 0.95}).first()
    spot = 0.95 * (len(values) - 1)
    low = int(spot)
    assert got["median"] == statistics.median(values)
    assert got["p95"] == pytest.approx(values[low] + (values[low + 1] - values[low]) * (spot - low))


def test_percentiles_per_group(skewed):
    got = {r["key"]: r["m"] for r in scale.percentiles(skewed.filter("key IS NOT NULL"), ["key"], "v", {"m": 0.5}).collect()}
    hot = [r[0] for r in skewed.filter("key = 'hot'").select("v").collect()]
    assert got["hot"] == statistics.median(hot)


def test_chunked_list_is_whole_and_bounded(skewed):
    got = scale.chunked_list(skewed, ["key"], "id", 100).collect()
    assert sum(r["items_count"] for r in got) == 3000
    assert max(r["items_count"] for r in got) <= 100
    hot = sorted((r for r in got if r["key"] == "hot"), key=lambda r: r["chunk"])
    assert [int(x) for r in hot for x in r["items"].split(",")] == list(range(0, 3000, 3))


def test_sized_settings_follow_data_and_cores():
    big = sized_settings(100 * 10**12, 4000)
    assert int(big["spark.sql.shuffle.partitions"]) > 370_000 and int(big["spark.sql.files.maxPartitionBytes"]) == 256 * 1024 * 1024
    small = sized_settings(10**9, 100)
    assert int(small["spark.sql.shuffle.partitions"]) == 300 and int(small["spark.sql.files.maxPartitionBytes"]) == 8 * 1024 * 1024


def test_with_figures(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    got = scale.with_figures(df, df.agg(F.sum("a").alias("t"), F.count(F.lit(1)).alias("n")))
    assert rows(got) == [(1, 3, 2), (2, 3, 2)]


@pytest.fixture
def small_tasks(monkeypatch):
    """Tables count as large, and tasks, hot keys and broadcasts are small."""
    for name, n in {"TASK_ROWS": 200, "PLANNED_ROWS": 100, "SMALL_ROWS": 5, "LEAST_ROWS": 10}.items():
        monkeypatch.setattr(scale, name, n)


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_large_star_join_equals_plain_joins_and_spreads_null_and_hot_keys(spark, skewed, rows, small_tasks, tmp_path, kind):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = skewed.select("id", F.col("key").cast(kind).alias("key"), "v")
    names = skewed.select(F.col("key").cast(kind).alias("k"), F.length("key").alias("size")).distinct()
    names = names.filter("k IS NULL OR size <> 3").unionByName(names.filter("size = 3"))
    values = spark.createDataFrame([(1, "one"), (1, "uno"), (2, "two")], "w int, word string")
    try:
        want = left.join(names, left["key"] == names["k"], "left").join(values, F.col("v") == F.col("w"), "left")
        got, large = scale.star_join(left, [(names, ["key"], ["k"]), (values, ["v"], ["w"])])
        assert large and rows(got) == rows(want.select(*got.columns))
        joined, _ = scale.star_join(left, [(names, ["key"], ["k"])])
        joined.withColumn("part", F.spark_partition_id()).write.parquet(str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    held = spark.read.parquet(str(tmp_path / "out")).groupBy(F.col("key").cast("string").alias("key"), "part").count().collect()
    assert max(r["count"] for r in held if r["key"] is None) < 300 and sum(r["count"] for r in held if r["key"] is None) == 1000
    hot = [r["count"] for r in held if r["key"] == "hot"]
    assert sum(hot) == 1000 and (max(hot) < 400 if kind == "string" else len(hot) == 1)


def test_distinct_rows_are_dealt_by_their_number(skewed, rows, small_tasks):
    many, few = skewed.select("id", "key"), skewed.select("v")
    got = scale.distinct_rows(many.union(many))
    assert rows(got) == rows(many) and got.rdd.getNumPartitions() >= 14
    few = few.filter("v < 50")
    assert rows(scale.distinct_rows(few)) == rows(few.distinct())


def test_many_small_ranges_are_bounded(skewed, rows, monkeypatch):
    monkeypatch.setattr(scale, "MOST_RANGES", 12)
    monkeypatch.setattr(scale, "LEAST_ROWS", 1000)
    ranged, parts = scale.stored_ranges(skewed, [F.col("v"), F.col("id")], rows=10)
    assert parts == 12 and ranged.count() == 3000
    want = skewed.withColumn("n", F.row_number().over(Window.orderBy(F.col("v").asc_nulls_first(), "id")))
    assert rows(scale.number_rows(skewed, "v", "id", name="n", rows=10), "id", "n") == rows(want, "id", "n")


def test_summary_and_gold_compare_rows_in_many_tasks(skewed, rows, small_tasks):
    got = medallion.gold(skewed.union(skewed), {"id": "n", "key": "k", "ts": "at"}, {"some": F.col("v") > 0})
    want = skewed.filter("v > 0").select(F.col("id").alias("n"), F.col("key").alias("k"), F.col("ts").alias("at")).distinct()
    assert got.rdd.getNumPartitions() >= 14 and rows(got) == rows(want)
    summary = checks.table_summary(skewed, {"ids": "id", "keys": "key"}, "ts").first()
    low, high = skewed.agg(F.min("ts"), F.max("ts")).first()
    assert tuple(summary) == (3000, 3000, skewed.select("key").dropna().distinct().count(), low, high)
    empty = checks.table_summary(skewed.limit(0), {"ids": "id", "keys": "key"}, "ts").first()
    assert tuple(empty) == (0, 0, 0, None, None)


@pytest.fixture
def small_slices(small_tasks, monkeypatch):
    """Tables of more than 1,000 values are cut into slices; what is stored in turn is noted."""
    monkeypatch.setattr(scale, "SLICE_CELLS", 1000)
    monkeypatch.setattr(scale, "LIGHT_BYTES", 0)
    noted = []

    def noting(parts, name):
        noted.append((name, [p.count() for p in parts]))
        return cut_in_turn(parts, name)

    monkeypatch.setattr(scale, "cut_in_turn", noting)
    return noted


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_large_star_is_joined_in_slices_and_equals_plain_joins(spark, skewed, rows, small_slices, monkeypatch, kind):
    """A hot and a NULL key on the left, repeated keys on the right, a table below one of the sides, and an unneeded column."""
    left = skewed.select("id", F.col("key").cast(kind).alias("key"), "v", F.lit("wide").alias("unread"))
    lines = skewed.select(F.col("key").cast(kind).alias("k"), F.length("key").alias("size"), "ts").distinct().filter("k IS NULL OR size <> 3")
    lines = lines.unionByName(spark.createDataFrame([("hot", 3), ("hot", 3)], "k string, size int").select(F.col("k").cast(kind).alias("k"), "size", F.lit(None).cast("timestamp_ntz").alias("ts")))
    sizes = spark.createDataFrame([(n, f"size {n}") for n in range(6)], "s int, text string").filter("s <> 4")
    values = skewed.select(F.col("v").alias("w"), F.concat(F.lit("v"), "v").alias("word")).distinct()
    want = left.join(lines, left["key"] == lines["k"], "left").join(sizes, F.col("size") == F.col("s"), "left").join(values, F.col("v") == F.col("w"), "left")
    edges = [reconcile.Edge(lines, ["key"], ["k"]), reconcile.Edge(sizes, ["size"], ["s"]), reconcile.Edge(values, ["v"], ["w"])]
    columns = ["id", "key", "ts", "text", "word"]
    got = reconcile.star_left_chain(left, edges, columns, distinct=False)
    assert rows(got) == rows(want.select(*columns)) and got.columns == columns
    name, parts = small_slices[0]
    assert name == "star" and len(parts) == 8 and sum(parts) == got.count() and max(parts) < sum(parts) / 4
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    once = reconcile.star_left_chain(left, edges, ["key", "text", "word"])
    assert rows(once) == rows(want.select("key", "text", "word").distinct())
    monkeypatch.setattr(scale, "LIGHT_BYTES", 10_000_000)
    assert rows(reconcile.star_left_chain(left, edges, columns, distinct=False)) == rows(got)


def test_large_star_with_equal_names_equals_plain_joins(skewed, rows, small_slices):
    other = skewed.select("id", F.col("v").alias("w"))
    want = skewed.join(other, skewed["id"] == other["id"], "left").select("key", "v", "w")
    got = reconcile.star_left_chain(skewed, [reconcile.Edge(other, ["id"], ["id"])], ["key", "v", "w"], distinct=False)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("again", [0, 3, 500, 3000])
def test_distinct_rows_of_large_tables(skewed, rows, small_slices, monkeypatch, again):
    """No copies, copies of few and of more rows, and of all; rows that differ and have one hash are kept."""
    monkeypatch.setattr(scale, "SMALL_ROWS", 10)
    one = skewed.select("id", "key", "v", F.when(F.col("id") == 1, 7).alias("a"), F.when(F.col("id") == 2, 7).alias("b"), F.lit(0).alias("zero"))
    apart = one.filter("id IN (1, 2)").withColumns({"id": F.lit(-1), "key": F.lit("k"), "v": F.lit(0)})  # NULLs are passed over, so these have the same hash
    many = one.unionByName(apart) if again else one
    assert apart.select(F.xxhash64(*apart.columns)).distinct().count() == 1
    table = cut(many.union(many.filter(F.col("id") < again)), "rows")
    got = scale.distinct_rows(table)
    assert rows(got) == rows(many)
    names = [name for name, _ in small_slices]
    assert names == {0: ["shared-hashes"], 3: ["shared-hashes"], 500: ["shared-hashes", "distinct"], 3000: ["distinct"]}[again]
    assert all(max(parts) < 1000 for name, parts in small_slices if name == "distinct")
    assert (got is table) == (again == 0)


def test_shuffle_files_go_when_a_part_is_stored(spark, skewed, rows):
    folders = [pathlib.Path(str(d)) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    files = lambda: {f for d in folders for f in d.rglob("shuffle_*.data")}
    before, setting = files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    got = cut_in_turn([skewed.filter(F.col("id") % 2 == i).repartition(5, "id") for i in range(2)], "halves")
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and rows(got) == rows(skewed)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    skewed.repartition(5, "id").write.format("noop").mode("overwrite").save()
    assert files() - before  # the files that a plain write leaves


def test_light_tables_are_known_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(scale, "LIGHT_BYTES", 1000)
    short = spark.createDataFrame([(n, "x" * 10) for n in range(20)] + [(20, None)], "n int, t string")
    assert scale.is_light(short, 21) and not scale.is_light(short.withColumn("t", F.repeat("t", 10)), 21)
    assert not scale.is_light(short, 40) and not scale.is_light(short.select(F.array("t").alias("a")), 21)
    assert scale.is_light(short.limit(0), 0) and scale.is_light(short.select("n"), 21)


def test_stored_reads_files_as_they_are_and_stores_the_rest(spark, skewed):
    table = cut(skewed, "rows")
    plain = table.filter("v > 1").select((F.col("v") + 1).alias("w"))
    for df in (table, plain, plain.union(plain)):
        assert stored(df, "again") is df
    for df in (skewed, plain.distinct(), plain.withColumn("r", F.rand()), plain.join(table, F.col("w") == F.col("v")).select("id", "w"), table.orderBy("id")):
        again = stored(df, "again")
        assert again is not df and again.columns == df.columns and again.count() == df.count()
