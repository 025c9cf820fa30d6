import math
import random

import pytest
from pyspark.sql import functions as F

from crosswalk.llm import queries, topk


def plain(rows, is_query, k=5):
    usable = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {i: v for i, v in reversed(usable) if is_query(i)}
    out = []
    for q, v in asked.items():
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_query_equals_brute_force(spark, data_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data_dir}/embeddings.parquet").collect()]
    assert found(queries.QUERIES["op9_columnar_topk"](spark, data_dir)) == plain(rows, lambda i: i % 50 == 0)


@pytest.mark.parametrize("scale", [0.01, 1.0, 1e5, 1e6])
def test_blocks_ties_and_large_values(spark, monkeypatch, scale):
    """Small blocks, clustered vectors that prune, many equal vectors, and components beyond exact doubles."""
    monkeypatch.setattr(topk, "BLOCK", 37)
    monkeypatch.setattr(topk, "ASKED", 11)
    rnd = random.Random(4)
    centres = [[rnd.gauss(0, 1) for _ in range(40)] for _ in range(5)]
    rows = [(i, [scale * (x + rnd.gauss(0, 0.1)) for x in centres[i % 5]]) for i in range(300)]
    rows += [(1000 + i, [scale] * 40) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert found(topk.search(df, F.col("vec_id") % 10 == 0)) == plain(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [0.5]), (7, [1.0, 2.0, 9.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (0, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS rank", "'x' AS v", "'x' AS score", "'x' AS ct", "'x' AS qt", "'x' AS floor", "'x' AS row")
    assert found(topk.search(df, F.col("vec_id") % 4 == 0)) == plain(rows, lambda i: i % 4 == 0)
    assert topk.search(df.limit(0), F.col("vec_id") % 4 == 0).count() == 0
    assert topk.search(df, F.col("vec_id") < 0).count() == 0


def test_queries_of_one_id_are_one_whatever_the_order_of_rows(spark):
    rows = [(0, [3.0, 1.0]), (0, [1.0, 9.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 2.0])]
    got = [found(topk.search(spark.createDataFrame(r, "vec_id long, embedding array<double>").repartition(n), F.col("vec_id") == 0, k=2)) for r, n in ((rows, 1), (rows[::-1], 3))]
    assert got[0] == got[1] == plain([rows[1], *rows[2:]], lambda i: i == 0, 2)


def test_no_vectors_are_paired_in_the_plan(spark, data_dir):
    """Rows meet in cells: the plan has no join of vectors and no product of tables."""
    plan = queries.QUERIES["op9_columnar_topk"](spark, data_dir)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Cartesian" not in plan and "NestedLoop" not in plan and "collect_set" not in plan
