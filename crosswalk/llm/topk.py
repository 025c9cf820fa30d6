"""Exact top-k by inner product: columnar branch and bound (operator 9).

A tile of queries meets a tile of candidates, both in vertical layout, dimension after dimension, with the mass (norm) that remains after
each group of dimensions. The scores are added up over the first group of dimensions for all, then, query by query, what is
known plus the product of the remaining masses bounds what a candidate can still reach. Candidates whose bound is below
the k-th best score known for certain are dropped and the rest is moved together, group after group. Components are
whole numbers, so scores are exact; a bound is rounded up, and a candidate that could tie is kept.

One tile of candidates is searched first. Its k-th best score of each query goes along with the query, so every other tile
starts to drop candidates from there instead of from nothing. Rows move once per tile that they meet, in cells of a bounded size (see
``vectors``); a cell leaves at most k rows per query.

Defined results: vectors that are null, or hold null, NaN or infinite components, take no part; nor do rows with a null id.
Vectors of different lengths score over their common dimensions. An empty vector scores 0. Ties go to the smaller
id; rows that repeat an id are all candidates, but never for a query of the same id. Queries that share an id: the
smallest vector asks. Scores beyond 64 bits are compared within a tile, and then held within 64 bits. Columns with clashing
names are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosswalk.llm.vectors import column, matrix, on_cells, tile, tiles, to_long, vector_rows, whole
from crosswalk.session import cut

BLOCK = 8_192  # candidates of a tile, on average
ASKED = 512  # queries of a tile, on average
GROUP = 16  # dimensions added up between two prunings
EXACT = float(1 << 52)  # sums of products up to this size are exact in double precision


def masses(data: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Norm of what remains of each vector from each cut on, rounded up."""
    square = np.add.reduceat(data**2, cuts[:-1], axis=0)
    return np.sqrt(np.cumsum(square[::-1], axis=0)[::-1]) * (1 + 1e-9)


def best_of(asking: pa.Table, others: pa.Table, k: int, scale: int) -> list[tuple[int, int, int]]:
    """(query id, vec id, score): the ``k`` best candidates of a tile for each query, without those surely below its ``floor``."""
    q_ids, ids = (column(t, "vec_id").to_numpy() for t in (asking, others))
    floors = column(asking, "floor").to_numpy(zero_copy_only=False).astype(float)
    q, c = whole(matrix(column(asking, "v")), scale).T, whole(matrix(column(others, "v")), scale).T
    dims = min(len(q), len(c))
    q, c = q[:dims], c[:dims]
    largest = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * max(1, dims)
    if largest >= EXACT:
        scores = np.zeros((q.shape[1], c.shape[1]), dtype=object)
        for d in range(dims):
            scores = scores + np.multiply.outer(q[d].astype(object), c[d].astype(object))
        return [hit for j in range(q.shape[1]) for hit in leaders(q_ids[j], ids, scores[j], k)]
    q, c = np.ascontiguousarray(q, dtype=float), np.ascontiguousarray(c, dtype=float)
    cuts = [*range(0, dims, GROUP), dims]
    if dims:
        q_mass, c_mass = masses(q, cuts), masses(c, cuts)
    first = q[:GROUP].T @ c[:GROUP]
    out = []
    for j in range(q.shape[1]):
        alive = np.flatnonzero(ids != q_ids[j])
        known = first[j, alive]
        for g in range(1, len(cuts) - 1):
            if not len(alive):
                break
            rest = q_mass[g, j] * c_mass[g, alive]
            sure = floors[j] if len(alive) <= k else np.fmax(floors[j], np.partition(known - rest, len(alive) - k)[len(alive) - k])
            if not np.isnan(sure):
                keep = known + rest >= sure - 1e-6
                alive, known = alive[keep], known[keep]
            known = known + q[cuts[g] : cuts[g + 1], j] @ c[cuts[g] : cuts[g + 1], alive]
        out += leaders(q_ids[j], ids[alive], known, k)
    return out


def leaders(query_id: int, ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    chosen = ids != query_id
    if scores.dtype != object and len(ids) > 4 * k:
        chosen &= scores >= np.partition(scores, len(ids) - k - 1)[len(ids) - k - 1]
    rows = sorted(zip((-int(s) for s in scores[chosen].tolist()), ids[chosen].tolist()))
    return [(int(query_id), i, to_long(-s)) for s, i in rows[:k]]


def nearest(asking: DataFrame, others: DataFrame, k: int, scale: int) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the best of all cells."""

    def run(left: pa.Table, right: pa.Table) -> dict:
        found = best_of(left, right, k, scale)
        return {name: [f[i] for f in found] for i, name in enumerate(("query_id", "vec_id", "score"))}

    near = on_cells(asking, others, ["qt", "ct"], run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(rows: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: the ``k`` best of all other rows for each row that
    ``is_query`` chooses (a condition on ``vec_id``). Components become floor(``scale`` * x)."""
    usable = vector_rows(rows, vector).filter(F.col("vec_id").isNotNull())
    stored = cut(usable.withColumn("row", F.monotonically_increasing_id()), "topk-rows")  # stored, so a row keeps its tile
    counts = stored.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("asked")).first()
    c_tiles, q_tiles = tiles(counts["n"], BLOCK), tiles(counts["asked"], ASKED)
    tiled = stored.withColumn("ct", tile(counts["n"], BLOCK, "row"))
    others = tiled.withColumn("qt", F.explode(F.sequence(F.lit(0), F.lit(q_tiles - 1))))
    asked = stored.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("qt", tile(counts["asked"], ASKED, "vec_id"))
    start = nearest(asked.select("vec_id", "v", "qt", F.lit(0).alias("ct"), F.lit(None).cast("double").alias("floor")), others.filter("ct = 0"), k, scale)
    reached = start.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
    every = F.explode(F.sequence(F.lit(0), F.lit(c_tiles - 1))).alias("ct")
    return nearest(cut(asked.join(reached, "vec_id", "left"), "topk-queries").select("vec_id", "v", "qt", "floor", every), others, k, scale)
