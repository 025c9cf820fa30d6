"""Approximate nearest neighbours by learned partitions (operator 13).

A bounded sample of rows is joined to its nearest neighbours, and the neighbour graph is cut into parts of about equal size
so that few of its edges cross: from a start by balanced centres, rows move to the part that holds most of their
neighbours while that part has room. A small classifier (softmax over the components) learns the shares of the parts among a
row and its neighbours, so it also places rows that were not in the sample. Every row of the table lies in its most probable part.

A query goes to its most probable parts, as many as it takes to reach a share of probability. That share is set on rows
that the graph has not seen: it is the smallest at which ``target`` of their nearest neighbours lie in the parts
probed. Rows of these parts are ranked again by their exact inner products. Parts are searched in cells of bounded
tiles, so a part that holds a third of all rows is many tasks.

Defined results: rows with a null id, with a vector that is null, zero or empty, or with null, NaN or infinite components, take no part.
Rows equal in id and vector count once. Queries that share an id: the smallest vector asks. A row is never found by a query with its own
id. A query is routed on until its parts hold as many rows as it may get, so it gets fewer than ``k`` only
where the table has fewer. Vectors of different lengths score over their common dimensions. Scores are sums of double products in the
order of the dimensions; ties go to the smaller id. An empty table gives an empty result. Further columns are left out, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosswalk.llm.common import map_batches
from crosswalk.llm.vectors import column, matrix, on_cells, tile, tiles, vector_rows
from crosswalk.session import cut

SAMPLE = 8_192  # rows that the graph and the classifier are fitted on, at most
PARTS = 16  # parts of the graph
DEGREE = 10  # neighbours of a row in the graph
ROOM = 1.1  # a part holds at most this times an equal share of the sample
HELD_OUT = 8  # one of so many sampled rows stays out of the graph and sets the share to probe
LEAST = 64  # sampled rows per part, at least; smaller tables get fewer parts
ASKED = 1_024  # queries of a tile, on average
ROWS = 4_096  # candidates of a tile, on average
SLAB = 1 << 20  # scores held at once


class Router(NamedTuple):
    """``weights``: a row per component and one for the constant, a column per part. ``share``: see above."""

    weights: np.ndarray
    share: float

    @property
    def parts(self) -> int:
        return self.weights.shape[1]

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        return softmax(features(vectors) @ self.weights)

    def place(self, vectors: np.ndarray) -> np.ndarray:
        return self.probabilities(vectors).argmax(axis=1)


def features(vectors: np.ndarray) -> np.ndarray:
    """Directions, scaled to components of about 1, and a constant."""
    norm = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    scaled = vectors / np.where(norm > 0, norm, 1) * np.sqrt(max(1, vectors.shape[1]))
    return np.hstack([scaled, np.ones((len(vectors), 1))])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def searchable(rows: DataFrame, vector: str) -> DataFrame:
    """``vec_id`` and ``v`` of the rows that take part, each once."""
    given = vector_rows(rows, vector).filter(F.col("vec_id").isNotNull() & F.exists("v", lambda x: x != 0))
    return given.dropDuplicates(["vec_id", "v"])


def best_of(asking: pa.Table, others: pa.Table, k: int) -> dict:
    """The ``k`` best rows of a tile for each query. A matrix product, with a bound on its error, leaves the few whose
    scores are then summed in the order of the dimensions."""
    q, c = matrix(column(asking, "v")), matrix(column(others, "v"))
    dims = min(q.shape[1], c.shape[1])
    q, c = q[:, :dims], np.ascontiguousarray(c[:, :dims])
    q_ids, c_ids = (column(t, "vec_id").to_numpy() for t in (asking, others))
    error = 4 * (dims + 1) * 2.0**-52 * np.sqrt((q**2).sum(axis=1)) * np.sqrt((c**2).sum(axis=1)).max(initial=0)
    found: list[tuple[int, int, float]] = []
    step = max(1, SLAB // len(c))
    for start in range(0, len(q), step):
        for j, near in enumerate(q[start : start + step] @ c.T, start):
            chosen = np.flatnonzero(c_ids != q_ids[j])
            if len(chosen) > k and np.isfinite(near).all():
                near = near[chosen]
                chosen = chosen[near >= np.partition(near, len(near) - k)[len(near) - k] - 2 * error[j]]
            score = np.zeros(len(chosen))
            for d in range(dims):
                score += q[j, d] * c[chosen, d]
            ranked = sorted(zip((-score).tolist(), c_ids[chosen].tolist()))[:k]
            found += [(int(q_ids[j]), i, 0.0 - s) for s, i in ranked]
    return {name: [f[i] for f in found] for i, name in enumerate(("query_id", "vec_id", "score"))}


def nearest(asking: DataFrame, others: DataFrame, keys: list[str], k: int) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the best of all cells."""
    near = on_cells(asking, others, keys, lambda a, b: best_of(a, b, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def sampled_neighbours(asking: DataFrame, others: DataFrame, k: int) -> np.ndarray:
    """(id, neighbour's id) pairs among sampled rows: at most ``SAMPLE`` times ``k``."""
    cells = tiles(SAMPLE, ASKED)
    tiled = asking.withColumn("cell", tile(SAMPLE, ASKED, "vec_id"))
    every = others.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    pairs = nearest(tiled, every, ["cell"], k).select("query_id", "vec_id").toPandas()
    return pairs.to_numpy(dtype=np.int64).reshape(-1, 2)


def balanced_centres(rows: np.ndarray, parts: int, room: int) -> np.ndarray:
    """A part for each row: rows, the surest first, go to the nearest centre that has room; centres follow their rows."""
    centres = rows[:: max(1, len(rows) // parts)][:parts]
    place = np.zeros(len(rows), dtype=np.int64)
    for _ in range(10):
        score = rows @ centres.T
        wishes = np.argsort(-score, axis=1, kind="stable")
        size = np.zeros(parts, dtype=np.int64)
        for r in np.argsort(-score.max(axis=1), kind="stable"):
            place[r] = next(p for p in wishes[r] if size[p] < room)
            size[place[r]] += 1
        sums = np.stack([rows[place == p].sum(axis=0) for p in range(parts)])
        norm = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        centres = sums / np.where(norm > 0, norm, 1)
    return place


def neighbour_counts(place: np.ndarray, edges: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts): how many ends of a row's edges lie in each part."""
    out = np.zeros((len(place), parts))
    np.add.at(out, (edges[:, 0], place[edges[:, 1]]), 1)
    np.add.at(out, (edges[:, 1], place[edges[:, 0]]), 1)
    return out


def balanced_parts(place: np.ndarray, edges: np.ndarray, parts: int, room: int) -> np.ndarray:
    """Moves rows to the part of most of their neighbours, the largest gains first, while it has room. Half of
    the moves of a round are left for the next one, as moves of neighbours change each other's gain."""
    place = place.copy()
    dice = np.random.default_rng(1)
    each = np.arange(len(place))
    size = np.bincount(place, minlength=parts)
    floor = int(len(place) / parts / ROOM**3)
    for _ in range(60):
        counts = neighbour_counts(place, edges, parts)
        to = counts.argmax(axis=1)
        gain = counts[each, to] - counts[each, place]
        moved = 0
        for r in np.argsort(-gain, kind="stable"):
            if gain[r] <= 0:
                break
            if dice.random() < 0.5 and size[to[r]] < room and size[place[r]] > floor:
                size[place[r]] -= 1
                size[to[r]] += 1
                place[r] = to[r]
                moved += 1
        if not moved:
            break
    return place


def fit_softmax(x: np.ndarray, shares: np.ndarray, steps: int = 300) -> np.ndarray:
    w, v = np.zeros((x.shape[1], shares.shape[1])), 0.0
    for _ in range(steps):
        v = 0.9 * v - 0.1 * (x.T @ (softmax(x @ w) - shares) / len(x) + 1e-5 * w)
        w = w + v
    return w


def fit(stored: DataFrame, k: int = 20, target: float = 0.95, parts: int = PARTS, sample: int = SAMPLE) -> Router:
    """Fits on the ``sample`` rows with the smallest hashes, one per id; ``stored`` are searchable rows."""
    chosen = stored.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(sample).groupBy("vec_id").agg(F.min("v").alias("v"))
    chosen = cut(chosen, "routing-sample")
    rows = sorted((r["vec_id"], r["v"]) for r in chosen.collect())
    ids = np.array([i for i, _ in rows], dtype=np.int64)
    vectors = matrix(pa.array([v for _, v in rows], type=pa.list_(pa.float64())))
    parts = min(parts, len(ids) // LEAST)
    if parts < 2:
        return Router(np.zeros((vectors.shape[1] + 1, 1)), 1.0)
    held = F.pmod(F.xxhash64(F.lit("held out"), "vec_id"), F.lit(HELD_OUT)) == 0
    known = np.isin(ids, [r["vec_id"] for r in chosen.filter(~held).select("vec_id").collect()])
    edges = np.searchsorted(ids[known], sampled_neighbours(chosen.filter(~held), chosen.filter(~held), DEGREE))
    room = int(ROOM * known.sum() / parts) + 1
    x = features(vectors[known])
    place = balanced_parts(balanced_centres(x[:, :-1], parts, room), edges, parts, room)
    counts = neighbour_counts(place, edges, parts)
    shares = counts + DEGREE * np.eye(parts)[place]
    router = Router(fit_softmax(x, shares / shares.sum(axis=1, keepdims=True)), 1.0)
    unseen = np.searchsorted(ids, sampled_neighbours(chosen.filter(held), chosen, k))
    return router._replace(share=share_needed(router, vectors, unseen, target))


def share_needed(router: Router, vectors: np.ndarray, pairs: np.ndarray, target: float) -> float:
    """The share of probability at which ``target`` of the pairs' second rows lie in parts probed for the first."""
    if not len(pairs):
        return 1.0
    p = router.probabilities(vectors[pairs[:, 0]])
    found = p[np.arange(len(pairs)), router.place(vectors[pairs[:, 1]])]
    before = np.where(p > found[:, None], p, 0).sum(axis=1)  # what more probable parts hold together
    return float(np.quantile(before, target, method="higher"))


def probed(p: np.ndarray, share: float, sizes: np.ndarray, least: np.ndarray) -> list[list[int]]:
    """For each query its parts: while the more probable ones hold no more than ``share`` of the probability, or fewer than ``least`` rows."""
    order = np.argsort(-p, axis=1, kind="stable")
    sorted_p = np.take_along_axis(p, order, axis=1)
    before = np.cumsum(sorted_p, axis=1) - sorted_p
    rows_before = np.cumsum(sizes[order], axis=1) - sizes[order]
    wanted = (before <= share * (1 + 1e-9)) | (rows_before < least[:, None])
    return [o[w].tolist() for o, w in zip(order, wanted)]


def search(rows: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", target: float = 0.95, parts: int = PARTS, sample: int = SAMPLE) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: the nearest rows found by inner product for each row
    that ``is_query`` (a condition on ``vec_id``) chooses. The sizes of the parts are all that the driver learns of the rows."""
    stored = cut(searchable(rows, vector), "routed-rows")
    router = fit(stored, k, target, parts, sample)
    width = len(router.weights) - 1
    placed = map_batches(stored, lambda b: {"vec_id": b.column("vec_id"), "v": b.column("v"), "part": router.place(matrix(b.column("v"), width))}, f"vec_id long, v {kind_of(stored)}, part int")
    sizes = counted(placed, router.parts)
    asked = stored.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("own"))

    def route(batch: pa.RecordBatch) -> dict:
        p = router.probabilities(matrix(batch.column("v"), width))
        least = batch.column("own").to_numpy() + k
        return {"vec_id": batch.column("vec_id"), "v": batch.column("v"), "parts": probed(p, router.share, sizes, least)}

    routed = map_batches(asked, route, f"vec_id long, v {kind_of(stored)}, parts array<int>")
    asking = cut(routed.select("vec_id", "v", F.explode("parts").alias("part")), "routed-queries")
    n_asking = counted(asking, router.parts)
    c_tiles, q_tiles = ([tiles(int(n), most) for n in ns] for ns, most in ((sizes, ROWS), (n_asking, ASKED)))
    by_part = lambda ns: F.array(*[F.lit(n) for n in ns])[F.col("part")]
    every = lambda ns: F.explode(F.sequence(F.lit(0), by_part(ns) - 1))
    of = lambda ns, *by: F.pmod(F.xxhash64(*by), by_part(ns)).cast("int")
    left = asking.withColumn("qt", of(q_tiles, "vec_id")).withColumn("ct", every(c_tiles))
    right = placed.withColumn("ct", of(c_tiles, "vec_id", "v")).withColumn("qt", every(q_tiles))
    return nearest(left, right, ["part", "ct", "qt"], k)


def kind_of(stored: DataFrame) -> str:
    return stored.schema["v"].dataType.simpleString()


def counted(rows: DataFrame, parts: int) -> np.ndarray:
    """Rows of each part."""
    out = np.zeros(parts, dtype=np.int64)
    for r in rows.groupBy("part").count().collect():
        out[r["part"]] = r["count"]
    return out
