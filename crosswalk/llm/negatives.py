"""Hard negatives by Kronecker-packed products (operator 11).

Components become whole numbers. A tile of candidates is stored dimension by dimension; the components of several candidates,
made non-negative by a bias, share one wide integer, each in a field wide enough for any score of the tile. One product
of an anchor's (biased) component with such an integer multiplies it with all of these candidates' components, and sums
over the dimensions never leave their fields. The fields of the sum are unpacked and the biases' share is taken off:
scores are exact. Where a field needs more than 62 bits, the wide integers are Python's and have no limit.

Two passes over cells of an anchor tile and a candidate tile: the first finds each anchor's positives, the second, for
each positive, the best rows of other labels in its range of scores. A cell leaves at most the asked number of rows per anchor
and positive; the best of them are chosen by a window, of which each task hands on only its best rows.

Defined results: rows with a null id, label or vector, or with null, NaN or infinite components, take no part. Rows equal in id, label
and vector count once. Anchors that share an id: the smallest (label, vector) is the anchor. A row is never a
positive or negative of an anchor with its own id. Vectors of different lengths score over their common dimensions; an empty
vector scores 0. Ties go to the smaller id. Scores beyond 64 bits are compared within a cell, and then held within
64 bits. An anchor without another row of its label, or a positive with no row in its range, gives no row; an empty table gives an
empty result. Further columns are left out, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosswalk.llm.vectors import column, matrix, on_cells, tile, tiles, to_long, vector_rows, whole
from crosswalk.session import cut

ANCHORS = 2_048  # anchors of a tile, on average
ROWS = 4_096  # candidates of a tile, on average
SLAB = 1 << 20  # wide integers that one step of the products works on
WORD = 62  # bits of a machine word that fields may fill
WIDE = 8  # fields of a wide integer beyond the machine word


class Packed:
    """Candidates' components in fields of wide integers, dimension by dimension."""

    def __init__(self, values: np.ndarray, largest: int):
        """``largest``: no anchor component, biased, is larger."""
        n, dims = values.shape
        self.n, self.bias = n, max(0, -int(values.min(initial=0)))
        width = max(1, (largest * (int(values.max(initial=0)) + self.bias) * max(1, dims)).bit_length())
        self.width, self.fields = width, max(1, WORD // width) if width <= WORD else WIDE
        self.kind = np.int64 if width <= WORD else object
        self.sums = values.sum(axis=1) if dims else np.zeros(n, dtype=np.int64)
        biased = np.zeros((-(-n // self.fields) * self.fields, dims), dtype=self.kind)
        biased[:n] = values.astype(self.kind) + self.bias
        parts = biased.reshape(-1, self.fields, dims)
        self.words = np.zeros((dims, len(parts)), dtype=self.kind)
        for f in range(self.fields):
            self.words += parts[:, f].T << (f * width)

    def scores(self, anchors: np.ndarray, bias: int) -> np.ndarray:
        """(anchors, candidates): exact inner products; ``anchors`` are as they are, ``bias`` makes them non-negative."""
        dims = len(self.words)
        lifted = anchors.astype(self.kind) + bias
        total = np.zeros((len(anchors), self.words.shape[1]), dtype=self.kind)
        for d in range(dims):
            total += lifted[:, d, None] * self.words[d]
        mask = (1 << self.width) - 1
        fields = np.stack([(total >> (f * self.width)) & mask for f in range(self.fields)], axis=2)
        out = fields.reshape(len(anchors), -1)[:, : self.n]
        own = anchors.astype(self.kind).sum(axis=1) if dims else np.zeros(len(anchors), dtype=self.kind)
        return out - self.bias * own[:, None] - bias * self.sums.astype(self.kind) - dims * bias * self.bias


def scored(asking: pa.Table, others: pa.Table, scale: int):
    """(anchor's row number, its scores with all candidates of the tile), one anchor after the other."""
    anchors, rows = whole(matrix(column(asking, "v")), scale), whole(matrix(column(others, "v")), scale)
    dims = min(anchors.shape[1], rows.shape[1])
    anchors, rows = anchors[:, :dims], rows[:, :dims]
    bias = max(0, -int(anchors.min(initial=0)))
    packed = Packed(rows, int(anchors.max(initial=0)) + bias)
    step = max(1, SLAB // max(1, packed.words.shape[1]))
    for start in range(0, len(anchors), step):
        yield from enumerate(packed.scores(anchors[start : start + step], bias), start)


def first(chosen: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(score, id) of the ``k`` best rows among ``chosen`` (row numbers), ties by smaller id."""
    if len(chosen) > 4 * k and scores.dtype != object:
        s = scores[chosen]
        chosen = chosen[s >= np.partition(s, len(s) - k)[len(s) - k]]
    best = sorted(zip((-s for s in scores[chosen].tolist()), ids[chosen].tolist()))[:k]
    return [(-s, i) for s, i in best]


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return column(table, name).to_numpy(zero_copy_only=False)


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    vector: str = "embedding",
    label: Column | None = None,
    scale: int = 256,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score`` and
    ``positive_rank`` (from 1).

    Anchors are the rows that ``is_anchor`` (a condition on ``vec_id``) chooses; their positives the ``positives``
    best other rows of their label; a positive's negatives the ``negatives`` best rows of other labels whose score is
    between ``low`` and ``high`` hundredths of the positive's. ``label`` is worked out on ``rows``. Components
    become floor(``scale`` * x).
    """
    given = vector_rows(rows, vector, (F.col("label") if label is None else label).alias("label"))
    stored = cut(given.dropna(subset=["vec_id", "label"]).dropDuplicates(["vec_id", "label", "v"]), "negative-rows")
    row = stored.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("anchors")).first()
    n, n_anchors = row["n"], row["anchors"]
    others = stored.withColumn("ct", tile(n, ROWS, "vec_id", "label", "v"))
    others = others.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(tiles(n_anchors, ANCHORS) - 1))))
    asked = stored.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    asked = asked.select("vec_id", "row.*", tile(n_anchors, ANCHORS, "vec_id").alias("at"))
    every = F.explode(F.sequence(F.lit(0), F.lit(tiles(n, ROWS) - 1))).alias("ct")
    columns = [F.col(c) for c in ("vec_id", "label", "v", "at")]

    def nearest(asking: pa.Table, tile_rows: pa.Table) -> dict:
        anchors, labels, ids, other = numbers(asking, "vec_id"), numbers(asking, "label"), numbers(tile_rows, "vec_id"), numbers(tile_rows, "label")
        found = []
        for a, scores in scored(asking, tile_rows, scale):
            chosen = np.flatnonzero((other == labels[a]) & (ids != anchors[a]))
            found += [(int(anchors[a]), i, to_long(s)) for s, i in first(chosen, scores, ids, positives)]
        return {name: [f[i] for f in found] for i, name in enumerate(("vec_id", "positive_id", "score"))}

    near = on_cells(asked.select(*columns, every), others, ["at", "ct"], nearest, "vec_id long, positive_id long, score long")
    best = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.col("score").desc(), "positive_id"))
    pairs = near.withColumn("positive_rank", best).filter(F.col("positive_rank") <= positives)
    listed = pairs.groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("positive_rank", "positive_id", "score"))).alias("positives"))
    with_positives = cut(asked.join(listed, "vec_id"), "negative-anchors")

    def between(asking: pa.Table, tile_rows: pa.Table) -> dict:
        anchors, labels, ids, other = numbers(asking, "vec_id"), numbers(asking, "label"), numbers(tile_rows, "vec_id"), numbers(tile_rows, "label")
        wanted = column(asking, "positives").to_pylist()
        found = []
        for a, scores in scored(asking, tile_rows, scale):
            different = np.flatnonzero((other != labels[a]) & (ids != anchors[a]))
            s = scores[different]
            for p in wanted[a]:
                least, most = -(-low * p["score"] // 100), high * p["score"] // 100
                chosen = different[(s >= least) & (s <= most)]
                head = (int(anchors[a]), p["positive_id"], p["score"], p["positive_rank"])
                found += [(*head, i, to_long(x)) for x, i in first(chosen, scores, ids, negatives)]
        names = ("anchor_id", "positive_id", "positive_score", "positive_rank", "negative_id", "negative_score")
        return {name: [f[i] for f in found] for i, name in enumerate(names)}

    schema = "anchor_id long, positive_id long, positive_score long, positive_rank int, negative_id long, negative_score long"
    hard = on_cells(with_positives.select(*columns, "positives", every), others, ["at", "ct"], between, schema)
    order = Window.partitionBy("anchor_id", "positive_rank").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")
