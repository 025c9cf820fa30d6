"""Operators on vectors: packed products, Walsh codes, learned partitions."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crosswalk.llm import codes, negatives, queries, routed
from crosswalk.llm.vectors import whole

NAN, INF = float("nan"), float("inf")
ODD = [
    (0, [1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [NAN, 1.0], 1), (4, [INF, 1.0], 1), (5, [], 1), (6, [0.5], None), (7, [1.0, 2.0, 9.0], 2),
    (None, [1.0, 1.0], 1), (8, [1.0, 2.0], 2), (8, [1.0, 2.0], 2), (0, [1.0, 2.0], 1), (9, [1.0, 1.5], 1), (10, [0.0, 0.0], 1), (11, [1.0, 0.9], 3), (12, [1.0, 0.9], 3),
]
CLASH = ["'x' AS rank", "'x' AS v", "'x' AS score", "'x' AS at", "'x' AS ct", "'x' AS part", "'x' AS code", "'x' AS error", "'x' AS own", "'x' AS positives", "'x' AS n"]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "vec_id long, embedding array<float>, label int").selectExpr("*", *CLASH)


@pytest.fixture(scope="module")
def embeddings(spark, data_dir):
    return [tuple(r) for r in spark.read.parquet(f"{data_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]


# ---- hard negatives


def plain_negatives(rows, is_anchor, positives=5, negatives=10, scale=256):
    kept = {(i, y, tuple(v)): [math.floor(scale * float(x)) for x in v] for i, v, y in rows if i is not None and y is not None and usable(v)}
    anchors = {}
    for (i, y, v), whole_v in sorted(kept.items(), reverse=True):
        if is_anchor(i):
            anchors[i] = (y, whole_v)
    out = []
    for a, (label, v) in anchors.items():
        scored = sorted((-dot(v, w), i, y) for (i, y, _), w in kept.items() if i != a)
        for place, (p, pid, _) in enumerate([s for s in scored if s[2] == label][:positives], 1):
            fits = [(-s, i) for s, i, y in scored if y != label and 30 * -p <= 100 * -s <= 90 * -p][:negatives]
            out += [(a, pid, n, i, -p, s, place) for n, (s, i) in enumerate(fits, 1)]
    return sorted(out)


def mined(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score, r.positive_rank) for r in df.collect())


def test_negatives_equal_brute_force(spark, data_dir, embeddings):
    relabelled = [(i, v, (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in embeddings]
    assert mined(queries.QUERIES["op11_packed_negatives"](spark, data_dir)) == plain_negatives(relabelled, lambda i: i % 100 == 0)


@pytest.mark.parametrize("scale", [0.02, 1.0, 1e5, 1e6])
def test_negatives_in_small_tiles(spark, monkeypatch, scale):
    """Several tiles on both sides, ties, a label that nearly all rows have, and fields beyond a machine word."""
    monkeypatch.setattr(negatives, "ROWS", 60)
    monkeypatch.setattr(negatives, "ANCHORS", 9)
    monkeypatch.setattr(negatives, "SLAB", 50)
    rnd = random.Random(7)
    rows = [(i, [scale * max(-2.0, rnd.gauss(0.3, 1)) for _ in range(12)], 0 if i % 5 else rnd.randrange(1, 4)) for i in range(200)]
    rows += [(500 + i, [scale] * 12, i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    assert mined(negatives.mine(df, F.col("vec_id") % 10 == 0)) == plain_negatives(rows, lambda i: i % 10 == 0)


@pytest.mark.parametrize("size", [1, 100, 1 << 20, 1 << 40])
def test_packed_fields_unpack_to_exact_scores(size):
    rnd = np.random.default_rng(3)
    a, c = rnd.integers(-size, size, (5, 33)), rnd.integers(-size, size, (17, 33))
    bias = -int(a.min())
    got = negatives.Packed(c, int(a.max()) + bias).scores(a, bias)
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, w)) for w in c] for r in a]


def test_packing_puts_several_candidates_in_a_word():
    a, c = np.full((1, 64), 100), np.full((6, 64), -100)
    assert negatives.Packed(c, 200).fields >= 2


def test_negatives_of_odd_rows(odd):
    rows = [(i, None if v is None else v, y) for i, v, y in ODD]
    floats = [(i, v and [x if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]
    is_anchor = lambda i: i in (0, 8, 9, 11)
    assert mined(negatives.mine(odd, F.col("vec_id").isin(0, 8, 9, 11))) == plain_negatives(floats, is_anchor)
    assert negatives.mine(odd.limit(0), F.col("vec_id") == 0).count() == 0
    assert negatives.mine(odd, F.col("vec_id") < 0).count() == 0


# ---- vector codes


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, y, [math.floor(1024 * float(x)) for x in v]) for i, v, y in rows if usable(v)]
    width = -(-max((len(v) for _, _, v in kept), default=0) // parts) * parts
    size = width // parts
    full = [v + [0] * (width - len(v)) for _, _, v in kept]
    cut = [[v[p * size : (p + 1) * size] for v in full] for p in range(parts)]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1] is not None, kept[r][1] or 0, kept[r][2]))[:entries]
    books = [[list(c[r]) for r in order] for c in cut]

    def assign():
        return [[min((sum((x - y) ** 2 for x, y in zip(v, b)), e) for e, b in enumerate(book)) for v in c] for c, book in zip(cut, books)]

    for _ in range(rounds):
        for c, book, chosen in zip(cut, books, assign()):
            groups = defaultdict(list)
            for v, (_, e) in zip(c, chosen):
                groups[e].append(v)
            for e, vs in groups.items():
                book[e] = [sum(col) // len(vs) for col in zip(*vs)]
    final = assign()
    errors = [sum(f[r][0] for f in final) for r in range(len(kept))]
    totals = defaultdict(int)
    for (_, y, _), e in zip(kept, errors):
        totals[y] += e
    digest = hashlib.sha256(",".join(str(x) for book in books for b in book for x in b).encode()).hexdigest()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted([(i, "".join(f"{f[r][1]:02x}" for f in final), errors[r], totals[y], digest) for r, (i, y, _) in enumerate(kept)], key=key)


def coded(df):
    rows = [(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_codes_equal_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 0.1) for _ in range(12)], rnd.choice([None, 0, 1])) for i in range(330)]
    rows += [(400 + i, rows[i][1], 2) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    assert coded(codes.compress(df)) == plain_codes(rows)


def test_codes_of_odd_rows(odd):
    floats = [(i, v and [x if x is None else float(np.float32(x)) for x in v], y) for i, v, y in ODD]
    assert coded(codes.compress(odd)) == plain_codes(floats)
    assert codes.compress(odd.limit(0)).count() == 0
    assert coded(codes.compress(odd.filter("vec_id = 5")))[0][1] == "00000000"


@pytest.mark.parametrize("size", [1, 5, 8, 16, 19])
@pytest.mark.parametrize("largest", [3, 1 << 12, 1 << 40])
def test_elimination_keeps_the_nearest_entry(size, largest):
    rnd = np.random.default_rng(size)
    parts, book = rnd.integers(-largest, largest, (70, size)), rnd.integers(-largest, largest, (40, size))
    book[7] = book[3]
    index, distance = codes.nearest(parts, book)
    for v, i, d in zip(parts.tolist(), index, distance):
        assert (d, i) == min((sum((x - y) ** 2 for x, y in zip(v, b)), e) for e, b in enumerate(book.tolist()))


def test_walsh_rows_are_orthogonal_and_in_sequency_order():
    h = codes.walsh(16)
    assert (h @ h.T == 16 * np.eye(16)).all()
    assert [(np.diff(r) != 0).sum() for r in h] == list(range(16))


def test_huge_components_stay_exact():
    assert whole(np.array([[1e300, -0.5]]), 4).tolist() == [[int(1e300) * 4, -2]]


# ---- learned partitions


def plain_nearest(rows, is_query, k=20):
    kept = sorted({(i, tuple(v)) for i, v, _ in rows if i is not None and usable(v) and any(v)})
    asked = {}
    for i, v in reversed(kept):
        if is_query(i):
            asked[i] = v
    out = {}
    for q, v in asked.items():
        scored = []
        for i, w in kept:
            if i != q:
                s = 0.0
                for x, y in zip(v, w):
                    s += float(x) * float(y)
                scored.append((-s, i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def nearest_found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(found, exact):
    return sum(len({i for i, _ in found[q]} & {i for i, _ in best}) for q, best in exact.items()) / sum(map(len, exact.values()))


def test_partitions_reach_the_recall_on_the_table(spark, embeddings, data_dir):
    found = nearest_found(queries.QUERIES["op13_learned_partitions"](spark, data_dir))
    exact = plain_nearest(embeddings, lambda i: i % 20 == 0)
    assert found.keys() == exact.keys() and all(len(found[q]) == 20 for q in exact)
    assert recall(found, exact) >= 0.9
    scores = {q: dict(plain_nearest([r for r in embeddings if r[0] == q or r[0] in {i for i, _ in best}], lambda i: i == q)[q]) for q, best in list(found.items())[:5]}
    assert all(dict(found[q]) == s for q, s in scores.items())


def test_partitions_of_clusters(spark, monkeypatch):
    """Clustered rows, a third of them near one centre: few rows are compared, and in tiles, at the recall asked for."""
    monkeypatch.setattr(routed, "ROWS", 200)
    monkeypatch.setattr(routed, "ASKED", 20)
    rnd = random.Random(2)
    centres = [[rnd.gauss(0, 1) for _ in range(24)] for _ in range(12)]
    rows = [(i, [x + rnd.gauss(0, 0.15) for x in centres[0 if i % 3 == 0 else rnd.randrange(12)]], 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    exact = plain_nearest(rows, lambda i: i % 50 == 0)
    assert recall(nearest_found(routed.search(df, F.col("vec_id") % 50 == 0, sample=1500)), exact) >= 0.9
    stored = routed.searchable(df, "embedding").cache()
    router = routed.fit(stored, sample=1500)
    vectors = np.array([v for _, v, _ in rows])
    sizes = np.bincount(router.place(vectors), minlength=router.parts)
    probes = routed.probed(router.probabilities(vectors[::50]), router.share, sizes, np.full(60, 21))
    assert sizes.max() < 0.45 * len(rows)
    assert np.mean([sizes[p].sum() for p in probes]) < 0.6 * len(rows)
    stored.unpersist()


def test_balanced_parts_keep_their_room_and_cut_fewer_edges():
    rnd = np.random.default_rng(0)
    group = rnd.integers(0, 4, 400)
    edges = np.array([(a, b) for a in range(400) for b in rnd.choice(np.flatnonzero(group == group[a]), 6)])
    start = rnd.integers(0, 4, 400)
    room = int(routed.ROOM * 100) + 1
    start = np.argsort(np.argsort(start, kind="stable")) // 100
    place = routed.balanced_parts(start, edges, 4, room)
    crossing = lambda p: (p[edges[:, 0]] != p[edges[:, 1]]).mean()
    assert np.bincount(place).max() <= room and crossing(place) < 0.6 * crossing(start)


def test_nearest_of_odd_rows(odd):
    floats = [(i, v and [x if x is None else float(np.float32(x)) for x in v], y) for i, v, y in ODD]
    assert nearest_found(routed.search(odd, F.col("vec_id") % 4 == 0)) == plain_nearest(floats, lambda i: i % 4 == 0)
    assert routed.search(odd.limit(0), F.col("vec_id") == 0).count() == 0
    assert routed.search(odd, F.col("vec_id") < 0).count() == 0


def test_a_query_gets_all_rows_where_there_are_few(spark):
    rnd = random.Random(1)
    rows = [(i % 140, [rnd.gauss(0, 1) for _ in range(6)], 0) for i in range(280)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = nearest_found(routed.search(df, F.col("vec_id") % 20 == 0, k=1000))
    assert found == plain_nearest(rows, lambda i: i % 20 == 0, k=1000)


def test_equal_vectors_give_equal_scores_in_any_tile():
    c = np.random.default_rng(1).normal(size=(50, 37))
    c[10:40] = c[5]
    asking = pa.table({"vec_id": [100], "v": [c[5].tolist()]})
    found = routed.best_of(asking, pa.table({"vec_id": list(range(50)), "v": c.tolist()}), 31)
    assert len(set(found["score"])) == 1 and found["vec_id"] == [5, *range(10, 40)]
