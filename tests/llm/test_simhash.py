import random
import re
import time
from collections import defaultdict
from functools import reduce

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from crosswalk.llm import queries, simhash
from crosswalk.llm.common import components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_groups(fps, distance=4):
    """Component by breadth-first search over all pairs of distinct values."""
    left, group = set(fps), {}
    while left:
        root = left.pop()
        front, members = [root], [root]
        while front:
            x = front.pop()
            near = {y for y in left if (x ^ y).bit_count() <= distance}
            left -= near
            members += near
            front += near
        for m in members:
            group[m] = root
    return group


def plain_result(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    group = plain_groups({f for _, f in fps})
    least = defaultdict(list)
    for i, f in fps:
        if i is not None:
            least[group[f]].append(i)
    return sorted(((i, f"{f:016x}", min(least[group[f]], default=None)) for i, f in fps), key=str)


def test_query_equals_brute_force(spark, data_dir, docs):
    got = queries.QUERIES["op5_simhash_blocks"](spark, data_dir).collect()
    assert sorted(map(tuple, got), key=str) == plain_result([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).select("doc_id", simhash.as_hex(F.col("fp")), "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_result([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.fixture(scope="module")
def clusters():
    """Random values, and clusters of values a few bits from a centre or from each other."""
    rnd = random.Random(5)
    fps = {rnd.getrandbits(64) for _ in range(300)} | {0}
    for size, bits in ((400, 2), (60, 4), (40, 7)):
        centre = rnd.getrandbits(64)
        for _ in range(size):
            x = centre
            for k in rnd.sample(range(64), rnd.randint(0, bits)):
                x ^= 1 << k
            fps.add(x)
    x = rnd.getrandbits(64)
    for _ in range(30):  # a chain: each 4 bits from the one before
        for k in rnd.sample(range(64), 4):
            x ^= 1 << k
        fps.add(x)
    return sorted(fps)


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_links_join_what_brute_force_joins(spark, clusters, limit):
    """With a small limit every larger bucket is narrowed, with the same groups."""
    signed = [int(np.uint64(f).astype(np.int64)) for f in clusters]
    fps = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    edges = simhash.links(fps, limit=limit)
    got = {r.node: r.root for r in components(edges, "t").collect()}
    want = plain_groups(clusters)
    same = defaultdict(set)
    for f, s in zip(clusters, signed):
        same[got.get(s, s)].add(want[f])
    assert all(len(v) == 1 for v in same.values())
    assert len(same) == len(set(want.values()))


def test_every_pair_within_distance_shares_a_key(spark):
    rnd = random.Random(1)
    pairs = []
    for _ in range(300):
        x = rnd.getrandbits(64)
        y = x
        for k in rnd.sample(range(64), 4):
            y ^= 1 << k
        pairs.append(tuple(int(np.uint64(v).astype(np.int64)) for v in (x, y)))
    df = spark.createDataFrame(pairs, "x long, y long")
    masks = simhash.choices(list(range(64)), 7, 4)
    some = simhash.narrowed(masks[:3], 7, 4)
    assert len(masks) == 35 and all(len(ms) == 35 and all(m & masks[k] == masks[k] for m in ms) for k, ms in enumerate(some))
    shared = [F.col("x").bitwiseXOR(F.col("y")).bitwiseAND(F.lit(simhash.signed(m))) == 0 for m in masks]
    assert df.filter(~reduce(lambda a, b: a | b, shared)).count() == 0


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)} | {i: 200 for i in range(200, 203)}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


@pytest.mark.parametrize("distance,blocks", [(3, 6), (1, 3), (2, 4)])
def test_other_distances_with_narrowed_buckets(spark, clusters, distance, blocks):
    """Odd distances too, with buckets that are narrowed."""
    signed = [int(np.uint64(f).astype(np.int64)) for f in clusters]
    fps = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    got = {r.node: r.root for r in components(simhash.links(fps, distance, blocks, limit=20), "t").collect()}
    want = plain_groups(clusters, distance)
    same = defaultdict(set)
    for f, s in zip(clusters, signed):
        same[got.get(s, s)].add(want[f])
    assert all(len(v) == 1 for v in same.values()) and len(same) == len(set(want.values()))


def test_a_bucket_of_many_unlinked_fingerprints(spark):
    """200,000 fingerprints that agree on three blocks and are far apart otherwise, and a few pairs among them."""
    rnd = np.random.default_rng(8)
    values = np.unique(rnd.integers(0, 1 << 37, 200_000, dtype=np.uint64) << np.uint64(27) | np.uint64(0x5A5A5A5))
    near = values[:50] ^ np.uint64(1 << 40 | 1 << 60)
    fps = spark.createDataFrame([(int(v),) for v in np.concatenate([values, near]).view(np.int64)], "fp long").distinct()
    start = time.time()
    got = {tuple(sorted((r.a, r.b))) for r in simhash.links(fps).collect()}
    took = time.time() - start
    assert {tuple(sorted((int(a), int(b)))) for a, b in zip(values[:50].view(np.int64), near.view(np.int64))} <= got
    assert len(got) < 60_000  # about a tenth of them have another one within four bits by chance
    assert took < 60, took
