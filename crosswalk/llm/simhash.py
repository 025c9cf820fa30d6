"""Near-duplicates by SimHash fingerprints and pigeonhole blocks (operator 5).

A text's fingerprint has a bit set where over half of its shingles' hashes do. Two fingerprints that differ in at most k
bits agree on at least b - k of b blocks, whatever bits differ. So every fingerprint is dealt out under each choice
of b - k blocks, and only those that share a choice are compared bit by bit. Linked fingerprints are then joined to
groups.

Equal fingerprints are one row from the start, however many documents share them. Fingerprints that share a choice of
blocks arrive sorted, and a task finds how they hang together without listing pairs: it starts at one, takes out all
within k bits, goes on from those, and compares only with what is left. So a group of thousands of close copies
costs little more than its size, and gives one link per member. Rows are counted per choice first: where more than ``limit``
fingerprints agree on one, the same is done with the bits that are still open, so that only those meet that agree on
many more bits; no link is lost, as two within k bits differ in at most k of the open bits too. Once few bits are open, very
many fingerprints can't be far apart from each other any more, and are taken out many at a time.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Defined results: a null text or one without words has
fingerprint zero, which is linked like any other; fewer words than a shingle holds are one shingle. A null id takes part,
but does not name a group, unless no row of the group has an id (then the group's id is null). Repeated rows get equal
results. Very long texts are hashed in pieces. Columns with clashing names are left out or, if in ``keep``, handed on. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.llm.common import add_columns, ascii_words, components, keep_columns, texts
from crosswalk.session import cut

PIECE = 1 << 16  # hashes whose bits are counted at a time
LIMIT = 20_000  # fingerprints of a bucket that meet as they are
FEW_BITS = 24  # open bits below which buckets are not narrowed again
BROADCAST_KEYS = 100_000  # keys of crowded buckets that are broadcast at most


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Signed 64-bit fingerprint of a whole text."""
    from xxhash import xxh64_intdigest

    words = [w.lower() for w in ascii_words(text)] if text else []
    if not words:
        return 0
    parts = [words] if len(words) < shingle else zip(*[words[k:] for k in range(shingle)])
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, parts), repeat(seed)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, PIECE):
        bits = np.unpackbits(hashes[at : at + PIECE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint as a signed long) and the columns in ``keep`` of every row."""

    def run(batch):
        return {"fp": [fingerprint(t, shingle, seed) for t in batch.column("text").to_pylist()]}

    return add_columns(texts(docs, *keep_columns(docs, keep)), run, "fp long").drop("text")


def choices(bits: list[int], blocks: int, distance: int) -> list[int]:
    """Masks of all choices of ``blocks - distance`` out of near-equal blocks of the given bits. Where there are fewer bits than
    blocks, each is a block of its own."""
    blocks = min(blocks, len(bits))
    edges = [round(len(bits) * k / blocks) for k in range(blocks + 1)]
    of_block = [sum(1 << bit for bit in bits[a:b]) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(of_block, blocks - distance)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def narrowed(masks: list[int], blocks: int, distance: int) -> list[list[int]]:
    """For each mask the masks that add to it a choice of blocks of the bits it leaves open."""
    return [[m | c for c in choices([k for k in range(64) if not m >> k & 1], blocks, distance)] for m in masks]


def keyed(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Adds ``key``: rows of equal ``number`` have it in common if they agree on the bits of that mask."""
    chosen = F.get(F.array(*[F.lit(signed(m)) for m in masks]), F.col("number"))
    return rows.withColumn("key", F.xxhash64(F.col("fp").bitwiseAND(chosen), "number"))


def bits_apart(a: np.ndarray, b) -> np.ndarray:
    """Differing bits; counted on unsigned values, as numpy counts those of the absolute value of signed ones."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(found: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (root, member) that join all that hang together by steps of at most ``distance`` bits."""
    left = np.unique(found)
    roots, members = [], []
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            near = bits_apart(left, front.pop()) <= distance
            if near.any():
                hit = left[near]
                left = left[~near]
                roots.append(np.full(len(hit), root))
                members.append(hit)
                front.extend(hit)
    return (np.concatenate(roots), np.concatenate(members)) if roots else (left[:0], left[:0])


def bucket_links(rows: DataFrame, distance: int) -> DataFrame:
    """Links within buckets of rows (``key``, ``fp``) that lie together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            two = starts[ends - starts == 2]
            near = two[bits_apart(fps[two], fps[two + 1]) <= distance]
            a, b = [fps[near]], [fps[near + 1]]
            for s, e in zip(starts, ends):
                if e - s > 2:
                    root, member = forest(fps[s:e], distance)
                    a.append(root)
                    b.append(member)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), type=pa.int64()) for x in (a, b)], names=["a", "b"])

        open_keys, open_fps = [], []  # the last bucket may go on in the next batch
        for batch in batches:
            keys, fps = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            if last or (open_keys and open_keys[-1][-1] != keys[0]):
                # What came before the batch's last key is complete.
                yield close(np.concatenate([*open_keys, keys[:last]]), np.concatenate([*open_fps, fps[:last]]))
                open_keys, open_fps = [], []
            open_keys.append(keys[last:])
            open_fps.append(fps[last:])
        if open_keys:
            yield close(np.concatenate(open_keys), np.concatenate(open_fps))

    return rows.mapInArrow(run, "a long, b long")


def links(fps: DataFrame, distance: int = 4, blocks: int = 7, limit: int = LIMIT) -> DataFrame:
    """Links (``a``, ``b``) between distinct ``fp`` that join exactly those reachable by steps of ``distance`` bits.

    The rows of each key are counted before any of them meet. Those of a key with more than ``limit`` rows are dealt out
    again, under each choice of blocks of the bits that the key leaves open, until no key has so many or too few bits are open for
    many rows that are far apart.
    """
    masks = choices(list(range(64)), blocks, distance)
    numbers = F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("number")
    rows = keyed(fps.select(numbers, "fp"), masks)
    found: list[DataFrame] = []
    while True:
        heavy = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select("key")
        heavy = cut(heavy, "simhash-keys")
        n_heavy = heavy.count() if min(64 - m.bit_count() for m in masks) > FEW_BITS else 0
        light = rows if not n_heavy else rows.join(F.broadcast(heavy) if n_heavy <= BROADCAST_KEYS else heavy, "key", "left_anti")
        found.append(bucket_links(light.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp"), distance))
        if not n_heavy:
            return cut(reduce(DataFrame.unionByName, found).distinct(), "simhash-links")
        more = narrowed(masks, blocks, distance)
        each = len(more[0])
        crowded = rows.join(F.broadcast(heavy) if n_heavy <= BROADCAST_KEYS else heavy, "key", "left_semi")
        again = F.explode(F.sequence(F.col("number") * each, F.col("number") * each + (each - 1))).alias("number")
        masks = [m for ms in more for m in ms]
        rows = keyed(crowded.select(again, "fp"), masks)


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 7, limit: int = LIMIT, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``fp``, the columns in ``keep``, ``root`` (the group's smallest fingerprint) and ``component_id``,
    the smallest id of all documents reachable over links."""
    rows = cut(fingerprints(docs, shingle, keep=keep), "fingerprints")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = components(links(least.select("fp"), distance, blocks, limit), "simhash-groups")
    rooted = least.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select(*rows.columns, "root", "component_id")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
