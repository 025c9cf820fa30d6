"""Sharding by fixed virtual slots (operator 3).

Every record hashes into one of a fixed number of slots, thousands of them, which never changes. A small map says which
shard owns a slot. Bytes and rows are added up per slot, and rebalancing edits the map: slots move from shards
that hold too much to shards that hold too little until the sizes are near equal. Maps are stored as versions; an
older version stays readable. A later run on the same path goes on from the newest version and writes the next one, so
that few records move; shards may be added or removed then. Only the map is worked on by the driver, so that work depends on the number
of slots.

A record's slot follows from its id; without one, from its text. An id or text that holds more records than a slot
should has them dealt out by their place in the stored table, as nothing else tells equal records apart. The map
balances bytes as far as whole slots allow; one record larger than a shard's share cannot be split.

Defined results: a null text has 0 bytes; size is UTF-8 bytes plus 16 per record, also of very long texts. Repeated rows get places of
their own. Columns beside id and text are left out, whatever their names. An empty table gives an even map and an empty result.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosswalk.llm.common import number_in_groups, texts
from crosswalk.session import cut, scratch_dir

RECORD_BYTES = 16
PIECE_ROWS = 100_000  # rows of a shard that are numbered in one task, about


def sizes(docs: DataFrame) -> DataFrame:
    """Narrow rows: ``doc_id``, ``size``, ``text_crc32``, ``key`` and ``row``, a number that stays once they are stored."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    out = texts(docs).select(
        "doc_id", (F.octet_length(data) + F.lit(RECORD_BYTES)).cast("long").alias("size"), F.crc32(data).cast("long").alias("text_crc32")
    )
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64(F.lit("no id"), "text_crc32", "size"))
    return out.withColumn("key", key).withColumn("row", F.monotonically_increasing_id())


def with_slots(rows: DataFrame, slots: int) -> DataFrame:
    """Adds ``virtual_slot``. Slots with far more rows than others are searched for keys that hold more than a slot's
    share of all rows; there are fewer such keys than slots, and their rows are dealt out one by one."""
    slot = F.pmod(F.xxhash64("key"), F.lit(slots)).cast("int")
    held = {r["slot"]: r["n"] for r in rows.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = max(1, sum(held.values()) // slots)
    full = [k for k, n in held.items() if n > 3 * share + 50]
    if not full:
        return rows.withColumn("virtual_slot", slot)
    counts = rows.filter(slot.isin(full)).groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > share + 10)
    crowded = [r["key"] for r in counts.select("key").collect()]
    dealt = F.pmod(F.xxhash64("key", "row"), F.lit(slots)).cast("int")
    return rows.withColumn("virtual_slot", F.when(F.col("key").isin(crowded), dealt).otherwise(slot))


def slot_bytes(rows: DataFrame, slots: int) -> tuple[np.ndarray, int]:
    """Bytes per slot, and the number of all rows. One figure per slot reaches the driver."""
    found = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    out = np.zeros(slots, dtype=np.int64)
    for r in found:
        out[r["virtual_slot"]] = r["bytes"]
    return out, sum(r["n"] for r in found)


def first_map(slots: int, shards: int) -> np.ndarray:
    """Version 1: slots dealt out in turn."""
    return np.arange(slots) % shards


def rebalance(owner: np.ndarray, size: np.ndarray, shards: int, tolerance: float = 0.0005) -> np.ndarray:
    """Edit a map until the largest and smallest shard differ by at most ``tolerance`` of the mean, or no edit helps.

    Each edit takes the fullest shard and the emptiest one that an edit can help: a slot is moved, or two slots change
    places, such that the larger of the two becomes as small as it can.
    """
    owner = owner.copy()
    total = np.bincount(owner, weights=size, minlength=shards).astype(np.int64)
    held = [sorted((int(size[s]), int(s)) for s in np.flatnonzero(owner == k)) for k in range(shards)]
    allowed = max(1, int(tolerance * size.sum() / shards))
    while True:
        high = int(total.argmax())
        edited = False
        for low in map(int, total.argsort(kind="stable")):
            gap = int(total[high] - total[low])
            if gap <= allowed:
                break
            edit = best_edit(held[high], held[low], gap)
            if edit is None:
                continue
            give, take = edit
            held[high].remove(give)
            place(held[low], give, owner, low)
            moved = give[0]
            if take is not None:
                held[low].remove(take)
                place(held[high], take, owner, high)
                moved -= take[0]
            total[high] -= moved
            total[low] += moved
            edited = True
            break
        if not edited:
            return owner


def place(held: list, slot: tuple[int, int], owner: np.ndarray, shard: int) -> None:
    held.insert(bisect_left(held, slot), slot)
    owner[slot[1]] = shard


def best_edit(high: list, low: list, gap: int) -> tuple | None:
    """The slot to give, and one to take back or None, whose difference in size is nearest to half the gap; None if
    none lies strictly between nothing and the gap."""
    best, best_miss = None, gap / 2
    for give in high:
        for back in nearest(low, give[0] - gap / 2):
            moved = give[0] - (back[0] if back else 0)
            miss = abs(moved - gap / 2)
            if 0 < moved < gap and miss < best_miss:
                best, best_miss = (give, back), miss
    return best


def nearest(low: list, size: float) -> list:
    """Nothing, and the neighbours of a size in a sorted list of slots."""
    at = bisect_left(low, (size, -1))
    return [None, *low[max(0, at - 1) : at + 1]]


def write_map(spark: SparkSession, path: str, version: int, owner: np.ndarray) -> None:
    """Store one version; versions are folders of their own and are never overwritten."""
    rows = [(int(s), int(k)) for s, k in enumerate(owner)]
    spark.createDataFrame(rows, "virtual_slot int, shard int").coalesce(1).write.parquet(f"{path}/version={version}")


def newest_version(spark: SparkSession, path: str) -> int:
    """The number of the newest version under ``path``, 0 if there is none."""
    try:
        every = spark.read.parquet(path)
    except AnalysisException:
        return 0
    return every.agg(F.max(F.col("version").cast("int")).alias("v")).first()["v"] or 0


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(``version``, ``virtual_slot``, ``shard``) of a version, the newest by default."""
    every = spark.read.parquet(path).withColumn("version", F.col("version").cast("int"))
    return every.filter(F.col("version") == (newest_version(spark, path) if version is None else version))


def resized(owner: np.ndarray, size: np.ndarray, shards: int) -> np.ndarray:
    """Slots of shards that are gone go, the largest first, to the shard that holds the least."""
    owner = owner.copy()
    total = np.bincount(owner[owner < shards], weights=size[owner < shards], minlength=shards)
    lost = np.flatnonzero(owner >= shards)
    for s in lost[np.argsort(-size[lost], kind="stable")]:
        owner[s] = int(total.argmin())
        total[owner[s]] += size[s]
    return owner


def edited_map(spark: SparkSession, path: str, size: np.ndarray, shards: int) -> int:
    """Edits the newest map for the sizes measured and stores it; gives its version. The first map deals slots out in turn."""
    slots, version = len(size), newest_version(spark, path)
    if version == 0:
        version = 1
        write_map(spark, path, version, first_map(slots, shards))
    stored = {r["virtual_slot"]: r["shard"] for r in read_map(spark, path, version).collect()}
    if sorted(stored) != list(range(slots)):
        raise ValueError(f"the map under {path} has {len(stored)} slots, not {slots}; their number is fixed")
    owner = resized(np.array([stored[s] for s in range(slots)]), size, shards)
    write_map(spark, path, version + 1, rebalance(owner, size, shards))
    return version + 1


def shard_rows(docs: DataFrame, shards: int, slots: int = 4096, path: str | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``virtual_slot``, ``shard`` and ``slot``, the record's place in its shard.

    The newest map under ``path`` is edited by the measured bytes and stored as the next version; without a map there, version 1
    deals slots out in turn and version 2 is rebalanced. Texts are read once; the rest works on narrow rows. Places are
    numbered within pieces of virtual slots and need no task that holds a whole shard.
    """
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "slot-map")
    rows = with_slots(cut(sizes(docs), "shard-sizes"), slots)
    size, n = slot_bytes(rows, slots)
    version = edited_map(spark, path, size, shards)
    owners = F.broadcast(read_map(spark, path, version).select("virtual_slot", "shard"))  # one row per slot
    owned = rows.join(owners, "virtual_slot")
    split = max(1, -(-n // (PIECE_ROWS * slots)))
    piece = F.col("virtual_slot").cast("long") * split + F.pmod(F.xxhash64("row"), F.lit(split))
    numbered = number_in_groups(owned, ["shard"], [F.col("row")], piece, "slot")
    return numbered.select("doc_id", "size", "text_crc32", "virtual_slot", "shard", "slot")
