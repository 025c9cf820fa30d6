"""Packing documents into fixed-length sequences by large-item matching (operator 10).

Items above a third of the capacity can share a sequence with at most one other such item. They are matched greedily:
the longest open one with the longest other that still fits. Smaller items, the longest first, go into the
gap they fill best. Items longer than the capacity are cut; only whole pieces of the capacity fill a sequence alone.

Lengths are whole numbers up to the capacity, so the plan is made from the count of each length: it says which run of
items of a length goes to which run of sequences at which offset. The plan's size is bounded by the capacity, not
by the number of documents. The items of a length are numbered by Spark in pieces and then look up their run.

Defined results: a null or empty text is one piece holding only the end mark, a very long one as many pieces as it takes. Repeated rows are packed each on their
own, and equal ones are numbered in as many tasks as others. Columns beside id and text are left out, whatever their names. Special marks written out in a text are what the tokenizer makes of them. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosswalk.llm.common import map_batches, number_in_groups, texts
from crosswalk.session import cut

PIECE_ROWS = 500  # items of one length that are numbered in one task, about
TEXT_ROWS = 1_000  # texts whose words are looked up together
STEP = 1 << 16  # words whose ids are put together at once
CACHE = 400_000  # units whose ids a task remembers before it starts anew
PLAIN = "^(?P<letters>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<marks>[!#$%&()*+,./:;=?@-]*)$"


class WordIds:
    """Ids of words, looked up once per unit and put together for all words of a batch at once.

    The tokenizer splits at white space before anything else, so the ids of a text are those of its words in order. A
    word of plain letters, with marks behind or not, is two of the tokenizer's own units; many units are handed over
    as one string and the ids are told apart by the mark that ends each unit. All other words are units of their own and
    are encoded one by one. Unit n has the ids ``ids[first[n] : first[n] + size[n]]``; unit 0 has none.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.units: dict[str, int] = {"": 0}
        self.odd: dict[str, int] = {"": 0}
        self.first, self.size = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> range:
        """Numbers of new units whose ids stand one after the other."""
        known = len(self.size)
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.ids = np.concatenate([self.ids, ids])
        return range(known, known + len(sizes))

    def one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in words]
        return np.array([i for ids in found for i in ids], dtype="<u4"), np.array([len(ids) for ids in found], dtype=np.int64)

    def learn_units(self, units: list[str]) -> None:
        parts = [units[start : start + 500] for start in range(0, len(units), 500)]
        found = []
        for part, encoded in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(encoded.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            found.append((ids, np.diff(ends, prepend=0)) if len(ends) == len(part) else self.one_by_one(part))
        if found:
            self.units.update(zip(units, self.add(*map(np.concatenate, zip(*found)))))

    def numbers(self, known: dict[str, int], words: list[str], learn) -> np.ndarray:
        new = [w for w in words if w not in known]
        if new:
            learn(new)
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def learn_odd(self, words: list[str]) -> None:
        self.odd.update(zip(words, self.add(*self.one_by_one(words))))

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and where those of each word begin (one more entry for the end)."""
        if len(self.size) > CACHE:
            self.clear()
        coded = words.dictionary_encode()
        parts = pc.extract_regex(coded.dictionary, PLAIN)
        letters, marks = parts.field("letters").filter(parts.is_valid()), parts.field("marks").filter(parts.is_valid())
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        unit = np.zeros((2, len(plain)), dtype=np.int32)
        for side, values in enumerate((pc.utf8_lower(letters), marks)):
            values = values.dictionary_encode()
            unit[side, plain] = self.numbers(self.units, values.dictionary.to_pylist(), self.learn_units)[values.indices.to_numpy()]
        unit[0, ~plain] = self.numbers(self.odd, coded.dictionary.filter(pc.invert(parts.is_valid())).to_pylist(), self.learn_odd)
        indices, ids, begin, done = coded.indices.to_numpy(), [self.ids[:0]], [np.zeros(1, dtype=np.int64)], 0
        for at in range(0, len(indices), STEP):
            both = unit.T[indices[at : at + STEP]].ravel()  # for each word its letters and its marks
            size = self.size[both]
            ends = np.cumsum(size)
            place = np.repeat((self.first[both] - ends + size).astype(np.int32), size)
            place += np.arange(len(place), dtype=np.int32)
            ids.append(self.ids[place])
            begin.append(done + ends[1::2])
            done += len(place)
        return np.concatenate(ids), np.concatenate(begin)


_open: dict[str, WordIds] = {}  # one tokenizer per task process


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """A row per piece: ``doc_id``, ``piece``, ``start``, ``length`` and ``ids_crc32``."""

    def run(batch):
        known = _open.get(tokenizer) or _open.setdefault(tokenizer, WordIds(tokenizer))
        # Words between ASCII white space, of all texts one after the other; a null text has none.
        words = pc.ascii_split_whitespace(pc.fill_null(batch.column("text"), ""))
        ids, begin = known.encode(words.flatten())
        offsets = words.offsets.to_numpy()
        stop = begin[offsets[1:] - offsets[0]]  # where each text's ids end
        data = memoryview(np.insert(ids, stop, end_id)).cast("B")
        total = np.diff(stop, prepend=0) + 1
        pieces = -(-total // capacity)
        doc = np.repeat(np.arange(len(total)), pieces)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        length = np.minimum(capacity, total[doc] - piece * capacity)
        at = (4 * ((np.cumsum(total) - total)[doc] + piece * capacity)).tolist()
        crc = [zlib.crc32(data[x : x + 4 * n]) for x, n in zip(at, length.tolist())]
        return {"doc_id": batch.column("doc_id").take(pa.array(doc)), "piece": piece.astype(np.int32), "start": piece * capacity, "length": length, "ids_crc32": crc}

    return map_batches(texts(docs), run, "doc_id long, piece int, start long, length long, ids_crc32 long", TEXT_ROWS)


def plan(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first item, items, first sequence, offset) that place every item of every length."""
    left = dict(sorted(((k, n) for k, n in counts.items() if n), reverse=True))
    given = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of sequences (first, how many)
    free: list[int] = []
    sequences = 0

    def put(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, given[length], n, first, offset))
        given[length] += n
        left[length] -= n

    def leave(room: int, first: int, n: int) -> None:
        if room:
            if room not in gaps:
                gaps[room] = []
                insort(free, room)
            gaps[room].append((first, n))

    large = sorted(k for k in left if 3 * k > capacity)
    for length in reversed(large):
        while left[length]:
            fits = [k for k in large if k <= min(length, capacity - length) and left[k]]
            mate = fits[-1] if fits else None
            if mate == length and left[length] == 1:
                mate = fits[-2] if len(fits) > 1 else None
            n = left[length] if mate is None else left[length] // 2 if mate == length else min(left[length], left[mate])
            first, sequences = sequences, sequences + n
            put(length, n, first, 0)
            if mate is not None:
                put(mate, n, first, length)
            leave(capacity - length - (mate or 0), first, n)
    for length in [k for k in left if 3 * k <= capacity]:
        while left[length]:
            at = bisect_left(free, length)
            if at == len(free):
                each = capacity // length
                whole, rest = divmod(left[length], each)
                for n, per in ((whole, each), (1 if rest else 0, rest)):
                    if n:
                        for k in range(per):
                            put(length, n, sequences, k * length)
                        leave(capacity - per * length, sequences, n)
                        sequences += n
                continue
            room = free[at]
            first, n = gaps[room].pop()
            if not gaps[room]:
                del gaps[room]
                free.pop(at)
            used = min(n, left[length])
            put(length, used, first, capacity - room)
            leave(room - length, first, used)
            leave(room, first + used, n - used) if n > used else None
    return runs


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` of every piece."""
    rows = token_pieces(docs, tokenizer, capacity, end_id)
    pieces = cut(rows.withColumn("row", F.monotonically_increasing_id()), "token-pieces")  # stored, so a row keeps its number
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    hot = {length: -(-n // PIECE_ROWS) for length, n in counts.items() if n > PIECE_ROWS}
    split = F.lit(1)
    if hot:  # at most one entry per length
        split = F.coalesce(F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])[F.col("length").cast("int")], split)
    cell = F.pmod(F.xxhash64("row"), split.cast("long"))
    numbered = number_in_groups(pieces, ["length"], [F.col("row")], cell, "item")
    runs = sorted(plan(counts, capacity))
    keys = np.array([(length << 40) + first for length, first, *_ in runs], dtype=np.int64)
    first, sequence, offset = (np.array([r[k] for r in runs], dtype=np.int64) for k in (1, 3, 4))

    def run(batch):
        item = batch.column("item").to_numpy()
        at = np.searchsorted(keys, (batch.column("length").to_numpy() << 40) + item, side="right") - 1
        out = {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
        return out | {"sequence_id": sequence[at] + item - first[at], "offset": offset[at]}

    return map_batches(numbered, run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
