"""Vector code compression with an integer Walsh-Hadamard transform (operator 12).

Components become whole numbers, vectors are cut into equal parts, and each part gets the index of the nearest entry of its
position's codebook. Parts and entries are filled up with zeros to a power of two and transformed; rows of the
transform are in sequency order (by number of sign changes), so smooth parts have their differences in the first places. A
squared difference of transforms is the squared distance times their length, a fixed scale, so distances are added
up place by place on whole numbers alone: an entry whose sum so far is above the full distance of one entry can't be
nearest and goes; the rest moves together. Sums are 64-bit, or Python's integers where a bound on them needs more.

Codebooks are trained on all rows: each round is a scan in which a task adds up its parts per entry, and a sum of those
per entry. Only the codebooks, whose size does not depend on the rows, reach the driver and go out with the tasks.

Defined results: rows whose vector is null or holds null, NaN or infinite components are dropped; a null id or label is a
value like any other. Vectors are filled up with zeros to the longest one's length, and that to a multiple of the
number of parts. The first entries are those of the rows with the smallest ids, rows of one id by label and vector, null ids
last; with fewer rows than entries the codebooks are smaller. Equal rows are coded alike, one result row each. Scaled components
beyond 62 bits are held within them, errors beyond 64 bits likewise. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosswalk.llm.common import BATCH_ROWS, map_batches
from crosswalk.llm.vectors import column, matrix, to_long, vector_rows, whole
from crosswalk.session import cut

ENTRIES = 256  # entries of a codebook at most; a code is two hexadecimal digits
PLACES = 2  # places of the transform that are added up between two eliminations
SAFE = 1 << 62  # sums of squares up to this size stay in 64 bits
LARGEST = 1 << 62  # components are held within this


def walsh(size: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, rows in sequency order."""
    h = np.ones((1, 1), dtype=np.int64)
    while len(h) < size:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")]


def transformed(parts: np.ndarray) -> np.ndarray:
    """(places, rows): transforms of parts filled up with zeros to a power of two, in 64 bits or in Python's integers."""
    size = 1
    while size < parts.shape[1]:
        size *= 2
    largest = int(np.abs(parts).max(initial=0)) if len(parts) else 0
    kind = np.int64 if 4 * largest * largest * size * size * size < SAFE else object
    out = np.zeros((size, len(parts)), dtype=kind)
    for place, signs in enumerate(walsh(size)):
        for sign, values in zip(signs.tolist(), parts.astype(kind).T):
            out[place] += sign * values
    return out


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part the index of its nearest entry, ties to the lower one, and the squared distance."""
    both = transformed(np.concatenate([parts, entries]))
    x, e = both[:, : len(parts)], both[:, len(parts) :]
    places, n = x.shape
    m = e.shape[1]
    known = np.zeros((n, m), dtype=x.dtype)
    for p in range(min(PLACES, places)):
        known += (x[p][:, None] - e[p]) ** 2
    # The entry that leads so far: its full distance bounds the nearest one's.
    lead = known.argmin(axis=1)
    bound = ((x - e[:, lead]) ** 2).sum(axis=0)
    row, entry = np.nonzero(known <= bound[:, None])
    total = known[row, entry]
    for start in range(PLACES, places, PLACES):
        for p in range(start, min(start + PLACES, places)):
            total = total + (x[p, row] - e[p, entry]) ** 2
        alive = np.asarray(total <= bound[row], dtype=bool)
        row, entry, total = row[alive], entry[alive], total[alive]
    # Rows come in order, entries in order within a row, so the first of the smallest is the lower index.
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, dtype=np.int64)
    least = np.minimum.reduceat(total, first) if len(first) else total
    at_least = np.flatnonzero(np.asarray(total == np.repeat(least, np.diff(np.r_[first, len(row)])), dtype=bool))
    index = np.full(n, m, dtype=np.int64)
    np.minimum.at(index, row[at_least], entry[at_least])
    return index, least // places


def held(values: np.ndarray) -> np.ndarray:
    return np.clip(values, -LARGEST, LARGEST) if values.dtype == object else values


def cut_parts(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(vectors, parts, axis=1)


class Codes:
    """Codebooks: one array (entries, length of a part) of whole numbers for each part."""

    def __init__(self, books: list[np.ndarray], width: int, scale: int):
        self.books, self.width, self.scale = books, width, scale

    def listed(self) -> str:
        return ",".join(str(int(x)) for book in self.books for x in book.ravel())

    def vectors(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        values = whole(matrix(column(batch, "v"), self.width), self.scale)
        return cut_parts(held(values), len(self.books))


def fit(rows: DataFrame, vector: str = "embedding", parts: int = 4, entries: int = ENTRIES, rounds: int = 4, scale: int = 1024) -> Codes:
    """Codebooks after ``rounds`` rounds over all usable rows."""
    given = vector_rows(rows, vector, F.col("label"))
    longest = given.agg(F.max(F.size("v")).alias("n")).first()["n"] or 0
    width = -(-longest // parts) * parts
    head = given.orderBy(F.col("vec_id").asc_nulls_last(), "label", "v").limit(entries).select("v").collect()
    lists = pa.array([r["v"] for r in head], type=pa.list_(pa.float64()))
    codes = Codes(cut_parts(held(whole(matrix(lists, width), scale)), parts), width, scale)
    for _ in range(rounds if head else 0):
        sums = entry_sums(given, codes).groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(width // parts)])
        books = [book.astype(object) for book in codes.books]
        for r in sums.collect():  # a row per part and entry at most
            books[r["part"]][r["entry"]] = [int(s) // r["n"] for s in r[3:]]
        codes = Codes([narrow(book) for book in books], width, scale)
    return codes


def narrow(book: np.ndarray) -> np.ndarray:
    return book.astype(np.int64) if all(abs(x) < 1 << 53 for x in book.ravel()) else book


def entry_sums(given: DataFrame, codes: Codes) -> DataFrame:
    """(``part``, ``entry``, ``n``, ``total``): the sum of each batch's parts per entry."""

    def run(batch: pa.RecordBatch) -> dict:
        out = {"part": [], "entry": [], "n": [], "total": []}
        for p, (values, book) in enumerate(zip(codes.vectors(batch), codes.books)):
            index, _ = nearest(values, book)
            order = np.argsort(index, kind="stable")
            used, first, count = np.unique(index[order], return_index=True, return_counts=True)
            totals = np.add.reduceat(values[order].astype(object if values.dtype == object else np.int64), first, axis=0) if len(used) else []
            out["part"] += [p] * len(used)
            out["entry"] += used.tolist()
            out["n"] += count.tolist()
            out["total"] += [[Decimal(int(x)) for x in t] for t in totals]
        return out

    return map_batches(given.select("v"), run, "part int, entry int, n long, total array<decimal(38,0)>", BATCH_ROWS)


def encode(rows: DataFrame, codes: Codes, vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hexadecimal digits for each part, in order) and ``error``."""
    given = vector_rows(rows, vector, F.col("label"))
    kind = given.schema["label"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        error = np.zeros(n, dtype=object)
        digits = np.zeros((n, len(codes.books)), dtype=np.uint8)
        for p, (values, book) in enumerate(zip(codes.vectors(batch), codes.books)):
            index, distance = nearest(values, book)
            digits[:, p] = index
            error += distance
        return {
            "vec_id": column(batch, "vec_id"), "label": column(batch, "label"),
            "code": [row.tobytes().hex() for row in digits], "error": [to_long(x) for x in error],
        }

    return map_batches(given, run, f"vec_id long, label {kind}, code string, error long", BATCH_ROWS)


def compress(rows: DataFrame, vector: str = "embedding", parts: int = 4, entries: int = ENTRIES, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` (errors of all rows with this label, null being one) and
    ``codebooks_sha256`` (of all entries' components, by part, entry and position, joined by commas).

    Codes and errors are stored once, so vectors are read no further time for the sums per label.
    """
    codes = fit(rows, vector, parts, entries, rounds, scale)
    coded = cut(encode(rows, codes, vector), "vector-codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"))
    total = F.least(F.col("_sum"), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")
    found = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    digest = hashlib.sha256(codes.listed().encode()).hexdigest()
    return found.select("vec_id", "code", "error", total.alias("label_error"), F.lit(digest).alias("codebooks_sha256"))
