"""What the operators on vectors share: usable rows, cells of rows, and matrices of exact whole numbers.

Work on pairs of rows is dealt out in cells. A tile of the asking rows meets a tile of the other rows; both tiles have a
bound, and a row's tile follows from a hash of the row, so a repeated task finds the same rows. Only rows move, once per
tile that they meet; no pair of rows is ever a row of a table before it is one of the best.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, FloatType, StructType

EXACT = float(1 << 53)  # whole numbers up to this size are exact in double precision


def usable(vector: str) -> Column:
    """The vector and all of its components are there and finite."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def vector_rows(rows: DataFrame, vector: str, *more: Column) -> DataFrame:
    """``vec_id``, ``v`` (floats stay floats, all else becomes double) and ``more``, of rows with a usable vector."""
    kind = rows.schema[vector].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    v = F.col(vector).cast("array<float>" if single else "array<double>").alias("v")
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v, *more).filter(usable("v"))


def tile(total: int, most: int, *by: str) -> Column:
    """The number of a row's tile, out of as many as hold ``most`` rows each on average."""
    return F.pmod(F.xxhash64(*by), F.lit(tiles(total, most))).cast("int")


def tiles(total: int, most: int) -> int:
    return max(1, -(-total // most))


def on_cells(asking: DataFrame, others: DataFrame, keys: list[str], fn: Callable[[pa.Table, pa.Table], dict], schema: str) -> DataFrame:
    """``fn`` on the two tiles of each cell, as Arrow tables; it returns columns of ``schema``."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = fn(left, right) if left.num_rows and right.num_rows else {f.name: [] for f in arrow}
        return pa.table([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return asking.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInArrow(run, schema)


def column(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    found = table.column(name)
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of doubles; shorter vectors are filled up with zeros. With ``width``, that many components of each."""
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lists), int(size.max(initial=0)) if width is None else width))
    row = np.repeat(np.arange(len(lists)), size)
    place = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
    inside = place < out.shape[1]
    out[row[inside], place[inside]] = values[inside]
    return out


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component: 64-bit integers, or Python's where a component needs more than 53 bits."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if np.abs(scaled).max(initial=0) < EXACT:
        return scaled.astype(np.int64)
    flat = [math.floor(Fraction(x) * scale) for x in values.ravel().tolist()]
    return np.array(flat + [None], dtype=object)[:-1].reshape(values.shape)


def to_long(value: int) -> int:
    """Held within 64 bits."""
    return max(-(1 << 63), min((1 << 63) - 1, int(value)))
