"""What several operators share: Arrow batches, bounded samples, numbering in groups, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from crosswalk.session import cut

BATCH_ROWS = 2_000  # rows of whole texts that one Python batch holds at most
BATCH_BYTES = 3 << 20  # bytes of rows that Spark hands to Python at once, about
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long and ``text`` as string, with the named further columns; all others are left out, so that
    columns with clashing names cannot reach an operator."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` in batches of about ``BATCH_BYTES``, or one row, however long the rows are.

    Spark holds a batch several times outside its heap, and the Python process once more, so by rows alone long texts would fill an
    executor. The limit is set for the session, where it has none of its own. Python processes live on from stage to stage; what
    Arrow still holds goes back to the system when a task ends.
    """
    conf = df.sparkSession.conf
    if conf.get(BYTES_SETTING, None) is None:
        conf.set(BYTES_SETTING, str(BATCH_BYTES))

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(released, schema)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` for functions from one batch to a dict of columns (lists or arrays) in ``schema``'s types.

    Large batches are handed over in pieces of ``rows`` rows, so memory follows one piece.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                out = fn(batch.slice(start, rows))
                columns = [as_arrow(out[f.name], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return in_arrow(df, run, schema)


def keep_columns(docs: DataFrame, keep: Sequence[str]) -> list[str]:
    """The columns of ``docs`` named in ``keep``, beside the two that ``texts`` selects itself."""
    return [c for c in docs.columns if c in keep and c not in ("doc_id", "text")]


def add_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``map_batches`` that hands every column of ``df`` on; a new column replaces one of the same name."""
    new = StructType.fromDDL(schema)
    old = StructType([f for f in df.schema.fields if f.name not in new.names])
    arrow = to_arrow_schema(StructType(old.fields + new.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                piece = batch.slice(start, BATCH_ROWS)
                out = fn(piece)
                columns = [as_arrow(out[f.name], f.type) if f.name in out else piece.column(f.name).cast(f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return in_arrow(df, run, StructType(old.fields + new.fields))


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


def sample_ids(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``doc_id`` and ``label`` of at most ``per_class`` labelled rows of each of the classes 0 and 1.

    The rows with the smallest hash of the id are taken, so the choice does not depend on the order of rows. A document
    labelled more than once counts as 1 if any of its labels is 1.
    """
    one = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias(label))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max(label).alias(label))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [one.filter(F.col(label) == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    return parts[0].unionByName(parts[1])


def sample_texts(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """One text per sampled document. ``ids`` has a bound on its rows (see ``sample_ids``) and is broadcast.

    The rows are dealt out again, so that each task of the work on the sample gets a share of it.
    """
    found = texts(docs).join(F.broadcast(ids), "doc_id")
    rest = [c for c in ids.columns if c != "doc_id"]
    one = found.groupBy("doc_id").agg(F.min("text").alias("text"), *[F.first(c).alias(c) for c in rest])
    return cut(one.filter(F.col("text").isNotNull()), name)


def number_in_groups(df: DataFrame, group: Sequence[str], order: Sequence[Column], cell: Column, number: str) -> DataFrame:
    """Gapless numbers from 0 within each group, however large a group is.

    ``cell`` cuts a group into pieces; only a piece is sorted in one task. The pieces' sizes, summed up within the
    group, give the number at which each piece starts. ``df`` is read twice and should be a narrow stored table.
    """
    cells = df.withColumn("_cell", cell)
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cells.groupBy(*group, "_cell")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    place = F.row_number().over(Window.partitionBy(*group, "_cell").orderBy(*order))
    joined = cells.withColumn("_place", place).join(starts, [*group, "_cell"])
    return joined.withColumn(number, (F.col("_start") + F.col("_place") - 1).cast("long")).drop("_cell", "_place", "_start")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(``node``, ``root``) for every node of the undirected ``edges`` (``a``, ``b``); ``root`` is the smallest node
    of the connected component.

    Alternates large-star and small-star steps: each links neighbours to the smallest neighbour, until only stars
    are left; the rounds grow with the logarithm of the longest path. Each round is written to the shared folder,
    so lost executors cost at most one round. Nothing but two figures per round reaches the driver.
    """
    stars = cut(edges.filter("a <> b").distinct(), name)
    state = fingerprint_of(stars)
    while state[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # In large every edge points from the larger node a to the smaller b.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        stars = cut(small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).filter("a <> b").distinct(), name)
        previous, state = state, fingerprint_of(stars)
        if previous == state:
            break
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots)


def fingerprint_of(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and an order-free sum that changes when any edge does."""
    mixed = F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(mixed), F.lit(0)).alias("s")).first()
    return row["n"], row["s"]


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8: what splitting bytes at ASCII white space gives."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60.0, 60.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float, steps: int) -> np.ndarray:
    """Weights (the last is the intercept) of a class-balanced logistic regression by accelerated gradient steps.

    With only one class in ``y`` the model is the constant probability 0.001 or 0.999 of that class.
    """
    n, d = x.shape
    w = np.zeros(d + 1)
    share = float(y.mean()) if n else 0.0
    if share in (0.0, 1.0):
        w[-1] = 6.9 if share else -6.9
        return w
    x1 = np.hstack([x, np.ones((n, 1))])
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / n
    v = np.ones(d + 1)
    for _ in range(20):  # largest curvature by power iteration
        v = x1.T @ (weight * (x1 @ v))
        size = np.linalg.norm(v)
        v /= size
    step = 1.0 / (0.25 * size * 1.05 + l2)
    penalty = np.full(d + 1, l2)
    penalty[-1] = 0.0
    look = w.copy()
    t = 1.0
    for _ in range(steps):
        grad = x1.T @ (weight * (sigmoid(x1 @ look) - y)) + penalty * look
        new = look - step * grad
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w
