import pytest
from pyspark.sql import functions as F

from crosswalk.llm import common

ROWS, CHARS = 3_000, 20_000


@pytest.fixture
def long_texts(spark):
    before = spark.conf.get(common.BYTES_SETTING, None)
    spark.conf.unset(common.BYTES_SETTING)
    yield spark.range(ROWS, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), CHARS).alias("text"))
    spark.conf.set(common.BYTES_SETTING, before) if before else spark.conf.unset(common.BYTES_SETTING)


def measure():
    """A function that tells the rows and bytes of each batch and what Arrow holds in all; a closure, as tasks cannot import tests."""
    import pyarrow as pa

    def run(batch):
        n = batch.num_rows
        return {"n": [n] * n, "bytes": [batch.nbytes] * n, "held": [pa.total_allocated_bytes()] * n}

    return run


def test_batches_of_long_texts_are_bounded_by_bytes(long_texts):
    schema = "n long, bytes long, held long"
    for df in (common.map_batches(long_texts, measure(), schema), common.add_columns(long_texts, measure(), schema)):
        rows = df.select("n", "bytes", "held").collect()
        assert len(rows) == ROWS and {r.n for r in rows} != {ROWS}
        assert max(r.bytes for r in rows) <= common.BATCH_BYTES + 2 * CHARS
        assert max(r.held for r in rows) <= 8 * common.BATCH_BYTES


def test_a_limit_of_the_session_is_kept(spark, long_texts):
    spark.conf.set(common.BYTES_SETTING, "1m")
    rows = common.map_batches(long_texts, measure(), "n long, bytes long, held long").collect()
    assert len(rows) == ROWS and max(r.bytes for r in rows) <= (1 << 20) + 2 * CHARS
    assert spark.conf.get(common.BYTES_SETTING) == "1m"
