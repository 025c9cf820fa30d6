"""An inventory of tables measured by Spark: rows and last times from the tables, bytes and files from storage."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_stats(tables: Mapping[tuple[str, str], tuple[DataFrame, str | None]]) -> DataFrame:
    """Row count and last time of each table, one aggregate per table. Keys are (catalog, table name)."""
    parts = []
    for (catalog, name), (df, ts) in tables.items():
        last = F.max(ts) if ts else F.lit(None).cast("timestamp_ntz")
        one = df.agg(F.count(F.lit(1)).alias("row_count"), last.alias("last_run"))
        parts.append(one.select(F.lit(catalog).alias("catalog"), F.lit(name).alias("table_name"), "row_count", "last_run"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def storage_stats(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """``table_name``, ``files``, ``bytes``, ``smallest``, ``largest`` and ``last_written`` of each table under ``root``.

    A table is what lies directly under ``root``: a folder with all files in it, or a single file; its name is without a file
    ending. Files are listed by tasks once there are many folders, and summed up by tasks; their contents are not read.
    Hidden files (names that start with ``_`` or ``.``) do not count; a file without rows does.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    inside = F.substr(F.regexp_replace("path", "^[^/]+:(//[^/]*)?", ""), F.lit(len(urlsplit(root).path.rstrip("/")) + 2))
    name = F.regexp_replace(F.substring_index(inside, "/", 1), r"\.[A-Za-z]+$", "")
    return files.groupBy(name.alias("table_name")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.min("length").alias("smallest"), F.max("length").alias("largest"),
        F.max("modificationTime").alias("last_written"),
    )
