"""Reading tables and shaping their columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from crosswalk.functions.columns import moment


def read_table(spark: SparkSession, folder: str | None, name: str) -> DataFrame:
    """Scan one source table: ``<folder>/<name>.parquet``, or the catalog table ``name`` (up to three parts) when
    no folder is given. Filters and columns chosen later reach the scan."""
    return spark.table(name) if folder is None else spark.read.parquet(f"{folder}/{name}.parquet")


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make frames available to SQL under view names, so that queries can be stacked on one another."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def read_csv_clean(spark: SparkSession, path: str, schema: StructType, key: str, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Header CSV with a fixed schema; column names and key values trimmed, blank keys and copies dropped.

    Columns are found by their trimmed header, in any order; those that ``schema`` lacks are left out, and a missing one
    is an error. A further file whose header has another order is an error too.
    """
    head = {c.strip(): c for c in spark.read.csv(path, header=True).columns}
    wanted = {f.name.strip(): f.dataType for f in schema}
    lost = sorted(wanted.keys() - head.keys())
    if lost:
        raise ValueError(f"columns missing in {path}: {', '.join(lost)}")
    found = StructType([StructField(c, wanted.get(name, StringType())) for name, c in head.items()])
    raw = spark.read.csv(path, header=True, schema=found, enforceSchema=False)
    df = raw.select([F.col(f"`{head[c]}`").alias((rename or {}).get(c, c)) for c in wanted])
    return df.withColumn(key, F.trim(key)).filter(F.col(key) != "").distinct()


def lookback_increment(df: DataFrame, ts: str, hours: int, as_of: str, condition: Column | None = None, newest_first: bool = True) -> DataFrame:
    """S3: rows created in the last ``hours`` hours before ``as_of``, optionally with a condition, newest first.

    The time test is on the raw column and reaches the scan. Pass ``newest_first=False`` when a later step sorts or
    aggregates anyway; it saves a shuffle.
    """
    out = df.filter(F.col(ts) >= moment(as_of) - F.expr(f"INTERVAL {hours} HOURS"))
    out = out if condition is None else out.filter(condition)
    return out.orderBy(F.col(ts).desc()) if newest_first else out


def prefix_projection(df: DataFrame, prefix: str) -> DataFrame:
    """every column as ``<prefix>_<column>``, so that many sources can be joined without clashes."""
    return df.select([F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def rename_projection(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """keep the mapped columns under their business names."""
    return df.select([F.col(old).alias(new) for old, new in names.items()])
