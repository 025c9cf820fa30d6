"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: one time zone, and a plan that adapts at run time (small shuffle partitions are
# merged, skewed join partitions are split). ``sized_settings`` adds the ones that follow from data and cluster size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join without sorting where every partition of the smaller side turns out to fit this size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def sized_settings(input_bytes: int, cores: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` on ``cores`` executor cores.

    Shuffle partitions are sized so that one fits a task's memory, and there are at least three per core; AQE merges
    them where less data arrives. Scan splits follow the same size, smaller when that would leave cores idle.
    """
    partitions = max(3 * cores, -(-input_bytes // partition_bytes))
    split = max(8 * 1024 * 1024, min(partition_bytes, input_bytes // max(1, 3 * cores)))
    return {
        **SETTINGS, "spark.sql.shuffle.partitions": str(partitions), "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
    }


def local_session(cores: str = "8", shuffle_partitions: str = "8", **extra: str) -> SparkSession:
    """A session for tests and the bench; a cluster job passes its own session to the operators instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("crosswalk")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables that later jobs read back.

    Uses the shared folder named in ``spark.checkpoint.dir`` (or set as the context's checkpoint folder). Where
    neither is set, a machine-local folder is only right when every task runs on this machine, so anything but a
    local master is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="crosswalk-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later steps read, and go on from the files.

    The table lies in the shared scratch folder, so losing executors does not lose it, and the plans of the later
    steps start at a scan instead of repeating everything before it.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_in_turn(parts: Sequence[DataFrame], name: str) -> DataFrame:
    """Write tables of the same columns one after the other, and go on from the files of all.

    The shuffle files of a table go when it is written, so the disk holds those of one table at a time.
    """
    spark, clean = parts[0].sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = scratch_dir(spark, name), spark.conf.get(clean, "false")
    spark.conf.set(clean, "true")
    try:
        for i, df in enumerate(parts):
            df.write.option("compression", "zstd").parquet(f"{path}/{i}")
    finally:
        spark.conf.set(clean, before)
    return spark.read.schema(parts[0].schema).parquet(*[f"{path}/{i}" for i in range(len(parts))])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as it is where it only reads, filters and projects Parquet files, so that reading it again is no more than a scan; else ``cut``."""
    plan = df._jdf.queryExecution().optimizedPlan()
    lines = re.findall(r"^[\s:+-]*(\w+)(.*)$", plan.toString(), re.M)
    plain = all(node in ("Project", "Filter", "Union") or (node == "Relation" and rest.endswith(" parquet")) for node, rest in lines)
    return df if plain and plan.deterministic() and "subquery" not in plan.toString() else cut(df, name)
