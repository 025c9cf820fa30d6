"""Tables that are changed by runs, so that a run can be repeated and a failed one changes nothing.

A run writes its rows to a folder of its own; nobody reads it until the pointer of the table names it. The pointer is a line of
JSON, written to two places in turn: while one is replaced, the other still holds the state before, and a reader takes the newer
one it can read. What a reader asks of the file system is the same two places however old the table is.

One writer at a time; any number of readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_pointer(spark: SparkSession, base: str) -> dict | None:
    """The newest state that was written whole, or None."""
    states = []
    for slot in (0, 1):
        try:
            lines = [r["value"] for r in spark.read.text(f"{base}/pointer-{slot}").collect()]
            states += [json.loads(line) for line in lines]
        except (AnalysisException, json.JSONDecodeError):  # not there yet, or being replaced
            continue
    return max(states, key=lambda s: s["number"], default=None)


def write_pointer(spark: SparkSession, base: str, state: dict) -> None:
    """``state["number"]`` must be one more than the number of the state before."""
    line = spark.createDataFrame([(json.dumps(state, sort_keys=True),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{base}/pointer-{state['number'] % 2}")


def remove_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    """Removes folders that no pointer names any more, on the file system that the session uses for them."""
    jvm = spark.sparkContext._jvm
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_runs(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """The rows of all runs that the table consists of; none before the first."""
    state = read_pointer(spark, base)
    folders = [f"{base}/{run['folder']}" for run in state["live"]] if state else []
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write_run(df: DataFrame, base: str, run_id: str | None = None, replace: bool = False) -> DataFrame:
    """Adds the rows of a run to the table, or puts them in place of all rows, and gives the whole table.

    A run id that the table has seen is not written again: repeating a run changes nothing, also after others. Without
    one each call is a run of its own. Rows of the state before stay on disk for readers that have begun; older ones go.
    """
    spark = df.sparkSession
    state = read_pointer(spark, base) or {"number": 0, "live": [], "before": [], "seen": []}
    if run_id is None or run_id not in state["seen"]:
        folder = f"rows-{uuid.uuid4().hex}"
        df.write.parquet(f"{base}/{folder}")
        run = {"run_id": run_id, "folder": folder}
        live = [run] if replace else [*state["live"], run]
        gone = [r["folder"] for r in state["before"] if r not in state["live"]]
        seen = state["seen"] + ([run_id] if run_id is not None else [])
        write_pointer(spark, base, {"number": state["number"] + 1, "live": live, "before": state["live"], "seen": seen})
        remove_folders(spark, [f"{base}/{f}" for f in gone])
    return read_runs(spark, base, df.schema)
