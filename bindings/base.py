"""Registry of queries on the test tables, each with the SQL an independent engine runs for the same result.

Input frames that imitate the operational tables are stated once as portable SQL (``FRAMES``) and read by both
sides, so that only the operator under test is written twice.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FRAMES: dict[str, str] = {}

AS_OF_EVENTS = "2024-01-31 00:00:00"
AS_OF_ORDERS = "2001-08-02 00:00:00"


class Inputs:
    """Tables and frames of one data folder, as attributes: ``i.orders``, ``i.entity``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._made = spark, folder, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self._load(name)
        return self._made[name]

    def _load(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        text = FRAMES[name]
        used = {n: getattr(self, n) for n in names_in(text)}
        text = text.replace("{", "{{").replace("}", "}}")
        for n in used:
            text = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", text)
        return self.spark.sql(text, **used)


def names_in(text: str) -> list[str]:
    known = set(TABLES) | set(FRAMES)
    found = re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)\b", text)
    return [n for n in dict.fromkeys(found) if n in known]


def with_frames(sql: str) -> str:
    """Put the definitions of all frames a statement reads in front of it."""
    order: list[str] = []

    def visit(text: str) -> None:
        for n in names_in(text):
            if n in FRAMES and n not in order:
                visit(FRAMES[n])
                order.append(n)

    visit(sql)
    if not order:
        return sql.strip()
    heads = ",\n".join(f"{n} AS ({FRAMES[n]})" for n in order)
    body = sql.strip()
    if re.match(r"WITH\s", body, re.I):
        return f"WITH {heads},\n{body[4:].strip()}"
    return f"WITH {heads}\n{body}"


def frame(name: str, sql: str) -> None:
    FRAMES[name] = re.sub(r"\s+", " ", sql).strip()


def query(name: str, sql: str | None = None):
    """Register ``fn(i: Inputs) -> DataFrame`` under ``name`` with its comparison SQL."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Inputs(spark, folder))
        if sql is not None:
            ORACLE[name] = with_frames(sql)
        return fn

    return add
