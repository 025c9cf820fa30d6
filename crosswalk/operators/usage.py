"""Names mentioned in texts, and columns found by keyword."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.functions.columns import count_if, moment, percent
from crosswalk.functions.scale import highest_per_key


def references(df: DataFrame, text: str, pattern: str, name: str = "name", group: int = 1) -> DataFrame:
    """One row per distinct name found in each text; ``pattern`` captures the name in one group.

    ``regexp_extract_all`` runs inside generated code over the whole text; there is no Python function.
    """
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(group)))
    return df.withColumn(name, F.explode(F.filter(found, lambda x: x != "")))


def reference_usage(rows: DataFrame, name: str, user: str, ts: str, read: Column, write: Column, days: int, as_of: str) -> DataFrame:
    """Per name: uses, users, reads, writes, first and last use, uses per day, read percent, days idle."""
    total = F.count(F.lit(1))
    out = rows.groupBy(name).agg(
        total.alias("total_uses"), F.count_distinct(user).alias("unique_users"), count_if(read).alias("read_uses"), count_if(write).alias("write_uses"),
        F.min(ts).alias("first_use"), F.max(ts).alias("last_use"),
    )
    return out.withColumns({
        "uses_per_day": F.round(F.col("total_uses").cast("double") / days, 2), "read_pct": percent(F.col("read_uses"), F.col("total_uses"), 1),
        "days_idle": F.datediff(moment(as_of).cast("date"), F.col("last_use").cast("date")),
    })


def column_keyword_search(tables: Mapping[str, DataFrame], keywords: Mapping[str, Sequence[str]]) -> list[tuple[str, str, str]]:
    """(feature, table, column) for every column whose name holds one of the feature's words. Reads schemas only."""
    return [
        (feature, table, column)
        for feature, words in keywords.items()
        for table, df in tables.items()
        for column in df.columns
        if any(w.lower() in column.lower() for w in words)
    ]


def top_values(tables: Mapping[str, DataFrame], found: Sequence[tuple[str, str, str]], n: int | None = None) -> DataFrame:
    """The values of each found column with their rows, all or the most frequent ones. A table is read once, however many
    of its columns were found."""
    parts = []
    for table in dict.fromkeys(t for _, t, _ in found):
        columns = [(feature, column) for feature, t, column in found if t == table]
        each = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for f, c in columns])
        counts = tables[table].select(F.inline(each)).groupBy("feature", "column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))
        top = highest_per_key(counts, ["feature", "column_name"], [F.desc("row_count"), F.asc("value")], n)
        parts.append(top.select("feature", F.lit(table).alias("table_name"), "column_name", "value", "row_count"))
    return reduce(lambda a, b: a.unionByName(b), parts)
