"""Entity resolution from raw rows of two systems to the links to send."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosswalk.operators import match as M
from crosswalk.session import cut


def matches(source: DataFrame, target: DataFrame, s: M.SiteColumns, t: M.SiteColumns, ref: str, override: str, deleted: str, skip_marker: str | None = None) -> DataFrame:
    """Both tiers: by stored id, then by address for rows without one. Written once, as every later step reads it."""
    direct = M.match_direct(source, target, s, t, ref, override, deleted, skip_marker)
    return cut(direct.unionByName(M.match_address(source, target, s, t, ref, override, deleted, skip_marker)), "matches")


def labelled(found: DataFrame, source: DataFrame, s: M.SiteColumns, partner_ids: DataFrame, skip_names: Sequence[str] = ()) -> DataFrame:
    """Duplicate labels, with the exception for addresses of matched partner rows (``partner_ids``: source ids)."""
    marked = M.label_duplicates(found)
    rows = source.select(F.col(s.id).alias("source_id"), F.col(s.name).alias("_name"))
    if skip_names:
        rows = rows.filter(~F.col("_name").isin(*skip_names))
    partners = rows.join(partner_ids.select(F.col(partner_ids.columns[0]).alias("source_id")).distinct(), "source_id", "left_semi")
    addresses = found.join(partners.select("source_id"), "source_id", "left_semi").select(F.col("src_addr").alias("addr"))
    return cut(M.duplicate_exceptions(marked, addresses.filter(F.col("addr").isNotNull())), "labelled")


def open_duplicates(marked: DataFrame) -> DataFrame:
    """Duplicates that nobody has overridden, for review."""
    return marked.filter((F.col("final_status") != M.NO_DUPE) & ~F.col("final_status").startswith(M.OVERRIDDEN))


def status_summary(marked: DataFrame) -> DataFrame:
    """Match rows and the pairs they stand for, per final label and tier."""
    return marked.groupBy("final_status", "match_method").agg(F.sum("target_copies").alias("pairs"))
