"""Wide star join, cleaned rows, business dimension, each tier a function over the one before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from crosswalk.functions.scale import distinct_rows
from crosswalk.operators.checks import expect, expectation_counts
from crosswalk.operators.reconcile import Edge, star_left_chain
from crosswalk.session import stored
from crosswalk.sources.tables import rename_projection


def bronze(root: DataFrame, edges: Sequence[Edge], columns: Sequence[str]) -> DataFrame:
    """The star join with only the columns later tiers read. Copies are dropped once, in gold, not here as well."""
    return star_left_chain(root, edges, columns, distinct=False)


def silver(rows: DataFrame, excluded: Column, drop: Mapping[str, Column]) -> DataFrame:
    """Rows not excluded that meet the drop rules."""
    return expect(rows.filter(~excluded), drop)


def gold(rows: DataFrame, names: Mapping[str, str], drop: Mapping[str, Column]) -> DataFrame:
    """Business names, copies dropped, drop rules applied before the copies are compared, which are stored for that unless ``rows`` are."""
    return distinct_rows(stored(rename_projection(expect(rows, drop), names), "gold"))


def quality_report(rows: DataFrame, warn: Mapping[str, Column], drop: Mapping[str, Column]) -> DataFrame:
    """Rule counts of a tier's input: what a warn rule found and what a drop rule removes."""
    return expectation_counts(rows, warn, drop)
