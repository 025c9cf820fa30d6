"""The two-system sync as one stack: enriched entities, one row per sync key, create, update and mismatch sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.operators import reconcile as R
from crosswalk.operators.filters import valid_records
from crosswalk.session import cut
from crosswalk.sources.sinks import materialise


@dataclass
class SyncSpec:
    """Column names and constants of one sync; nothing here is fixed by the library."""

    id: str = "id"
    key: str = "sync_key"
    parent: str = "parent_id"
    status: str = "status"
    updated: str = "updated_at"
    feature_key: str = "entity_id"
    flags: Mapping[str, str | None] = field(default_factory=dict)
    metadata: Sequence[str] = ()
    target_key: str = "sync_key"
    target_id: str = "target_id"
    target_modified: str = "last_modified"
    deleted: str = "is_deleted"
    sentinels: Sequence[str] = ()


def enriched(entities: DataFrame, features: DataFrame, parents: DataFrame, spec: SyncSpec, order: Sequence[Column]) -> DataFrame:
    """Valid entities with their newest features and the name of a parent that is not deleted."""
    base = valid_records(entities, spec.parent, spec.status, spec.key, sentinels=spec.sentinels)
    times = [at for at in spec.flags.values() if at]
    return R.enrich_latest(
        base, features, spec.id, spec.feature_key, order, list(spec.flags), times,
        parents.filter(~F.col("is_deleted")), (spec.parent, "id"), {"name": "company_name"},
    )


def aggregated(rows: DataFrame, spec: SyncSpec) -> DataFrame:
    """One row per sync key from active entities with a valid key."""
    active = rows.filter(F.col("is_active") & F.col("has_valid_key"))
    return R.aggregate_many_to_one(active, spec.key, spec.id, spec.flags, spec.updated, [*spec.metadata, "company_name"])


def to_create(agg: DataFrame, target: DataFrame, spec: SyncSpec) -> DataFrame:
    return R.create_queue(agg, target, spec.key, spec.target_key, F.col(spec.deleted))


def to_update(agg: DataFrame, target: DataFrame, spec: SyncSpec) -> DataFrame:
    order = [F.col(spec.target_modified).desc_nulls_last(), F.col(spec.target_id).asc()]
    return R.update_queue(agg, target, spec.key, spec.target_key, F.col(spec.deleted), order, [spec.target_id])


@dataclass
class SyncTables:
    """The levels of one run, each written once and read by queues, health, audit and quality checks."""

    enriched: DataFrame
    aggregated: DataFrame
    creates: DataFrame
    updates: DataFrame


def run(
    entities: DataFrame, features: DataFrame, parents: DataFrame, target: DataFrame, spec: SyncSpec, order: Sequence[Column], out_dir: str | None = None,
    run_id: str | None = None,
) -> SyncTables:
    """All levels of the sync, each written once: as tables under ``out_dir``, which a repeated ``run_id`` leaves as they are,
    or in fresh folders of the shared scratch space."""
    def written(df: DataFrame, name: str) -> DataFrame:
        return materialise(df, f"{out_dir}/{name}", run_id=run_id) if out_dir else cut(df, name)

    rows = written(enriched(entities, features, parents, spec, order), "enriched")
    agg = written(aggregated(rows, spec), "aggregated")
    return SyncTables(rows, agg, written(to_create(agg, target, spec), "creates"), written(to_update(agg, target, spec), "updates"))


def to_fix(agg: DataFrame, target: DataFrame, spec: SyncSpec, pairs: Mapping[str, str]) -> DataFrame:
    """Live target rows whose flags differ from the source."""
    live = target.filter(~F.col(spec.deleted))
    return R.flag_mismatch(agg, live, spec.key, spec.target_key, pairs)
