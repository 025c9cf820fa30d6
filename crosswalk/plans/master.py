"""Manager master, master row per property, and the roll-up per manager."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosswalk.functions.columns import count_if
from crosswalk.functions.scale import latest_per_key


def name_key(column: Column) -> Column:
    return F.trim(F.lower(column))


def manager_master(properties: DataFrame, name: str, key: str, company: str, status: str, created: str, updated: str, partners: DataFrame) -> DataFrame:
    """One row per normalised manager name, with an id made from it, dates, counts and the channel.

    ``partners`` lists partner companies (first column); a manager with any such company is a partner.
    """
    partner = partners.select(F.col(partners.columns[0]).alias(company)).distinct().withColumn("_partner", F.lit(1))
    rows = properties.withColumn("name_key", name_key(F.col(name))).filter("name_key <> ''").join(partner, company, "left")
    out = rows.groupBy("name_key").agg(
        F.min(F.trim(name)).alias("name"), F.min(created).alias("created_at"), F.max(updated).alias("updated_at"), (count_if(F.col(status) == "ACTIVE") > 0).alias("is_active"),
        F.count_distinct(key).alias("property_count"), F.count_distinct(company).alias("company_count"), F.max("_partner").alias("_p"),
    )
    channel = F.when(F.col("_p") == 1, "Partner").otherwise("Direct")
    return out.withColumn("manager_id", F.sha2(F.col("name_key"), 256)).withColumn("channel", channel).drop("_p")


@dataclass(frozen=True)
class MasterWords:
    """What a master row says where a value is missing; ``partner_owner`` goes before the company's name."""

    partner_owner: str = "with partner "
    no_owner: str = "without owner"
    no_tier: str = "tier not set"
    no_account: str = "no account found"


def property_master(
    properties: DataFrame, companies: DataFrame, managers: DataFrame, integrations: DataFrame, features: DataFrame, checks: DataFrame,
    partners: DataFrame, accounts: DataFrame, key: str, company: str, manager_name: str, areas: DataFrame | None = None, configurations: DataFrame | None = None,
    account_columns: Sequence[str] = ("account_id", "csm", "segment"), external_ids: Sequence[str] = ("$.propertyId",), words: MasterWords = MasterWords(),
) -> DataFrame:
    """One master row per property from up to eleven inputs.

    Inputs with several rows per property (integrations, features, checks, areas) are reduced to one before they are
    joined; companies are an inner join, all others left joins. Expected columns:
    integrations (key, activated_at, details json, and config_id with ``configurations``), features (key, enabled_at), checks (key, inserted_at),
    managers from ``manager_master``, accounts from ``match.account_lookup`` (name_key and ``account_columns``, account_id, csm and segment among them),
    areas (key and any columns, which become ``area_<column>``, of several rows the first by all of them), configurations (config_id, name, kind):
    only those in use; the one of the property's integration gives ``outbound_kind``. ``external_ids`` are JSON paths into the details, the first that has a value counts.
    """
    started = latest_per_key(integrations.filter("activated_at IS NOT NULL"), [key], [F.col("activated_at").asc(), F.col("details").asc()])
    if configurations is not None:
        kinds = configurations.select("config_id", F.col("kind").alias("_outbound")).dropDuplicates(["config_id"])
        started = started.join(kinds, "config_id", "left")
    else:
        started = started.withColumn("_outbound", F.lit(None).cast("string"))
    started = started.select(key, F.col("activated_at").alias("_activated"), F.col("details").alias("_details"), "_outbound")
    enabled = features.groupBy(key).agg(F.min("enabled_at").alias("feature_enabled_at"))
    first_check = checks.groupBy(key).agg(F.min("inserted_at").alias("first_check_at"))
    sides = [started, enabled, first_check]
    if areas is not None:
        about = [c for c in areas.columns if c != key]
        one = latest_per_key(areas, [key], [F.col(c).asc_nulls_last() for c in about])
        sides.append(one.select(key, *[F.col(c).alias(f"area_{c}") for c in about]))
    partner = partners.select(F.col(partners.columns[0]).alias(company)).distinct().withColumn("_pc", F.lit(True))
    company_side = companies.select(F.col("id").alias(company), F.col("name").alias("company_name"))
    manager_side = managers.select("name_key", "manager_id", F.col("name").alias("manager_name"), F.col("channel").alias("manager_channel"))

    out = properties.join(company_side, company).withColumn("name_key", name_key(F.col(manager_name)))
    out = out.join(manager_side, "name_key", "left").drop("name_key")
    for side in sides:
        out = out.join(side, key, "left")
    out = out.join(partner, company, "left")
    for role, source in (("company", "company_name"), ("manager", "manager_name")):
        side = accounts.select(F.col("name_key").alias("_n"), *[F.col(c).alias(f"{role}_{c}") for c in account_columns])
        out = out.join(side, name_key(F.col(source)) == F.col("_n"), "left").drop("_n")
    is_partner, linked = F.coalesce("_pc", F.lit(False)), F.col("_activated").isNotNull()
    # A partner's properties are integrated from their first day; a feature's start is known from its first check, or else
    # assumed at the last change of a property that still runs and at the first of one that does not.
    assumed = F.when(F.col("status") == "ACTIVE", F.col("updated_at")).when(F.col("status") == "DISABLED", F.col("inserted_at"))
    tier_missing = F.when(F.col("company_account_id").isNull(), words.no_account).otherwise(words.no_tier)
    return out.withColumns({
        "display_name": F.coalesce("manager_name", "company_name"),
        "company_channel": F.when(is_partner, "Partner").otherwise("Direct"),
        "uses_integration": F.when(linked | is_partner, "yes").otherwise("no"),
        "integration_enabled_at": F.coalesce("_activated", F.when(is_partner, F.col("inserted_at"))),
        "outbound_kind": F.col("_outbound"),
        "inbound_kind": F.when(is_partner, F.col("company_name")),
        "external_id": F.coalesce(*[F.get_json_object("_details", path) for path in external_ids]),
        "feature_enabled": F.col("feature_enabled_at").isNotNull(),
        "deactivated_at": F.when(F.col("status") == "DISABLED", F.col("updated_at")),
        "check_enabled_at": F.coalesce("first_check_at", F.when(F.col("feature_enabled_at").isNotNull(), assumed)),
        "company_owner": F.coalesce("company_csm", F.when(is_partner, F.concat(F.lit(words.partner_owner), F.col("company_name"))), F.lit(words.no_owner)),
        "company_tier": F.coalesce("company_segment", tier_missing),
    }).drop("_activated", "_details", "_outbound", "_pc")


def manager_rollup(master: DataFrame, keys: Sequence[str], key: str, company: str, units: str, manager: str = "manager_name") -> DataFrame:
    """Properties, companies, active, with the feature, and units per manager."""
    return master.filter(F.col(manager).isNotNull()).groupBy(*keys).agg(
        F.count_distinct(key).alias("property_count"), F.count_distinct(company).alias("company_count"), count_if(F.col("status") == "ACTIVE").alias("active_properties"),
        count_if(F.col("feature_enabled")).alias("with_feature"), F.sum(units).alias("total_units"),
    )
