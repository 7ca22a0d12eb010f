"""Staging: stable types, surrogate key, unusable rows dropped."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden import schemas
from tidewarden.config import HYPERSCALERS
from tidewarden.functions.keys import surrogate_key

USABLE = ("incident_id", "incident_ts", "severity")


def stage_incidents(classified: DataFrame) -> DataFrame:
    """Cast every column, add `incident_sk`, drop rows without id, time or tier."""
    typed = [
        F.col(f.name) if f.name == "affected_systems" else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in schemas.CLASSIFIED.fields
    ]
    rows = classified.select(*typed)
    # One predicate per column, unlike dropna, reaches the Parquet scan and the tier partitions.
    for name in USABLE:
        rows = rows.filter(F.col(name).isNotNull())
    return rows.withColumn("incident_sk", surrogate_key(F.col("incident_id")))


def stage_vendors(vendors: DataFrame, hyperscalers: tuple[str, ...] = HYPERSCALERS) -> DataFrame:
    """Trim the texts, cast the flags, mark hyperscalers by name."""
    name = F.trim(F.col("vendor_name"))
    return vendors.select(
        name.alias("vendor_name"),
        F.trim(F.col("vendor_type")).alias("vendor_type"),
        F.col("eu_headquartered").cast("boolean").alias("eu_headquartered"),
        F.col("designated_critical").cast("boolean").alias("designated_critical"),
        F.col("concentration_risk_score").cast("int").alias("concentration_risk_score"),
        F.coalesce(name.isin(*hyperscalers), F.lit(False)).alias("is_hyperscaler"),
    )


def orphan_providers(staged: DataFrame, vendors: DataFrame) -> DataFrame:
    """Providers that no vendor row names, with their number of incidents.

    Incidents are counted per provider before the join, so neither side has a hot key.
    """
    used = (
        staged.filter(F.col("ict_third_party_provider").isNotNull())
        .groupBy("ict_third_party_provider")
        .agg(F.count(F.lit(1)).alias("incidents"))
    )
    names = vendors.select(F.col("vendor_name").alias("ict_third_party_provider")).distinct()
    return used.join(names, "ict_third_party_provider", "left_anti")
