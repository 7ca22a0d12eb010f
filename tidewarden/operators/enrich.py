"""Vendor attributes and severity label for a classified event."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.config import ENRICHED_HYPERSCALERS, SEVERITY_LABELS, UNKNOWN_LABEL
from tidewarden.operators.lookup import BROADCAST_BYTES, left_lookup

EDGE_SPACE = r"(?U)^\s+|\s+$"


def severity_label(tier):
    name = F.lower(F.regexp_replace(tier, EDGE_SPACE, ""))
    label = F.lit(UNKNOWN_LABEL)
    for known, text in SEVERITY_LABELS.items():
        label = F.when(name == known, F.lit(text)).otherwise(label)
    return label


def enrich(
    df: DataFrame,
    vendors: DataFrame,
    hyperscalers: tuple[str, ...] = ENRICHED_HYPERSCALERS,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add `severity_label`, `vendor_known` and the vendor's attributes, null when it is unknown.

    The provider is trimmed before the lookup and an empty one counts as unset. `vendors` has one
    row per name, as `load_vendors` gives it.
    """
    known = vendors.select(
        F.col("vendor_name").alias("lookup_name"),
        F.col("vendor_type"),
        F.col("eu_headquartered").alias("vendor_eu_headquartered"),
        F.col("designated_critical").alias("vendor_designated_critical"),
        F.col("concentration_risk_score").alias("vendor_concentration_risk_score"),
        F.col("vendor_name").isin(*hyperscalers).alias("vendor_is_hyperscaler"),
        F.lit(True).alias("vendor_found"),
    )
    provider = F.regexp_replace("ict_third_party_provider", EDGE_SPACE, "")
    named = df.withColumns(
        {
            "severity_label": severity_label(F.col("severity")),
            "provider_name": F.when(provider != "", provider),
        }
    )
    return (
        left_lookup(named, known, "provider_name", "lookup_name", limit)
        .withColumn("vendor_known", F.coalesce("vendor_found", F.lit(False)))
        .drop("provider_name", "vendor_found")
    )
