"""The three marts and the alerts drawn from them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.config import (
    AT_RISK_FROM_PCT,
    COMPLIANT_FROM_PCT,
    HIGH_EXPOSURE_FROM,
    LOOKBACK_DAYS,
    MEDIUM_EXPOSURE_FROM,
)
from tidewarden.functions.numbers import mean_2dp, percent_2dp


def regulatory_report(derived: DataFrame) -> DataFrame:
    """One row per month and institution: counts, mean containment time, deadline compliance."""
    tier = F.col("severity")
    totals = derived.groupBy("reporting_period", "institution_id", "institution_type").agg(
        F.count(F.lit(1)).alias("incident_count_total"),
        F.count_if(tier == "critical").alias("incident_count_critical"),
        F.count_if(tier == "major").alias("incident_count_major"),
        F.count_if(tier == "minor").alias("incident_count_minor"),
        F.count_if(F.col("notify_required")).alias("incidents_reported"),
        mean_2dp(F.col("containment_hours"), unit_digits=2).alias("avg_time_to_contain_hours"),
        F.count_if(F.col("is_within_deadline")).alias("within_deadline"),
    )
    return with_compliance(totals)


def with_compliance(totals: DataFrame) -> DataFrame:
    """Rate and status of each row from `within_deadline`, which is dropped, and `incidents_reported`."""
    rate = F.col("compliance_rate_pct")
    # The status is read off the rounded rate; a month with nothing to report is compliant.
    status = (
        F.when(rate.isNull() | (rate >= COMPLIANT_FROM_PCT), "COMPLIANT")
        .when(rate >= AT_RISK_FROM_PCT, "AT_RISK")
        .otherwise("NON_COMPLIANT")
    )
    return (
        totals.withColumn(
            "compliance_rate_pct", percent_2dp(F.col("within_deadline"), F.col("incidents_reported"))
        )
        .withColumn("compliance_status", status)
        .drop("within_deadline")
    )


def compliance_alerts(report: DataFrame) -> DataFrame:
    return report.filter(F.col("compliance_status") == "NON_COMPLIANT").select(
        "reporting_period", "institution_id", "compliance_rate_pct"
    )


def vendor_risk(derived: DataFrame, as_of: Column) -> DataFrame:
    """One row per provider: recent volume, mean impact, exposed institutions, concentration tier."""
    since = F.date_sub(F.to_date(as_of), LOOKBACK_DAYS).cast("timestamp")
    by_provider = (
        derived.filter(F.col("ict_third_party_provider").isNotNull())
        .groupBy("ict_third_party_provider", "vendor_type", "eu_headquartered", "designated_critical")
        .agg(
            F.count_if(F.col("incident_ts") >= since).alias("incident_count_last_90d"),
            mean_2dp(F.col("financial_impact_eur")).alias("avg_financial_impact_eur"),
            F.countDistinct("institution_id").alias("institutions_exposed"),
        )
    )
    return with_concentration(by_provider)


def with_concentration(by_provider: DataFrame) -> DataFrame:
    """The concentration tier of each provider."""
    exposed = F.col("institutions_exposed")
    tier = (
        F.when((exposed >= HIGH_EXPOSURE_FROM) | F.col("designated_critical"), "HIGH")
        .when(exposed >= MEDIUM_EXPOSURE_FROM, "MEDIUM")
        .otherwise("LOW")
    )
    return by_provider.withColumn("concentration_risk_tier", tier)


def breach_register(derived: DataFrame) -> DataFrame:
    """One row per reportable incident with its deadline, containment and breach."""
    return derived.filter(F.col("notify_deadline_hours").isNotNull()).select(
        "incident_id",
        "institution_id",
        "severity",
        "detection_timestamp",
        "notify_deadline_hours",
        "deadline_timestamp",
        F.col("containment_hours").alias("actual_containment_hours"),
        "sla_breached",
        "hours_overdue",
    )
