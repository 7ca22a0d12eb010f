"""Marts from parts: what a load adds to each mart is aggregated once, and a mart adds up the parts.

The parts hold nothing that a later time changes; what depends on the current time or on the vendors is worked out
when a mart is read. So a run aggregates the rows of its load, whatever the size of the history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.config import LOOKBACK_DAYS
from tidewarden.functions.numbers import mean_of_parts, mean_parts
from tidewarden.operators import marts
from tidewarden.operators.deadlines import breached_as_of, join_vendors, timed

REPORT_KEYS = ("reporting_period", "institution_id", "institution_type")
REPORT_COUNTS = (
    "incident_count_total",
    "incident_count_critical",
    "incident_count_major",
    "incident_count_minor",
    "incidents_reported",
    "within_deadline",
)
PROVIDER_KEYS = ("ict_third_party_provider", "institution_id", "incident_day")


def report_parts(staged: DataFrame) -> DataFrame:
    """Counts and sums of the regulatory report by month and institution."""
    tier = F.col("severity")
    conditions = (F.lit(True), tier == "critical", tier == "major", tier == "minor", F.col("notify_required"), F.col("is_within_deadline"))
    counts = [F.count_if(c).alias(name) for name, c in zip(REPORT_COUNTS, conditions, strict=True)]
    return timed(staged).groupBy(*REPORT_KEYS).agg(*counts, *mean_parts(F.col("containment_hours"), "hours", unit_digits=2))


def regulatory_report(parts: DataFrame) -> DataFrame:
    """The report of `marts.regulatory_report` from the parts of all loads."""
    totals = parts.groupBy(*REPORT_KEYS).agg(
        *[F.sum(name).alias(name) for name in REPORT_COUNTS[:-1]],
        mean_of_parts("hours", unit_digits=2).alias("avg_time_to_contain_hours"),
        F.sum("within_deadline").alias("within_deadline"),
    )
    return marts.with_compliance(totals)


def provider_parts(staged: DataFrame) -> DataFrame:
    """Incidents and impact by provider, institution and day."""
    rows = staged.filter(F.col("ict_third_party_provider").isNotNull()).withColumn("incident_day", F.to_date("incident_ts"))
    return rows.groupBy(*PROVIDER_KEYS).agg(F.count(F.lit(1)).alias("incidents"), *mean_parts(F.col("financial_impact_eur"), "impact"))


def vendor_risk(parts: DataFrame, vendors: DataFrame, as_of: Column) -> DataFrame:
    """The register of `marts.vendor_risk` from the parts of all loads.

    The vendors' attributes are those of now, looked up once per provider; a name must stand once among them.
    """
    recent = F.when(F.col("incident_day") >= F.date_sub(F.to_date(as_of), LOOKBACK_DAYS), F.col("incidents")).otherwise(0)
    impact = ("impact_seen", "impact_exact", "impact_units", "impact_plain")
    # By institution first, so that the institutions are counted without a second expansion of the rows.
    exposed = parts.groupBy("ict_third_party_provider", "institution_id").agg(
        F.sum(recent).alias("recent"), *[F.sum(c).alias(c) for c in impact]
    )
    by_provider = exposed.groupBy("ict_third_party_provider").agg(
        F.sum("recent").alias("incident_count_last_90d"),
        mean_of_parts("impact").alias("avg_financial_impact_eur"),
        F.count("institution_id").alias("institutions_exposed"),
    )
    joined = join_vendors(by_provider, vendors).select(
        "ict_third_party_provider", "vendor_type", "eu_headquartered", "designated_critical",
        "incident_count_last_90d", "avg_financial_impact_eur", "institutions_exposed",
    )
    return marts.with_concentration(joined)


def breach_parts(staged: DataFrame) -> DataFrame:
    """The reportable incidents with deadline and containment."""
    return timed(staged).filter(F.col("notify_deadline_hours").isNotNull()).select(
        "incident_id", "institution_id", "severity", "detection_timestamp", "notify_deadline_hours",
        "deadline_timestamp", F.col("containment_hours").alias("actual_containment_hours"),
    )


def breach_register(parts: DataFrame, as_of: Column) -> DataFrame:
    """The register of `marts.breach_register` as of a time: two more columns, without a shuffle."""
    return breached_as_of(parts, as_of)


# Name -> (parts of a load, how parts are added up; None where they are rows).
PARTS = {
    "report": (report_parts, REPORT_KEYS),
    "provider": (provider_parts, PROVIDER_KEYS),
    "breach": (breach_parts, None),
}


def merged(name: str, parts: DataFrame) -> DataFrame:
    """Parts of several loads as those of one."""
    keys = PARTS[name][1]
    if keys is None:
        return parts
    kinds = dict(parts.dtypes)
    # A sum of decimals is wider by ten digits; the sums are whole numbers far below that.
    sums = [F.sum(c).cast(kinds[c]).alias(c) for c in parts.columns if c not in keys]
    return parts.groupBy(*keys).agg(*sums)
