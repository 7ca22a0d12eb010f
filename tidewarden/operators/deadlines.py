"""The shared layer: incident with vendor attributes, deadline, containment and breach as of a time."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.functions.numbers import from_hundredths, hour_hundredths
from tidewarden.operators.lookup import BROADCAST_BYTES, left_lookup

BEFORE_DERIVED = (
    "incident_sk",
    "incident_id",
    "incident_ts",
    "detection_timestamp",
    "containment_timestamp",
    "reporting_period",
    "institution_id",
    "institution_type",
    "incident_type",
    "affected_systems",
    "clients_affected_pct",
    "financial_impact_eur",
    "is_cross_border",
    "severity",
    "notify_required",
    "notify_deadline_hours",
    "classification_reason",
    "ict_third_party_provider",
    "vendor_type",
    "eu_headquartered",
    "designated_critical",
    "vendor_concentration_risk_score",
    "is_hyperscaler",
    "containment_hours",
    "deadline_timestamp",
)


def join_vendors(staged: DataFrame, vendors: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """LEFT JOIN on the exact provider name; the two flags are false when no vendor matches."""
    attributes = vendors.withColumnRenamed("concentration_risk_score", "vendor_concentration_risk_score")
    return left_lookup(
        staged, attributes, "ict_third_party_provider", "vendor_name", limit
    ).withColumns(
        {flag: F.coalesce(F.col(flag), F.lit(False)) for flag in ("designated_critical", "is_hyperscaler")}
    )


def derive(
    staged: DataFrame, vendors: DataFrame, as_of: Column, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """One row per incident with the fields all marts share. `as_of` stands for the current time."""
    hours, end, deadline = F.col("notify_deadline_hours"), F.col("containment_timestamp"), F.col("deadline_timestamp")
    taken = hour_hundredths(F.col("detection_timestamp"), end)
    breached, overdue = _breach(end.isNotNull(), taken, hours, deadline, as_of)
    return timed(join_vendors(staged, vendors, limit)).select(
        *BEFORE_DERIVED,
        "is_within_deadline",
        breached.alias("sla_breached"),
        F.when(breached, from_hundredths(overdue)).alias("hours_overdue"),
    )


def timed(staged: DataFrame) -> DataFrame:
    """The rows with their month, containment time, deadline and whether it was met: all that no later time changes."""
    hours, end = F.col("notify_deadline_hours"), F.col("containment_timestamp")
    taken = hour_hundredths(F.col("detection_timestamp"), end)
    return staged.withColumns(
        {
            "reporting_period": F.date_format("incident_ts", "yyyy-MM"),
            "containment_hours": F.when(end.isNotNull(), from_hundredths(taken)),
            "deadline_timestamp": F.col("detection_timestamp") + F.make_dt_interval(F.lit(0), hours, F.lit(0), F.lit(0)),
            "is_within_deadline": F.col("notify_required") & end.isNotNull() & (taken <= hours * F.lit(100)),
        }
    )


def _breach(contained: Column, taken: Column, hours: Column, deadline: Column, as_of: Column) -> tuple[Column, Column]:
    """(breached, hundredths of hours overdue); both null without deadline hours."""
    allowed = hours * F.lit(100)
    overdue = F.when(contained, taken - allowed).otherwise(hour_hundredths(deadline, as_of))
    return F.when(contained, taken > allowed).otherwise(as_of > deadline), overdue


def breached_as_of(register: DataFrame, as_of: Column) -> DataFrame:
    """A register without them gets `sla_breached` and `hours_overdue`, read off `actual_containment_hours`."""
    actual = F.col("actual_containment_hours")
    taken = F.rint(actual * F.lit(100)).cast("bigint")
    breached, overdue = _breach(
        actual.isNotNull(), taken, F.col("notify_deadline_hours"), F.col("deadline_timestamp"), as_of
    )
    return register.withColumns({"sla_breached": breached, "hours_overdue": F.when(breached, from_hundredths(overdue))})
