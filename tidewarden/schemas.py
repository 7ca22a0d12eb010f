"""Declared schemas. Nothing is inferred."""

from pyspark.sql import types as T

INCIDENT = T.StructType(
    [
        T.StructField("incident_id", T.StringType(), False),
        T.StructField("incident_ts", T.TimestampType(), False),
        T.StructField("institution_id", T.StringType(), False),
        T.StructField("institution_type", T.StringType(), False),
        T.StructField("incident_type", T.StringType(), False),
        T.StructField("affected_systems", T.ArrayType(T.StringType(), True), False),
        T.StructField("clients_affected_pct", T.DoubleType(), False),
        T.StructField("financial_impact_eur", T.DoubleType(), False),
        T.StructField("detection_timestamp", T.TimestampType(), False),
        T.StructField("containment_timestamp", T.TimestampType(), True),
        T.StructField("ict_third_party_provider", T.StringType(), True),
        T.StructField("is_cross_border", T.BooleanType(), False),
        T.StructField("severity", T.StringType(), True),
        T.StructField("notify_required", T.BooleanType(), True),
        T.StructField("notify_deadline_hours", T.IntegerType(), True),
    ]
)

CLASSIFIED = T.StructType(
    INCIDENT.fields + [T.StructField("classification_reason", T.StringType(), True)]
)

AUDIT = T.StructType(
    [
        T.StructField("incident_id", T.StringType(), False),
        T.StructField("processed_at", T.TimestampType(), False),
        T.StructField("pipeline_version", T.StringType(), False),
        T.StructField("classifier_version", T.StringType(), False),
        T.StructField("record_hash", T.StringType(), False),
    ]
)

REJECTED = T.StructType(
    [
        T.StructField("value", T.StringType(), True),
        T.StructField("error_reason", T.StringType(), False),
        T.StructField("processed_at", T.TimestampType(), True),
    ]
)

VENDOR = T.StructType(
    [
        T.StructField("vendor_name", T.StringType(), True),
        T.StructField("vendor_type", T.StringType(), True),
        T.StructField("eu_headquartered", T.BooleanType(), True),
        T.StructField("designated_critical", T.BooleanType(), True),
        T.StructField("concentration_risk_score", T.IntegerType(), True),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("record_count", T.LongType(), False),
        T.StructField("loaded_count", T.LongType(), False),
        T.StructField("runtime_seconds", T.DoubleType(), True),
        T.StructField("logged_at", T.TimestampType(), False),
    ]
)

BATCH_LOG = T.StructType(
    [
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("processed", T.LongType(), False),
        T.StructField("critical", T.LongType(), False),
        T.StructField("major", T.LongType(), False),
        T.StructField("minor", T.LongType(), False),
        T.StructField("rejected", T.LongType(), False),
    ]
)


def columns(schema: T.StructType) -> list[str]:
    return schema.fieldNames()
