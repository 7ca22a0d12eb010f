"""Audit records, and the check of stored rows against them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.config import CLASSIFIER_VERSION, PIPELINE_VERSION, WireNames
from tidewarden.functions.keys import record_hash


def with_hash(classified: DataFrame, names: WireNames = WireNames()) -> DataFrame:
    return classified.withColumn("record_hash", record_hash(names))


def audit(hashed: DataFrame, batch_ts: Column) -> DataFrame:
    """One audit row per classified row that carries `record_hash`."""
    return hashed.select(
        "incident_id",
        batch_ts.alias("processed_at"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        F.lit(CLASSIFIER_VERSION).alias("classifier_version"),
        "record_hash",
    )


def verify(classified: DataFrame, audit_log: DataFrame, names: WireNames = WireNames()) -> DataFrame:
    """Incidents whose stored rows and audit records do not agree.

    status: `altered` (audited, but some row has a hash no audit record holds), `unaudited` (no audit
    record), `missing` (an audit record but no row). No join: both sides are counted per (id, hash),
    which collapses a hot id before the shuffle, and then per id.
    """
    # 32 bytes instead of 64 hex digits go through the shuffle.
    rows = classified.select(
        "incident_id", F.unhex(record_hash(names)).alias("digest"), F.lit(1).alias("stored"), F.lit(0).alias("audited")
    )
    records = audit_log.select(
        "incident_id", F.unhex("record_hash").alias("digest"), F.lit(0).alias("stored"), F.lit(1).alias("audited")
    )
    per_hash = rows.unionByName(records).groupBy("incident_id", "digest").agg(
        F.sum("stored").alias("stored"), F.sum("audited").alias("audited")
    )
    per_id = per_hash.groupBy("incident_id").agg(
        F.sum("stored").alias("stored_rows"),
        F.sum("audited").alias("audit_rows"),
        F.sum(F.when(F.col("audited") == 0, F.col("stored")).otherwise(0)).alias("unmatched_rows"),
    )
    status = (
        F.when(F.col("audit_rows") == 0, F.lit("unaudited"))
        .when(F.col("stored_rows") == 0, F.lit("missing"))
        .when(F.col("unmatched_rows") > 0, F.lit("altered"))
    )
    return per_id.withColumn("status", status).filter(F.col("status").isNotNull())
