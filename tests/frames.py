"""Small explicit frames."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import types as T

from tidewarden import schemas

BASE = {
    "incident_id": "5f0c9e2a-7d31-4c58-9a44-2be6d1037f90",
    "incident_ts": datetime(2026, 6, 1, 10, 0, tzinfo=timezone.utc),
    "institution_id": "NL-INS-417",
    "institution_type": "insurer",
    "incident_type": "data_breach",
    "affected_systems": ["claims", "identity"],
    "clients_affected_pct": 2.5,
    "financial_impact_eur": 4_200.0,
    "detection_timestamp": datetime(2026, 6, 1, 9, 15, tzinfo=timezone.utc),
    "containment_timestamp": None,
    "ict_third_party_provider": None,
    "is_cross_border": False,
    "severity": None,
    "notify_required": None,
    "notify_deadline_hours": None,
}


def loose(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def incidents(spark, *changes: dict):
    """One row per dict of changes to the base incident; ids are numbered unless given."""
    rows = []
    for n, change in enumerate(changes):
        row = BASE | {"incident_id": f"00000000-0000-4000-8000-{n:012d}"} | change
        rows.append(tuple(row[name] for name in schemas.columns(schemas.INCIDENT)))
    return spark.createDataFrame(rows, loose(schemas.INCIDENT))


def vendors(spark, *rows: tuple):
    return spark.createDataFrame(list(rows), schemas.VENDOR)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
