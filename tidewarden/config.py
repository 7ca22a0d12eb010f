"""Settings: thresholds, wire field names, job endpoints, and the fixed regulatory values."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

# The accepted literals of an incident event.
INSTITUTION_TYPES = ("bank", "insurer", "payment_provider", "asset_manager")
INCIDENT_TYPES = (
    "system_outage",
    "data_breach",
    "third_party_failure",
    "cyber_attack",
    "transaction_failure",
    "authentication_failure",
)
TIERS = ("critical", "major", "minor")

# Hours to notify the regulator. A minor incident has no deadline.
DEADLINE_HOURS = {"critical": 4, "major": 72}

# Display labels of the tiers.
SEVERITY_LABELS = {
    "critical": "Critical — BaFin notification within 4 hours",
    "major": "Major — BaFin notification within 72 hours",
    "minor": "Minor — internal logging only",
}
UNKNOWN_LABEL = "Unknown severity"

# Vendor names that count as hyperscalers in staging and in enriched messages, which know one name less,
# and the status and tier bounds of the marts.
HYPERSCALERS = ("AWS", "Azure", "GCP", "Google Cloud")
ENRICHED_HYPERSCALERS = ("AWS", "Azure", "GCP")
COMPLIANT_FROM_PCT = 95
AT_RISK_FROM_PCT = 80
HIGH_EXPOSURE_FROM = 5
MEDIUM_EXPOSURE_FROM = 2
LOOKBACK_DAYS = 90

# The compliance statuses and the concentration tiers.
COMPLIANCE_STATUSES = ("COMPLIANT", "AT_RISK", "NON_COMPLIANT")
CONCENTRATION_TIERS = ("HIGH", "MEDIUM", "LOW")

# Takes the events that carry no tier with a topic of its own.
UNTIERED_TOPIC = "incidents.untiered"

PIPELINE_VERSION = "1.0.0"
CLASSIFIER_VERSION = "1.0.0"


@dataclass(frozen=True)
class Thresholds:
    """Lower bounds (inclusive) of the classification rules; override any subset."""

    critical_pct: float = 25.0
    critical_eur: float = 1_000_000.0
    cyber_pct: float = 10.0
    cross_border_pct: float = 10.0
    major_pct: float = 10.0
    major_eur: float = 100_000.0


@dataclass(frozen=True)
class WireNames:
    """JSON key of each column. Set those that differ in an existing producer's messages.

    The record hash covers the keys too, so an existing audit log verifies only under the
    names it was written with.
    """

    incident_id: str = "incident_id"
    incident_ts: str = "timestamp"
    institution_id: str = "institution_id"
    institution_type: str = "institution_type"
    incident_type: str = "incident_type"
    affected_systems: str = "affected_systems"
    clients_affected_pct: str = "clients_affected_pct"
    financial_impact_eur: str = "financial_impact_eur"
    detection_timestamp: str = "detection_timestamp"
    containment_timestamp: str = "containment_timestamp"
    ict_third_party_provider: str = "ict_third_party_provider"
    is_cross_border: str = "is_cross_border"
    severity: str = "severity"
    notify_required: str = "notify_required"
    notify_deadline_hours: str = "notify_deadline_hours"

    def pairs(self) -> list[tuple[str, str]]:
        """(column, JSON key) in schema order."""
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


@dataclass(frozen=True)
class JobConfig:
    """Endpoints and names of a streaming job."""

    brokers: str = "localhost:9092"
    tier_topics: Mapping[str, str] = field(
        default_factory=lambda: {tier: f"incidents.{tier}" for tier in TIERS}
    )
    enriched_topic: str = "incidents.enriched"
    starting_offsets: str = "latest"
    # Bounds the first batch after a pause; None takes all that has arrived.
    max_offsets_per_trigger: int | None = None
    # More tasks than topic partitions; None is one task per topic partition.
    min_partitions: int | None = None
    trigger_seconds: int = 10

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JobConfig:
        """Read the settings from environment variables, keeping the default of each unset one."""
        # The names of the variables.
        env = os.environ if env is None else env
        base = cls()
        return cls(
            brokers=env.get("KAFKA_BROKER", base.brokers),
            tier_topics={
                tier: env.get(f"KAFKA_TOPIC_{tier.upper()}", base.tier_topics[tier])
                for tier in TIERS
            },
            enriched_topic=env.get("KAFKA_TOPIC_ENRICHED", base.enriched_topic),
            starting_offsets=env.get("KAFKA_STARTING_OFFSETS", base.starting_offsets),
            trigger_seconds=int(env.get("TRIGGER_SECONDS", base.trigger_seconds)),
        )

    @property
    def source_topics(self) -> str:
        """Comma-separated topics for the Kafka `subscribe` option."""
        return ",".join(self.tier_topics[tier] for tier in TIERS)
