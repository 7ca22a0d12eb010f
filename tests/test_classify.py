
import pytest

from tests.frames import incidents, plan_of
from tidewarden.config import Thresholds
from tidewarden.operators import classify as c

NAN, INF = float("nan"), float("inf")

CASES = [
    ({"clients_affected_pct": 30.0}, 1, "critical", 4),
    ({"clients_affected_pct": 25.0}, 1, "critical", 4),
    ({"clients_affected_pct": 24.99}, 5, "major", 72),
    ({"clients_affected_pct": 10.0}, 5, "major", 72),
    ({"clients_affected_pct": 9.99}, 8, "minor", None),
    ({"clients_affected_pct": 5.0, "financial_impact_eur": 1_500_000.0}, 2, "critical", 4),
    ({"financial_impact_eur": 1_000_000.0}, 2, "critical", 4),
    ({"financial_impact_eur": 999_999.99}, 6, "major", 72),
    ({"financial_impact_eur": 100_000.0}, 6, "major", 72),
    ({"financial_impact_eur": 99_999.99}, 8, "minor", None),
    ({"incident_type": "cyber_attack", "clients_affected_pct": 10.0}, 3, "critical", 4),
    ({"incident_type": "cyber_attack", "clients_affected_pct": 9.99}, 8, "minor", None),
    ({"is_cross_border": True, "clients_affected_pct": 10.0}, 4, "critical", 4),
    ({"is_cross_border": True, "clients_affected_pct": 9.99}, 8, "minor", None),
    ({"incident_type": "cyber_attack", "is_cross_border": True, "clients_affected_pct": 12.0}, 3, "critical", 4),
    ({"incident_type": "system_outage", "ict_third_party_provider": "AWS"}, 7, "major", 72),
    ({"incident_type": "system_outage", "ict_third_party_provider": ""}, 7, "major", 72),
    ({"incident_type": "system_outage"}, 8, "minor", None),
    ({"incident_type": "data_breach", "ict_third_party_provider": "AWS"}, 8, "minor", None),
    (
        {"incident_type": "system_outage", "ict_third_party_provider": "AWS", "clients_affected_pct": 15.0},
        5, "major", 72,
    ),
    ({"clients_affected_pct": NAN, "financial_impact_eur": NAN}, 8, "minor", None),
    ({"clients_affected_pct": NAN, "financial_impact_eur": 2e6}, 2, "critical", 4),
    ({"clients_affected_pct": INF}, 1, "critical", 4),
    ({"clients_affected_pct": None, "financial_impact_eur": None, "is_cross_border": None}, 8, "minor", None),
    # What the event arrived with is replaced.
    ({"severity": "critical", "notify_required": True, "notify_deadline_hours": 4}, 8, "minor", None),
]


def test_rules_at_their_bounds(spark):
    df = incidents(spark, *[case[0] for case in CASES]).withColumn("rule", c.rule_id())
    rows = {r["incident_id"]: r for r in c.classify(df).collect()}
    for n, (change, rule, tier, hours) in enumerate(CASES):
        r = rows[f"00000000-0000-4000-8000-{n:012d}"]
        assert (r["rule"], r["severity"], r["notify_deadline_hours"]) == (rule, tier, hours), change
        assert r["notify_required"] is (tier != "minor")


def test_custom_thresholds_change_the_tier(spark):
    df = incidents(spark, {"clients_affected_pct": 8.0})
    assert c.classify(df).first()["severity"] == "minor"
    assert c.classify(df, Thresholds(major_pct=5.0)).first()["severity"] == "major"


def test_each_rule_can_be_asked_alone(spark):
    df = incidents(spark, {"incident_type": "cyber_attack", "is_cross_border": True, "clients_affected_pct": 12.0})
    row = c.rule_flags(df).first()
    assert {r.name for r in c.rules() if row[r.name]} == {"critical_cyber", "critical_abroad", "major_clients"}


PCTS = [25.0, 25.25, 25.35, 25.45, 99.95, 34.2, 1234.56, INF]
EURS = [1_000_000.0, 1_000_000.5, 1_000_001.5, 123_456_789.49, INF]


def test_reason_texts(spark):
    changes = [{"clients_affected_pct": p} for p in PCTS] + [{"financial_impact_eur": e} for e in EURS]
    got = [r["classification_reason"] for r in c.add_reason(incidents(spark, *changes)).collect()]
    want = [f"CRITICAL: {p:.1f}% of clients affected — exceeds 25% BaFin Article 18 threshold" for p in PCTS]
    want += [f"CRITICAL: €{e:,.0f} financial impact — exceeds €1,000,000 BaFin Article 18 threshold" for e in EURS]
    assert got == want


def test_reason_of_the_other_rules(spark):
    changes = [
        {"incident_type": "cyber_attack", "clients_affected_pct": 12.25},
        {"is_cross_border": True, "clients_affected_pct": 12.35},
        {"clients_affected_pct": 12.0},
        {"financial_impact_eur": 250_000.0},
        {"incident_type": "system_outage", "ict_third_party_provider": "Finastra"},
        {},
    ]
    got = [r["classification_reason"] for r in c.add_reason(incidents(spark, *changes)).collect()]
    assert got == [
        "CRITICAL: cyber_attack with 12.2% clients affected — exceeds 10% cyber-attack BaFin threshold",
        "CRITICAL: cross-border incident with 12.3% clients affected — exceeds 10% cross-border BaFin threshold",
        "MAJOR: 12.0% of clients affected — exceeds 10% BaFin Article 18 threshold",
        "MAJOR: €250,000 financial impact — exceeds €100,000 BaFin Article 18 threshold",
        "MAJOR: third-party provider 'Finastra' involved in system_outage",
        "MINOR: no BaFin reporting threshold met — internal logging only",
    ]


@pytest.mark.parametrize("name", ["critical_pct", "critical_eur", "cyber_pct", "cross_border_pct", "major_pct", "major_eur"])
def test_a_higher_threshold_never_raises_a_tier(spark, name):
    rank = {"minor": 0, "major": 1, "critical": 2}
    df = incidents(spark, *[case[0] for case in CASES])
    base = Thresholds()
    raised = Thresholds(**{name: getattr(base, name) * 2})
    before = {r["incident_id"]: rank[r["severity"]] for r in c.classify(df, base).collect()}
    after = {r["incident_id"]: rank[r["severity"]] for r in c.classify(df, raised).collect()}
    assert all(after[k] <= before[k] for k in before)


def test_reconciliation(spark):
    df = incidents(spark, {"severity": "minor"}, {"severity": "major"}, {}, {"clients_affected_pct": 30.0, "severity": "critical"})
    got = {(r["incoming"], r["classified"]): (r["incidents"], r["agrees"]) for r in c.reconcile(df).collect()}
    assert got == {
        ("minor", "minor"): (1, True),
        ("major", "minor"): (1, False),
        (None, "minor"): (1, False),
        ("critical", "critical"): (1, True),
    }


def test_classification_is_a_projection(spark):
    plan = plan_of(c.add_reason(c.classify(incidents(spark, {}))))
    assert "Exchange" not in plan and "Python" not in plan
