"""Severity rules: first matching rule, tier, notification duty, stated reason."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.config import DEADLINE_HOURS, Thresholds


@dataclass(frozen=True)
class Rule:
    """One classification rule; `holds` never yields null."""

    name: str
    tier: str
    holds: Column
    reason: Column


def _at_least(value: Column, bound: float) -> Column:
    # Spark orders NaN above every number; here an unknown amount meets no threshold.
    return F.coalesce(~F.isnan(value) & (value >= F.lit(float(bound))), F.lit(False))


def _is(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _fixed(value: Column, places: int) -> Column:
    shown = F.format_number(value, places)
    return F.when(F.abs(value) == F.lit(float("inf")), F.lit("inf")).otherwise(shown)


def rules(thresholds: Thresholds = Thresholds()) -> list[Rule]:
    """The seven rules in priority order."""
    t = thresholds
    pct, eur = F.col("clients_affected_pct"), F.col("financial_impact_eur")
    provider = F.col("ict_third_party_provider")
    pct_text = F.replace(_fixed(pct, 1), F.lit(","), F.lit(""))
    eur_text = _fixed(eur, 0)
    cyber = _is(F.col("incident_type") == "cyber_attack")
    abroad = _is(F.col("is_cross_border"))
    outage = _is(F.col("incident_type") == "system_outage")

    # The wording of the reasons.
    def clients(tier: str, bound: float) -> Column:
        return F.concat(
            F.lit(f"{tier}: "), pct_text,
            F.lit(f"% of clients affected — exceeds {bound:.0f}% BaFin Article 18 threshold"),
        )

    def money(tier: str, bound: float) -> Column:
        return F.concat(
            F.lit(f"{tier}: €"), eur_text,
            F.lit(f" financial impact — exceeds €{bound:,.0f} BaFin Article 18 threshold"),
        )

    cyber_reason = F.concat(
        F.lit("CRITICAL: cyber_attack with "), pct_text,
        F.lit(f"% clients affected — exceeds {t.cyber_pct:.0f}% cyber-attack BaFin threshold"),
    )
    abroad_reason = F.concat(
        F.lit("CRITICAL: cross-border incident with "), pct_text,
        F.lit(f"% clients affected — exceeds {t.cross_border_pct:.0f}% cross-border BaFin threshold"),
    )
    outage_reason = F.concat(
        F.lit("MAJOR: third-party provider '"), provider, F.lit("' involved in system_outage")
    )
    return [
        Rule("critical_clients", "critical", _at_least(pct, t.critical_pct), clients("CRITICAL", t.critical_pct)),
        Rule("critical_money", "critical", _at_least(eur, t.critical_eur), money("CRITICAL", t.critical_eur)),
        Rule("critical_cyber", "critical", cyber & _at_least(pct, t.cyber_pct), cyber_reason),
        Rule("critical_abroad", "critical", abroad & _at_least(pct, t.cross_border_pct), abroad_reason),
        Rule("major_clients", "major", _at_least(pct, t.major_pct), clients("MAJOR", t.major_pct)),
        Rule("major_money", "major", _at_least(eur, t.major_eur), money("MAJOR", t.major_eur)),
        Rule("major_outage", "major", provider.isNotNull() & outage, outage_reason),
    ]


MINOR_RULE = 8
MINOR_REASON = "MINOR: no BaFin reporting threshold met — internal logging only"


def _first_match(thresholds: Thresholds, value: Callable[[int, Rule], Column], default: Column) -> Column:
    chain = None
    for number, rule in enumerate(rules(thresholds), start=1):
        chain = (F if chain is None else chain).when(rule.holds, value(number, rule))
    return chain.otherwise(default)


def rule_id(thresholds: Thresholds = Thresholds()) -> Column:
    """Number of the first rule that holds, 8 when none does."""
    return _first_match(thresholds, lambda number, _: F.lit(number), F.lit(MINOR_RULE))


def severity(thresholds: Thresholds = Thresholds()) -> Column:
    return _first_match(thresholds, lambda _, rule: F.lit(rule.tier), F.lit("minor"))


def reason(thresholds: Thresholds = Thresholds()) -> Column:
    return _first_match(thresholds, lambda _, rule: rule.reason, F.lit(MINOR_REASON))


def rule_flags(df: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Add one boolean column per rule."""
    return df.withColumns({rule.name: rule.holds for rule in rules(thresholds)})


def classify(df: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Set tier, notification duty and deadline hours, replacing whatever the event carried."""
    hours = _first_match(
        thresholds, lambda _, rule: F.lit(DEADLINE_HOURS[rule.tier]), F.lit(None).cast("int")
    )
    required = _first_match(thresholds, lambda _, rule: F.lit(True), F.lit(False))
    return df.withColumns(
        {
            "severity": severity(thresholds),
            "notify_required": required,
            "notify_deadline_hours": hours,
        }
    )


def add_reason(df: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Add the text of the first rule that holds; it does not look at `severity`."""
    return df.withColumn("classification_reason", reason(thresholds))


def reconcile(df: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Count events by the tier they arrived with and the tier the rules give."""
    return (
        df.select(F.col("severity").alias("incoming"), severity(thresholds).alias("classified"))
        .groupBy("incoming", "classified")
        .agg(F.count(F.lit(1)).alias("incidents"))
        .withColumn("agrees", F.col("incoming").eqNullSafe(F.col("classified")))
    )
