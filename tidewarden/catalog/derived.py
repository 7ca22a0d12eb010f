"""Incidents, vendors and their variants, derived by Spark from the given `events` and `supplier` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden import schemas
from tidewarden.config import Thresholds
from tidewarden.functions import jsontext, keys
from tidewarden.functions.plan import computed_once, over_all_cores
from tidewarden.operators import classify as rules
from tidewarden.sources import events as event_json

AS_OF = "2024-04-10 00:00:00"
LOAD_UNTIL = "2024-01-20 00:00:00"
PROCESSED_AT = "2024-02-01 00:00:00"
HYPERSCALERS = tuple(f"Supplier#{n:09d}" for n in range(3))
SYSTEMS = (
    "core-banking", "payments", "cards", "online-portal", "mobile-app", "trading", "settlement",
    "custody", "claims", "policy-admin", "identity", "email", "data-warehouse", "network", "storage",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the helper numbers of the recipe."""
    # The given table is one file with one row group; what follows is far more work than to deal out its rows.
    base = over_all_cores(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")).select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    base = computed_once(base, {"cents": F.col("cents"), "k": F.col("k")})
    return base.withColumns(
        {
            "u": (F.col("event_id") * 7919 + F.col("k") * 104729) % 100000,
            "det": F.timestamp_micros(
                F.unix_micros("ts") - ((F.col("event_id") * 2221) % 86400) * 1_000_000
            ),
        }
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per event, as it arrives: a tier may be set already, the duty fields are not.

    Keeps `event_id` first, for the variants below.
    """
    e, u, k, user = F.col("event_id"), F.col("u"), F.col("k"), F.col("user_id")
    cents = F.col("cents")
    provider_no = F.when(
        e % 3 == 0, F.when(cents % 100 < 90, cents % 12).otherwise(12 + e % 2000)
    )
    kind = F.when(k % 10 == 7, "cyber_attack")
    for name, value in (
        ("error", "system_outage"),
        ("click", "authentication_failure"),
        ("view", "data_breach"),
        ("signup", "third_party_failure"),
        ("purchase", "transaction_failure"),
    ):
        kind = kind.when(F.col("event_type") == name, value)
    type_no = user % 20
    contained_after = (e * 5303) % (14000 + (user % 5) * 60000)
    columns = {
        "incident_id": F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(e.cast("string"), 12, "0")),
        "incident_ts": F.col("ts"),
        "institution_id": F.concat(F.lit("INST_"), F.lpad((user % 60 + 1).cast("string"), 3, "0")),
        "institution_type": F.when(type_no < 6, "bank")
        .when(type_no < 11, "insurer")
        .when(type_no < 16, "payment_provider")
        .otherwise("asset_manager"),
        "incident_type": kind,
        "affected_systems": F.slice(
            F.array(*map(F.lit, SYSTEMS)), (e % 12 + 1).cast("int"), (k % 4 + 1).cast("int")
        ),
        "clients_affected_pct": F.call_function("div", cents, F.lit(10)).cast("double") / 100,
        "financial_impact_eur": F.when(u % 100 == 0, (1000000 + 90 * u).cast("double"))
        .when(u % 100 < 6, (100000 + 8 * u).cast("double"))
        .otherwise((95 * u).cast("double") / 100),
        "detection_timestamp": F.col("det"),
        "containment_timestamp": F.when(
            (e * 13 + k) % 20 >= user % 5,
            F.timestamp_micros(F.unix_micros("det") + contained_after * 1_000_000),
        ),
        "ict_third_party_provider": F.concat(F.lit("Supplier#"), F.lpad(provider_no.cast("string"), 9, "0")),
        "is_cross_border": k % 7 == 0,
        "severity": F.when(k % 4 == 0, "critical").when(k % 4 == 1, "major").when(k % 4 == 2, "minor"),
        "notify_required": F.lit(None).cast("boolean"),
        "notify_deadline_hours": F.lit(None).cast("int"),
    }
    return events(spark, sf_dir).select(e, *[c.alias(n) for n, c in columns.items()])


def classified(spark: SparkSession, sf_dir: str, thresholds: Thresholds = Thresholds()) -> DataFrame:
    return rules.add_reason(rules.classify(incidents(spark, sf_dir), thresholds), thresholds)


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as vendors; the later providers of the incidents stay without one."""
    key = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_name").alias("vendor_name"),
            F.when(key % 3 == 0, "cloud").when(key % 3 == 1, "saas").otherwise("infrastructure").alias("vendor_type"),
            (F.col("r_name") == "EUROPE").alias("eu_headquartered"),
            (key % 4 == 0).alias("designated_critical"),
            (1 + key % 5).cast("int").alias("concentration_risk_score"),
        )
    )


def padded_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors with blanks around the texts."""
    return vendors(spark, sf_dir).withColumns(
        {
            "vendor_name": F.concat(F.lit("  "), "vendor_name", F.lit(" ")),
            "vendor_type": F.concat(F.lit(" "), "vendor_type"),
        }
    )


def flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified rows with violations planted: no tier, unknown tier, share over 100, negative money,
    critical without the duty flag, no provider match."""
    e = F.col("event_id")
    return classified(spark, sf_dir).withColumns(
        {
            "severity": F.when(e % 101 == 0, F.lit(None)).when(e % 109 == 0, "severe").otherwise(F.col("severity")),
            "clients_affected_pct": F.when(e % 103 == 0, 101.0).otherwise(F.col("clients_affected_pct")),
            "financial_impact_eur": F.when(e % 107 == 0, -1.0).otherwise(F.col("financial_impact_eur")),
            "notify_required": F.when(e % 11 == 0, False).when(e % 13 == 0, F.lit(None)).otherwise(
                F.col("notify_required")
            ),
        }
    )


def duplicated_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors where each one with the lowest risk score appears twice."""
    copies = F.when(F.col("concentration_risk_score") == 1, 2).otherwise(1)
    return vendors(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every incident as a JSON message in `value`, some of them damaged or oddly spelled."""
    e = F.col("event_id")
    rows = incidents(spark, sf_dir).withColumns(
        {
            "institution_type": F.when(e % 89 == 0, "hedge_fund").otherwise(F.col("institution_type")),
            "institution_id": F.when(e % 79 == 0, F.lit(None)).otherwise(F.col("institution_id")),
        }
    )
    sent = rows.select("event_id", jsontext.object_text(keys.event_members()).alias("text"))
    text = F.col("text")
    value = (
        F.when(e % 97 == 0, F.left(text, F.length(text) - 1))
        .when(e % 83 == 0, F.regexp_replace(text, '("clients_affected_pct": )([0-9.]+)', '$1"$2"'))
        .when(e % 73 == 0, F.regexp_replace(text, '("financial_impact_eur": )[0-9.]+', "$1NaN"))
        .otherwise(text)
    )
    return sent.select(value.alias("value"))


def copied_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every incident as one to three equal messages, every eleventh also as an amendment, contained and at 60 %."""
    rows = incidents(spark, sf_dir)
    amended = rows.filter(F.col("event_id") % 11 == 4).withColumns(
        {
            "clients_affected_pct": F.lit(60.0),
            "containment_timestamp": F.col("detection_timestamp") + F.expr("INTERVAL 90 HOURS"),
        }
    )
    copies = (F.col("event_id") % 3 + 1).cast("int")
    sent = rows.unionByName(amended).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return event_json.encode(sent.select(*schemas.columns(schemas.INCIDENT))).select("value")
