"""Each registered query: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden import schemas
from tidewarden.catalog import derived as given
from tidewarden.config import JobConfig, Thresholds
from tidewarden.functions.jsontext import list_text
from tidewarden.functions.session import prepare, scratch_dir
from tidewarden.operators import audit as auditing
from tidewarden.operators import charts, classify, deadlines, incremental, marts, quality, staging, summary
from tidewarden.operators.enrich import enrich
from tidewarden.plans import rolling
from tidewarden.plans.scheduled import RunPaths, load_new, read_run_log, run_scheduled
from tidewarden.sources import events as event_json
from tidewarden.sources import external, tables
from tidewarden.sources.vendors import load_vendors
from tidewarden.streaming import fold, job

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CUSTOM = Thresholds(critical_pct=20.0, critical_eur=500_000.0, major_pct=5.0, major_eur=50_000.0)
TOPICS = JobConfig().tier_topics


def plain(df: DataFrame) -> DataFrame:
    """Times without a zone, days and lists as text, so that any engine shows the same values."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            columns.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            columns.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            columns.append(list_text(F.col(f.name)).alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def query(build: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(prepare(spark), sf_dir))

    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return run


# Classification


@query
def classify_rows(spark, sf_dir):
    rows = given.incidents(spark, sf_dir).withColumn("rule_id", classify.rule_id())
    return classify.classify(rows).select(
        "incident_id", "rule_id", "severity", "notify_required", "notify_deadline_hours"
    )


@query
def classify_counts(spark, sf_dir):
    rows = given.incidents(spark, sf_dir).withColumn("rule_id", classify.rule_id())
    return classify.classify(rows).groupBy("rule_id", "severity").agg(F.count(F.lit(1)).alias("incidents"))


@query
def classify_custom_thresholds(spark, sf_dir):
    rows = given.incidents(spark, sf_dir).withColumn("rule_id", classify.rule_id(CUSTOM))
    return (
        classify.add_reason(classify.classify(rows, CUSTOM), CUSTOM)
        .select("incident_id", "rule_id", "severity", "notify_deadline_hours", "classification_reason")
    )


@query
def rule_flags(spark, sf_dir):
    names = [rule.name for rule in classify.rules()]
    return classify.rule_flags(given.incidents(spark, sf_dir)).select("incident_id", *names)


@query
def classification_reason(spark, sf_dir):
    return given.classified(spark, sf_dir).select("incident_id", "classification_reason")


@query
def tier_reconciliation(spark, sf_dir):
    return classify.reconcile(given.incidents(spark, sf_dir))


# Staging and joins


@query
def staging_incidents(spark, sf_dir):
    return staging.stage_incidents(given.flawed(spark, sf_dir))


@query
def staging_vendors(spark, sf_dir):
    return staging.stage_vendors(given.padded_vendors(spark, sf_dir), given.HYPERSCALERS)


@query
def vendor_csv(spark, sf_dir):
    """Columns in another order, tabs and blanks around values, and each vendor listed twice, wrong at first."""
    folder = f"{scratch_dir(spark, 'vendors')}/csv"
    right = given.padded_vendors(spark, sf_dir).withColumns(
        {
            "eu_headquartered": F.when(F.col("eu_headquartered"), " TRUE\t").otherwise("False"),
            "vendor_name": F.concat(F.lit("\t"), "vendor_name", F.lit(" \t")),
            "vendor_type": F.concat("vendor_type", F.lit("\t")),
        }
    )
    # One file, the wrong rows before the right ones.
    wrong = right.withColumns({"vendor_type": F.lit("outdated"), "concentration_risk_score": F.lit(0), "late": F.lit(0)})
    written = wrong.unionByName(right.withColumn("late", F.lit(1))).coalesce(1).sortWithinPartitions("late")
    written = written.select(
        "concentration_risk_score", "designated_critical", "vendor_name", "eu_headquartered", F.lit("x").alias("remark"), "vendor_type"
    )
    # Writers keep the blanks only if told to.
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    written.write.options(**options).csv(folder)
    return load_vendors(spark, folder)


def staged(spark, sf_dir):
    return staging.stage_incidents(given.classified(spark, sf_dir))


def staged_vendors(spark, sf_dir):
    return staging.stage_vendors(given.vendors(spark, sf_dir), given.HYPERSCALERS)


def derived(spark, sf_dir):
    return deadlines.derive(staged(spark, sf_dir), staged_vendors(spark, sf_dir), given.as_of())


@query
def vendor_join(spark, sf_dir):
    joined = deadlines.join_vendors(staged(spark, sf_dir), staged_vendors(spark, sf_dir))
    return joined.select(
        "incident_id", "ict_third_party_provider", "vendor_type", "eu_headquartered",
        "designated_critical", "vendor_concentration_risk_score", "is_hyperscaler",
    )


@query
def vendor_join_shuffled(spark, sf_dir):
    """The same join by the way taken when the vendors are too large to broadcast."""
    joined = deadlines.join_vendors(staged(spark, sf_dir), staged_vendors(spark, sf_dir), limit=0)
    return joined.select(
        "incident_id", "ict_third_party_provider", "vendor_type", "eu_headquartered",
        "designated_critical", "vendor_concentration_risk_score", "is_hyperscaler",
    )


@query
def enrich_lookup(spark, sf_dir):
    rows = given.classified(spark, sf_dir).withColumns(
        {
            "ict_third_party_provider": F.concat(F.lit(" "), "ict_third_party_provider", F.lit("\t")),
            "severity": F.concat(F.lit(" "), F.upper("severity")),
        }
    )
    enriched = enrich(rows, given.vendors(spark, sf_dir), given.HYPERSCALERS)
    return enriched.select(
        "incident_id", "severity_label", "vendor_known", "vendor_type", "vendor_eu_headquartered",
        "vendor_designated_critical", "vendor_concentration_risk_score", "vendor_is_hyperscaler",
    )


@query
def orphan_providers(spark, sf_dir):
    return staging.orphan_providers(staged(spark, sf_dir), staged_vendors(spark, sf_dir))


# Deadlines and marts


@query
def deadline_derivation(spark, sf_dir):
    return derived(spark, sf_dir)


@query
def sla_breach(spark, sf_dir):
    return marts.breach_register(derived(spark, sf_dir))


@query
def regulatory_report(spark, sf_dir):
    return marts.regulatory_report(derived(spark, sf_dir))


@query
def compliance_alerts(spark, sf_dir):
    return marts.compliance_alerts(marts.regulatory_report(derived(spark, sf_dir)))


@query
def vendor_risk(spark, sf_dir):
    return marts.vendor_risk(derived(spark, sf_dir), given.as_of())


# Charts


@query
def chart_compliance(spark, sf_dir):
    return charts.compliance_by_institution(marts.regulatory_report(derived(spark, sf_dir)))


@query
def chart_vendor(spark, sf_dir):
    return charts.vendor_concentration(marts.vendor_risk(derived(spark, sf_dir), given.as_of()))


@query
def chart_breach_timeline(spark, sf_dir):
    return charts.breach_timeline(marts.breach_register(derived(spark, sf_dir)))


@query
def chart_volume(spark, sf_dir):
    return charts.volume_by_period(marts.regulatory_report(derived(spark, sf_dir)))


@query
def chart_top_vendors(spark, sf_dir):
    """The twenty vendors that most institutions depend on; ties in order of tier and name."""
    return charts.vendor_concentration(marts.vendor_risk(derived(spark, sf_dir), given.as_of()), limit=20)


def stored_metric(aggregate: str, column: str) -> dict:
    return {"expressionType": "SIMPLE", "aggregate": aggregate, "column": {"column_name": column}}


TIMELINE_PARAMS = {
    "viz_type": "line",
    "x_axis": "detection_timestamp",
    "time_grain_sqla": "P1D",
    "metrics": [{"expressionType": "SQL", "sqlExpression": "count(*)", "label": "breach_count"}, stored_metric("MAX", "notify_deadline_hours")],
    "groupby": ["severity"],
    "adhoc_filters": [{"expressionType": "SQL", "sqlExpression": "sla_breached = true", "clause": "WHERE"}],
    "row_limit": 10_000,
}
CONCENTRATION_PARAMS = {
    "viz_type": "treemap",
    "metric": stored_metric("SUM", "institutions_exposed"),
    "groupby": ["concentration_risk_tier", "ict_third_party_provider"],
    "row_limit": 30,
}


@query
def chart_timeline_params(spark, sf_dir):
    return charts.from_params(marts.breach_register(derived(spark, sf_dir)), TIMELINE_PARAMS)


@query
def chart_concentration_params(spark, sf_dir):
    return charts.from_params(marts.vendor_risk(derived(spark, sf_dir), given.as_of()), CONCENTRATION_PARAMS)


@query
def adhoc_metric(spark, sf_dir):
    return charts.metric(
        derived(spark, sf_dir),
        ["severity", "incident_type"],
        {
            "incidents": "count(*)",
            "institutions": ("count_distinct", "institution_id"),
            "largest_impact_eur": ("max", "financial_impact_eur"),
            "breaches": "count_if(sla_breached)",
        },
        where="institution_type <> 'bank'",
    )


# Audit


@query
def record_hash(spark, sf_dir):
    return auditing.with_hash(given.classified(spark, sf_dir)).select("incident_id", "record_hash")


@query
def audit_log(spark, sf_dir):
    hashed = auditing.with_hash(given.classified(spark, sf_dir))
    return auditing.audit(hashed, F.lit(given.PROCESSED_AT).cast("timestamp"))


@query
def tamper_check(spark, sf_dir):
    """Some stored rows changed, some audit records lost, some stored rows lost."""
    e = F.col("event_id")
    rows = given.classified(spark, sf_dir)
    log = auditing.audit(
        auditing.with_hash(rows.filter(e % 37 != 5)), F.lit(given.PROCESSED_AT).cast("timestamp")
    )
    stored = rows.filter(e % 41 != 7).withColumn(
        "financial_impact_eur",
        F.when(e % 31 == 0, F.col("financial_impact_eur") + 1).otherwise(F.col("financial_impact_eur")),
    )
    return auditing.verify(stored, log)


# Quality


@query
def dq_suite(spark, sf_dir):
    return quality.run_suite(given.flawed(spark, sf_dir))


@query
def dq_totals(spark, sf_dir):
    return quality.totals(quality.run_suite(given.flawed(spark, sf_dir)))


@query
def dq_model_tests(spark, sf_dir):
    """The tests over stored models, as a run leaves them."""
    folder = scratch_dir(spark, "models")
    store = lambda frame, name: tables.materialise(frame, f"{folder}/{name}")
    rows = store(staging.stage_incidents(given.flawed(spark, sf_dir)), "stg_incidents")
    names = store(staging.stage_vendors(given.duplicated_vendors(spark, sf_dir), given.HYPERSCALERS), "stg_vendors")
    shared = store(deadlines.derive(rows, names, given.as_of()), "derived")
    return quality.model_tests(
        {
            "stg_incidents": rows,
            "stg_vendors": names,
            "derived": shared,
            "regulatory_report": store(marts.regulatory_report(shared), "regulatory_report"),
            "vendor_risk": store(marts.vendor_risk(shared, given.as_of()), "vendor_risk"),
            "breach_register": store(marts.breach_register(shared), "breach_register"),
        }
    )


SUITE_FILE = {
    "expectation_suite_name": "incidents",
    "expectations": [
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "timestamp"}, "meta": {}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "timestamp"}},
        {
            "expectation_type": "expect_column_values_to_not_be_null",
            "kwargs": {
                "column": "containment_timestamp",
                "row_condition": "detection_timestamp < timestamp and incident_type <> 'timestamp'",
                "condition_parser": "spark",
            },
        },
        {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "severity", "value_set": ["critical", "major", "minor"]}},
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "financial_impact_eur", "min_value": 0}},
        {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1}},
    ],
}


def suite_from_file(spark):
    folder = f"{scratch_dir(spark, 'suite')}/json"
    spark.createDataFrame([(json.dumps(SUITE_FILE, indent=1),)], "value string").coalesce(1).write.text(folder)
    return quality.read_suite(spark, folder)


@query
def dq_suite_from_file(spark, sf_dir):
    return quality.run_suite(given.flawed(spark, sf_dir), suite_from_file(spark))


@query
def dq_gate_outcome(spark, sf_dir):
    return quality.gate_outcome(quality.run_suite(given.flawed(spark, sf_dir), suite_from_file(spark)))


@query
def offending_values(spark, sf_dir):
    return quality.assert_between(given.flawed(spark, sf_dir), "clients_affected_pct", 0, 100)


@query
def null_severity(spark, sf_dir):
    return quality.assert_no_null(given.flawed(spark, sf_dir), "severity", ["incident_id"])


@query
def run_assertions(spark, sf_dir):
    rows = given.flawed(spark, sf_dir)
    log = auditing.audit(auditing.with_hash(rows), F.lit(given.PROCESSED_AT).cast("timestamp")).withColumn(
        "record_hash", F.when(F.col("incident_id").endswith("7"), "").otherwise(F.col("record_hash"))
    )
    return quality.run_assertions(rows, log, min_records=100)


# Loads


@dataclass
class Loaded:
    source: DataFrame
    path: str


def loaded_once(spark, sf_dir) -> Loaded:
    """A table holding the rows up to a time, but for some that arrive late."""
    source = given.classified(spark, sf_dir)
    path = f"{scratch_dir(spark, 'landed')}/table"
    early = source.filter(
        (F.col("incident_ts") <= F.lit(given.LOAD_UNTIL).cast("timestamp")) & (F.col("event_id") % 17 != 3)
    )
    tables.load_rows(early, path, "incidents_classified")
    return Loaded(source.select(*schemas.columns(schemas.CLASSIFIED)), path)


@query
def incremental_load(spark, sf_dir):
    once = loaded_once(spark, sf_dir)
    target = tables.read_rows(spark, once.path, "incidents_classified")
    mark = incremental.watermark(target, "incident_ts", "incident_day")
    tables.load_rows(incremental.newer_than(once.source, mark), once.path, "incidents_classified")
    return tables.read_rows(spark, once.path, "incidents_classified").select(
        "incident_id", "incident_ts", "severity"
    )


@query
def late_rows(spark, sf_dir):
    """Source and target both laid out by day."""
    once = loaded_once(spark, sf_dir)
    path = f"{scratch_dir(spark, 'source')}/table"
    tables.load_rows(once.source, path, "incidents_classified")
    source, target = (tables.read_rows(spark, p, "incidents_classified") for p in (path, once.path))
    return incremental.late_rows(source, target, day="incident_day").select("incident_id", "incident_ts", "severity")


@query
def serving_rows(spark, sf_dir):
    return incremental.serving_rows(given.classified(spark, sf_dir)).select(
        "incident_id", "affected_systems", "classification_reason"
    )


@query
def partitioned_scan(spark, sf_dir):
    path = f"{scratch_dir(spark, 'classified')}/table"
    tables.load_rows(given.classified(spark, sf_dir), path, "incidents_classified")
    return tables.read_rows(
        spark, path, "incidents_classified",
        since="2024-01-05 06:00:00", until="2024-01-15 18:30:00", tiers=["critical", "major"],
    ).select("incident_id", "incident_day", "severity")


@query
def declared_tables(spark, sf_dir):
    """Declare the tables twice, append to all three, count each by day."""
    location = scratch_dir(spark, "warehouse")
    database = "tw_" + location.rsplit("-", 1)[1]
    for _ in range(2):
        tables.create_tables(spark, database, location)
    rows = given.classified(spark, sf_dir)
    audited = auditing.audit(auditing.with_hash(rows), F.lit(given.PROCESSED_AT).cast("timestamp"))
    tables.append_to_table(given.incidents(spark, sf_dir), database, "incidents_raw")
    tables.append_to_table(rows, database, "incidents_classified")
    tables.append_to_table(audited, database, "audit_log")
    counts = [
        spark.table(f"{database}.{name}")
        .groupBy(F.col(tables.LAYOUT[name][1][0]).alias("day"))
        .agg(F.count(F.lit(1)).alias("stored"))
        .select(F.lit(name).alias("table_name"), F.col("day").cast("string").alias("day"), "stored")
        for name in tables.LAYOUT
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


STARTED = datetime(2024, 4, 10, tzinfo=timezone.utc)


def two_runs(spark, sf_dir, database: str | None = None):
    """The scheduled run on the rows up to a time, then again on all rows."""
    source = given.classified(spark, sf_dir).select(*schemas.columns(schemas.CLASSIFIED))
    paths = RunPaths(scratch_dir(spark, "runs"))
    vendors = given.vendors(spark, sf_dir)
    first = source.filter(F.col("incident_ts") <= F.lit(given.LOAD_UNTIL).cast("timestamp"))
    ends = iter((90, 420))

    def run(rows: DataFrame, run_id: str):
        """A run with a given start and end, so that its logged time is known."""
        return run_scheduled(
            spark, rows, vendors, paths, given.AS_OF, run_id, started=STARTED, database=database,
            clock=lambda: STARTED + timedelta(seconds=next(ends)),
        )

    run(first, "run-1")
    return run(source, "run-2"), paths


@query
def scheduled_report(spark, sf_dir):
    result, _ = two_runs(spark, sf_dir)
    return result.report


@query
def run_log(spark, sf_dir):
    _, paths = two_runs(spark, sf_dir)
    return read_run_log(spark, paths).select("run_id", "record_count", "loaded_count", "runtime_seconds")


@query
def scheduled_tables(spark, sf_dir):
    """The marts of two runs, read through the catalog."""
    database = "tw_" + scratch_dir(spark, "marts").rsplit("-", 1)[1]
    two_runs(spark, sf_dir, database)
    report = spark.table(f"{database}.regulatory_report")
    risk = spark.table(f"{database}.vendor_risk")
    breaches = spark.table(f"{database}.breach_register")
    return (
        report.select(F.lit("regulatory_report").alias("mart"), F.col("compliance_status").alias("kind"))
        .unionByName(risk.select(F.lit("vendor_risk").alias("mart"), F.col("concentration_risk_tier").alias("kind")))
        .unionByName(breaches.select(F.lit("breach_register").alias("mart"), F.col("severity").alias("kind")))
        .groupBy("mart", "kind").agg(F.count(F.lit(1)).alias("found"))
    )


# Marts from parts


def rolled_up(spark, sf_dir):
    """The parts of three loads, the first two folded into one, and of a load without newer rows."""
    source = given.classified(spark, sf_dir).select(*schemas.columns(schemas.CLASSIFIED))
    paths = RunPaths(scratch_dir(spark, "rolled"))
    for until in ("2024-01-08 12:00:00", given.LOAD_UNTIL, given.AS_OF, given.AS_OF):
        load_new(spark, source.filter(F.col("incident_ts") <= F.lit(until).cast("timestamp")), paths.landed)
        rolling.advance(spark, tables.read_rows(spark, paths.landed, "incidents_classified"), paths.parts)
        if until == given.LOAD_UNTIL:
            rolling.fold_parts(spark, paths.parts)
    return rolling.rolled_marts(spark, paths.parts, staged_vendors(spark, sf_dir), given.as_of())


@query
def rolled_report(spark, sf_dir):
    return rolled_up(spark, sf_dir)["regulatory_report"]


@query
def rolled_vendor_risk(spark, sf_dir):
    return rolled_up(spark, sf_dir)["vendor_risk"]


@query
def rolled_breaches(spark, sf_dir):
    return rolled_up(spark, sf_dir)["breach_register"]


# Event JSON


def parsed(spark, sf_dir):
    return event_json.parse(given.messages(spark, sf_dir), F.lit(given.PROCESSED_AT).cast("timestamp"))


def comparable(rows):
    """NaN has no equal, so it is shown as a flag."""
    eur = F.col("financial_impact_eur")
    return rows.withColumns(
        {"impact_is_nan": F.isnan(eur), "financial_impact_eur": F.when(F.isnan(eur), 0.0).otherwise(eur)}
    )


@query
def event_decode(spark, sf_dir):
    return comparable(event_json.good_rows(parsed(spark, sf_dir)))


@query
def event_quarantine(spark, sf_dir):
    return event_json.rejected_rows(parsed(spark, sf_dir)).groupBy("error_reason").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.length("value")).alias("characters")
    )


@query
def event_encode(spark, sf_dir):
    return event_json.encode(given.classified(spark, sf_dir))


@query
def enriched_messages(spark, sf_dir):
    hashed = auditing.with_hash(given.classified(spark, sf_dir)).withColumn(
        "processed_at", F.lit(given.PROCESSED_AT).cast("timestamp")
    )
    return event_json.enriched_messages(hashed, JobConfig().enriched_topic)


@query
def severity_routing(spark, sf_dir):
    return event_json.route(given.incidents(spark, sf_dir), TOPICS).groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("key").alias("institutions")
    )


# Summaries


@query
def batch_summary(spark, sf_dir):
    return summary.batch_summary(classify.classify(parsed(spark, sf_dir)))


@query
def smoke_summary(spark, sf_dir):
    rows = summary.since_start(given.flawed(spark, sf_dir), "2024-01-10 00:00:00", "incident_ts")
    return summary.run_summary(rows)


# Streams, each run until its input is used up

MESSAGES_A_FILE = 100_000
FILES_A_BATCH = 48


def streamed(spark, messages: DataFrame, dedup_within: str | None = None, replay: bool = False, packed: bool = False) -> str:
    root = scratch_dir(spark, "stream")
    if packed:
        # Packed files cannot be split, so they are short; a batch takes in some of them, and leaves its disk to the next.
        messages.write.option("maxRecordsPerFile", MESSAGES_A_FILE).text(f"{root}/input", compression="gzip")
    else:
        messages.write.text(f"{root}/input")
    source = external.text_stream(spark, f"{root}/input", FILES_A_BATCH if packed else None)
    # A second start from a new checkpoint delivers the same batches again.
    for attempt in range(2 if replay else 1):
        sinks = job.Sinks(f"{root}/tables", query_id="q1")
        job.start_stream(
            source, sinks, f"{root}/checkpoint-{attempt}", available_now=True, dedup_within=dedup_within
        ).awaitTermination()
    return f"{root}/tables"


@query
def stream_classify(spark, sf_dir):
    root = streamed(spark, given.messages(spark, sf_dir))
    return job.read_classified(spark, root).select(
        "incident_id", "severity", "notify_required", "notify_deadline_hours", "classification_reason"
    )


@query
def stream_replay(spark, sf_dir):
    """The same batches delivered twice leave each row once."""
    root = streamed(spark, given.messages(spark, sf_dir), replay=True)
    return job.read_classified(spark, root).groupBy("severity").agg(F.count(F.lit(1)).alias("stored"))


@query
def stream_dedup(spark, sf_dir):
    """Copies of events and events that amend others under the same id: every distinct event stays once."""
    root = streamed(spark, given.copied_messages(spark, sf_dir), dedup_within="1 hour", packed=True)
    return job.read_classified(spark, root).select("incident_id", "clients_affected_pct", "severity")


@query
def stream_folded(spark, sf_dir):
    """Two folds of the batches of a stream, the second run twice."""
    root = streamed(spark, given.messages(spark, sf_dir))
    landed = f"{root}/landed"
    for until in (0, 1_000, 1_000):
        fold.fold_batches(spark, root, landed, "q1", until)
    rows = fold.read_folded(spark, landed, "q1")
    return rows.groupBy(F.col("incident_day").cast("string").alias("day"), "severity").agg(F.count(F.lit(1)).alias("stored"))


@query
def stream_audit(spark, sf_dir):
    root = streamed(spark, given.messages(spark, sf_dir))
    return job.read_audit(spark, root).select(
        "incident_id", "pipeline_version", "classifier_version", "record_hash"
    )


@query
def stream_landing(spark, sf_dir):
    root = streamed(spark, given.messages(spark, sf_dir))
    return job.read_raw(spark, root).select("incident_id", "incident_ts", "severity", "incident_day")


@query
def stream_batch_log(spark, sf_dir):
    root = streamed(spark, given.messages(spark, sf_dir))
    return job.read_batch_log(spark, root).agg(
        *[F.sum(name).alias(name) for name in schemas.columns(schemas.BATCH_LOG) if name != "batch_id"]
    )
