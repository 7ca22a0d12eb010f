"""Declarative data checks, evaluated in one pass over each table."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden import schemas
from tidewarden.config import COMPLIANCE_STATUSES, CONCENTRATION_TIERS, TIERS, WireNames

Check = dict[str, Any]

INCIDENT_SUITE: list[Check] = [
    *[{"check": "column_exists", "column": name} for name in schemas.columns(schemas.INCIDENT)],
    *[
        {"check": "not_null", "column": name}
        for name in ("incident_id", "incident_ts", "severity", "institution_id")
    ],
    {"check": "in_set", "column": "severity", "values": list(TIERS)},
    {"check": "between", "column": "clients_affected_pct", "min": 0.0, "max": 100.0},
    {"check": "between", "column": "financial_impact_eur", "min": 0.0, "max": None},
    {"check": "in_set", "column": "notify_required", "values": [True], "where": "severity = 'critical'"},
    {"check": "row_count", "min": 1, "max": None},
]

# Public names of the expectations a suite file may use.
EXPECTATIONS = {
    "expect_column_to_exist": "column_exists",
    "expect_column_values_to_not_be_null": "not_null",
    "expect_column_values_to_be_in_set": "in_set",
    "expect_column_values_to_be_between": "between",
    "expect_table_row_count_to_be_between": "row_count",
}

RESULT_SCHEMA = (
    "check_id int, check string, column string, success boolean, evaluated bigint, unexpected bigint"
)


# Public names of the arguments a suite file may give; the rest of an entry says nothing about the data.
ARGUMENTS = frozenset({"column", "value_set", "min_value", "max_value", "row_condition", "condition_parser"})
ENTRY_KEYS = frozenset({"expectation_type", "kwargs", "meta", "notes", "ge_cloud_id"})

# A quoted text, or an identifier with or without back quotes.
_WORD_OR_TEXT = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]+`|[A-Za-z_][A-Za-z_0-9]*")


def _renamed(condition: str, column_of: Mapping[str, str]) -> str:
    """The condition with JSON keys replaced by their columns: whole identifiers only, texts left alone."""

    def name(found: re.Match[str]) -> str:
        word = found.group()
        bare = word.strip("`")
        return column_of.get(bare, bare) if word[0] == "`" or word[0] not in "'\"" and bare in column_of else word

    return _WORD_OR_TEXT.sub(name, condition)


def read_suite(spark: SparkSession, path: str, names: WireNames = WireNames()) -> list[Check]:
    """The suite of a JSON file on any file system Spark reads."""
    return load_suite(spark.read.text(path, wholetext=True).first()["value"], names)


def load_suite(text: str, names: WireNames = WireNames()) -> list[Check]:
    """Read a suite from JSON: a list of checks, or an object with `expectations`.

    Columns may be given by their JSON key; `row_condition` must be a condition Spark SQL reads. An argument that is
    not supported is an error: without it the check would mean something else.
    """
    column_of = {key: column for column, key in names.pairs()}
    raw = json.loads(text)
    if isinstance(raw, list):
        return raw
    suite = []
    for entry in raw["expectations"]:
        given = entry.get("kwargs", {})
        unknown = sorted((set(given) - ARGUMENTS) | (set(entry) - ENTRY_KEYS))
        if unknown:
            raise ValueError(f"not supported in {entry['expectation_type']}: {', '.join(unknown)}")
        check: Check = {"check": EXPECTATIONS[entry["expectation_type"]]}
        if "column" in given:
            check["column"] = column_of.get(given["column"], given["column"])
        if "value_set" in given:
            check["values"] = given["value_set"]
        if "row_condition" in given:
            check["where"] = _renamed(given["row_condition"], column_of)
        if check["check"] in ("between", "row_count"):
            check |= {"min": given.get("min_value"), "max": given.get("max_value")}
        suite.append(check)
    return suite


def _outside(value: Column, low: float | None, high: float | None) -> Column:
    outside = F.lit(False)
    if low is not None:
        outside = outside | (value < F.lit(low))
    if high is not None:
        outside = outside | (value > F.lit(high))
    return outside


def _present(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if dict(df.dtypes)[name] in ("double", "float"):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def _counts(df: DataFrame, check: Check) -> tuple[Column, Column]:
    """(rows evaluated, rows unexpected) of a check, as aggregates."""
    kind, name = check["check"], check.get("column")
    if kind == "row_count":
        rows = F.count(F.lit(1))
        return rows, _outside(rows, check.get("min"), check.get("max")).cast("bigint")
    if kind == "column_exists":
        return F.lit(0).cast("bigint"), F.lit(0 if name in df.columns else 1).cast("bigint")
    if name not in df.columns:
        return F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
    scope = F.expr(check["where"]) if check.get("where") else F.lit(True)
    value = F.col(name)
    if kind == "not_null":
        return F.count_if(scope), F.count_if(scope & value.isNull())
    present = _present(df, name)
    if kind == "not_empty":
        return F.count_if(scope), F.count_if(scope & F.coalesce(value == "", F.lit(True)))
    if kind == "is_true":
        return F.count_if(scope), F.count_if(scope & ~F.coalesce(value, F.lit(False)))
    if kind == "in_set":
        bad = ~value.isin(*check["values"])
    elif kind == "between":
        bad = _outside(value, check.get("min"), check.get("max"))
    else:
        raise ValueError(f"unknown check: {kind}")
    return F.count_if(scope & present), F.count_if(scope & present & bad)


def run_suite(df: DataFrame, suite: Sequence[Check] = INCIDENT_SUITE) -> DataFrame:
    """One row per check: success, rows evaluated, rows unexpected. Nulls pass all but null checks.

    A check on a column that is not there fails. The table is read once, whatever the suite's length.
    """
    aggregates: list[Column] = []
    for n, check in enumerate(suite):
        evaluated, unexpected = _counts(df, check)
        aggregates += [evaluated.alias(f"e{n}"), unexpected.alias(f"u{n}")]
    # A suite of existence checks alone has no aggregate of its own; the row count makes it one.
    totals = df.agg(F.count(F.lit(1)).alias("row_total"), *aggregates)
    rows = [
        F.struct(
            F.lit(n + 1).alias("check_id"),
            F.lit(check["check"]).alias("check"),
            F.lit(check.get("column")).cast("string").alias("column"),
            F.coalesce(F.col(f"u{n}") == 0, F.lit(False)).alias("success"),
            F.col(f"e{n}").alias("evaluated"),
            F.col(f"u{n}").alias("unexpected"),
        )
        for n, check in enumerate(suite)
    ]
    return totals.select(F.inline(F.array(*rows)))


class QualityGateError(RuntimeError):
    """Raised when a suite has failed checks."""


def gate(results: DataFrame) -> None:
    """Raise if any check failed. Reads one row per check, never table rows."""
    failed = results.filter(~F.col("success")).orderBy("check_id").collect()
    if failed:
        shown = "; ".join(f"{r['check']}({r['column']}): {r['unexpected']}" for r in failed)
        raise QualityGateError(f"{len(failed)} checks failed: {shown}")


def gate_outcome(results: DataFrame) -> DataFrame:
    """The gate's decision as rows: one with `stop` or `go` and the number of failed checks, then each failed check."""
    failed = ~F.col("success")
    decision = F.when(F.count_if(failed) > 0, "stop").otherwise("go")
    verdict = results.agg(decision.alias("decision"), F.count_if(failed).alias("failed")).select(
        "decision", "failed", F.lit(None).cast("int").alias("check_id"), F.lit(None).cast("string").alias("check"),
        F.lit(None).cast("string").alias("column"), F.lit(None).cast("bigint").alias("unexpected"),
    )
    each = results.filter(failed).select(
        F.lit("stop").alias("decision"), F.lit(None).cast("bigint").alias("failed"), "check_id", "check", "column", "unexpected"
    )
    return verdict.unionByName(each)


def totals(results: DataFrame) -> DataFrame:
    """Number of checks, passed and failed, and the overall outcome."""
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"),
    )


def assert_between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """The non-null values of a column outside the inclusive range."""
    value = F.col(column)
    return df.filter(value.isNotNull() & _outside(value, low, high)).select(value.alias("offending_value"))


def assert_no_null(df: DataFrame, column: str, shown: Sequence[str]) -> DataFrame:
    """The rows whose column is null."""
    return df.filter(F.col(column).isNull()).select(*shown, column)


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, nulls aside."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values of the child column that the parent lacks, with their number of rows; nulls aside."""
    used = (
        child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("copies"))
    )
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return used.join(known, column, "left_anti")


def _as_failures(results: DataFrame, model: str) -> DataFrame:
    return results.select(
        F.lit(model).alias("model"),
        F.col("check").alias("test"),
        "column",
        F.coalesce("unexpected", F.lit(1)).alias("failures"),
    )


def _one_failure(violations: DataFrame, model: str, test: str, column: str, count: Column) -> DataFrame:
    return violations.agg(F.coalesce(count, F.lit(0)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(column).alias("column"), "failures"
    )


MODEL_CHECKS: dict[str, list[Check]] = {
    "stg_incidents": [
        {"check": "not_null", "column": "incident_sk"},
        {"check": "not_null", "column": "incident_id"},
        {"check": "not_null", "column": "incident_ts"},
        {"check": "not_null", "column": "severity"},
        {"check": "in_set", "column": "severity", "values": list(TIERS)},
    ],
    "stg_vendors": [{"check": "not_null", "column": "vendor_name"}],
    "derived": [
        {"check": "not_null", "column": "incident_sk"},
        {"check": "not_null", "column": "incident_id"},
    ],
    "regulatory_report": [
        {"check": "between", "column": "compliance_rate_pct", "min": 0, "max": 100},
        {"check": "in_set", "column": "compliance_status", "values": list(COMPLIANCE_STATUSES)},
    ],
    "vendor_risk": [
        {"check": "not_null", "column": "ict_third_party_provider"},
        {"check": "in_set", "column": "concentration_risk_tier", "values": list(CONCENTRATION_TIERS)},
    ],
    "breach_register": [{"check": "not_null", "column": "incident_id"}],
}


def model_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    """One row per model test: model, test, column, failures, passed.

    `models` maps each name of MODEL_CHECKS to its frame, best a stored one: each is read once for its column checks,
    and the columns of the two providers' tests once more. Providers of incidents and names of vendors meet in one
    grouping, which shows both the names that occur twice and the providers that no vendor has.
    """
    parts = [_as_failures(run_suite(models[name], checks), name) for name, checks in MODEL_CHECKS.items()]
    parts.append(
        _one_failure(
            duplicates(models["vendor_risk"], "ict_third_party_provider"),
            "vendor_risk", "unique", "ict_third_party_provider", F.count(F.lit(1)),
        )
    )
    sides = (
        models["stg_incidents"].select(F.col("ict_third_party_provider").alias("name"), F.lit(0).alias("listed"))
        .unionByName(models["stg_vendors"].select(F.col("vendor_name").alias("name"), F.lit(1).alias("listed")))
        .filter("name is not null")
    )
    met = sides.groupBy("name").agg(F.sum("listed").alias("listed"), F.count_if(F.col("listed") == 0).alias("used"))
    both = met.agg(
        F.count_if(F.col("listed") > 1).alias("twice"), F.coalesce(F.sum(F.when(F.col("listed") == 0, F.col("used"))), F.lit(0)).alias("lost")
    )
    shown = F.array(
        *[
            F.struct(F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(column).alias("column"), F.col(n).alias("failures"))
            for model, test, column, n in (
                ("stg_vendors", "unique", "vendor_name", "twice"),
                ("stg_incidents", "relationship", "ict_third_party_provider", "lost"),
            )
        ]
    )
    parts.append(both.select(F.inline(shown)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("passed", F.col("failures") == 0)


def run_assertions(classified: DataFrame, audit_log: DataFrame, min_records: int) -> DataFrame:
    """The four checks after a run; unlike the suite, a critical row with a null flag fails."""
    stored = run_suite(
        classified,
        [
            {"check": "row_count", "min": min_records},
            {"check": "not_null", "column": "severity"},
            {"check": "is_true", "column": "notify_required", "where": "severity = 'critical'"},
        ],
    )
    audited = run_suite(
        audit_log, [{"check": "row_count", "min": 1}, {"check": "not_empty", "column": "record_hash"}]
    ).agg(
        F.lit(4).alias("check_id"),
        F.lit("audit_hash").alias("check"),
        F.lit("record_hash").alias("column"),
        F.bool_and("success").alias("success"),
        F.max("evaluated").alias("evaluated"),
        F.sum("unexpected").alias("unexpected"),
    )
    return stored.unionByName(audited)
