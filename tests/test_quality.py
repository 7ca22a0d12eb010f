import json

import pytest
from pyspark.sql import functions as F

from tests.frames import incidents, plan_of, vendors
from tidewarden import schemas
from tidewarden.operators import audit, classify, deadlines, marts, quality, staging
from tidewarden.sources import tables


def classified(spark, *changes):
    return classify.add_reason(classify.classify(incidents(spark, *changes)))


def outcome(results):
    return {(r["check"], r["column"]): (r["success"], r["evaluated"], r["unexpected"]) for r in results.collect()}


def test_clean_rows_pass_all_checks(spark):
    results = quality.run_suite(classified(spark, {}, {"clients_affected_pct": 100.0}, {"financial_impact_eur": 0.0}))
    assert results.count() == 24
    assert results.filter("not success").count() == 0
    quality.gate(results)
    assert tuple(quality.totals(results).first()) == (24, 24, 0, True)


def test_violations_are_counted_and_nulls_pass(spark):
    rows = classified(
        spark,
        {"clients_affected_pct": 100.01},
        {"clients_affected_pct": -0.01},
        {"clients_affected_pct": float("nan")},
        {"clients_affected_pct": None, "financial_impact_eur": -1.0},
        {"institution_id": None},
        {"clients_affected_pct": 40.0},
    ).withColumn(
        "notify_required", F.when(F.col("clients_affected_pct") > 100, False).when(F.col("clients_affected_pct") != 40.0, F.col("notify_required"))
    ).withColumn("severity", F.when(F.col("financial_impact_eur") < 0, "severe").when(F.col("institution_id").isNotNull(), F.col("severity")))
    got = outcome(quality.run_suite(rows))
    assert got[("between", "clients_affected_pct")] == (False, 4, 2)
    assert got[("between", "financial_impact_eur")] == (False, 6, 1)
    assert got[("not_null", "institution_id")] == (False, 6, 1)
    assert got[("not_null", "severity")] == (False, 6, 1)
    assert got[("in_set", "severity")] == (False, 5, 1)
    # Of the critical rows (NaN meets no threshold) one has the flag unset, which passes, and one a false flag.
    assert got[("in_set", "notify_required")] == (False, 1, 1)
    with pytest.raises(quality.QualityGateError, match="checks failed"):
        quality.gate(quality.run_suite(rows))


def test_empty_table_and_missing_column(spark):
    got = outcome(quality.run_suite(classified(spark, {}).limit(0)))
    assert got[("row_count", None)] == (False, 0, 1)
    assert got[("not_null", "severity")] == (True, 0, 0)
    got = outcome(quality.run_suite(classified(spark, {}).drop("severity", "institution_id"), quality.INCIDENT_SUITE[:20]))
    assert got[("column_exists", "severity")] == (False, 0, 1)
    assert got[("column_exists", "incident_id")] == (True, 0, 0)
    assert got[("not_null", "institution_id")] == (False, None, None)


def test_one_scan_for_the_whole_suite(spark, tmp_path):
    classified(spark, {}).write.parquet(str(tmp_path / "t"))
    plan = plan_of(quality.run_suite(spark.read.parquet(str(tmp_path / "t"))))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


SUITE = {
    "expectation_suite_name": "incidents",
    "expectations": [
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "timestamp"}},
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "clients_affected_pct", "min_value": 0, "max_value": 3}},
        {
            "expectation_type": "expect_column_values_to_be_in_set",
            "kwargs": {"column": "notify_required", "value_set": [True], "row_condition": 'severity=="critical"'},
        },
        {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1, "max_value": 2}},
    ],
}


def test_suite_from_json(spark):
    suite = quality.load_suite(json.dumps(SUITE))
    got = outcome(quality.run_suite(classified(spark, {"clients_affected_pct": 30.0}, {}, {}), suite))
    assert got == {
        ("column_exists", "incident_ts"): (True, 0, 0),
        ("between", "clients_affected_pct"): (False, 3, 1),
        ("in_set", "notify_required"): (True, 1, 0),
        ("row_count", None): (False, 3, 1),
    }
    assert quality.load_suite(json.dumps(quality.INCIDENT_SUITE)) == quality.INCIDENT_SUITE


def test_conditions_are_renamed_by_whole_names():
    condition = "detection_timestamp > timestamp and `timestamp` is not null and incident_type <> 'timestamp'"
    entry = {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "timestamp", "row_condition": condition}}
    check, = quality.load_suite(json.dumps({"expectations": [entry]}))
    assert check == {
        "check": "not_null", "column": "incident_ts",
        "where": "detection_timestamp > incident_ts and incident_ts is not null and incident_type <> 'timestamp'",
    }


@pytest.mark.parametrize("kwargs", [{"mostly": 0.9}, {"strict_min": True}])
def test_arguments_that_are_not_supported_are_errors(kwargs):
    entry = {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "severity"} | kwargs}
    with pytest.raises(ValueError, match=next(iter(kwargs))):
        quality.load_suite(json.dumps({"expectations": [entry]}))


def test_suite_file_and_gate_outcome(spark, tmp_path):
    (tmp_path / "suite.json").write_text(json.dumps(SUITE, indent=2))
    rows = classified(spark, {"clients_affected_pct": 30.0}, {}, {})
    results = quality.run_suite(rows, quality.read_suite(spark, str(tmp_path / "suite.json")))
    outcome_rows = quality.gate_outcome(results).orderBy("check_id").collect()
    assert [(r["decision"], r["failed"], r["check"]) for r in outcome_rows] == [("stop", 2, None), ("stop", None, "between"), ("stop", None, "row_count")]
    with pytest.raises(quality.QualityGateError):
        quality.gate(results)
    good = quality.gate_outcome(results.filter("success")).collect()
    assert [(r["decision"], r["failed"]) for r in good] == [("go", 0)]


def test_stored_models_are_read_once_for_their_checks(spark, tmp_path):
    rows = staging.stage_incidents(classified(spark, {}, {}))
    names = spark.createDataFrame([("AWS", "cloud", False, True, 5), ("AWS", "cloud", False, True, 5)], schemas.VENDOR)
    derived = deadlines.derive(rows, staging.stage_vendors(names), F.lit("2026-06-10").cast("timestamp"))
    now = F.lit("2026-06-10").cast("timestamp")
    models = {
        "stg_incidents": rows, "stg_vendors": staging.stage_vendors(names), "derived": derived,
        "regulatory_report": marts.regulatory_report(derived), "vendor_risk": marts.vendor_risk(derived, now),
        "breach_register": marts.breach_register(derived),
    }
    stored = {k: tables.materialise(v, f"{tmp_path}/{k}") for k, v in models.items()}
    plan = plan_of(quality.model_tests(stored))
    assert plan.count("FileScan") <= len(models) + 3


def test_assertions_after_a_run(spark):
    rows = classified(spark, {"clients_affected_pct": 30.0}, {"clients_affected_pct": 31.0}, {})
    log = audit.audit(audit.with_hash(rows), F.lit("2026-01-01").cast("timestamp"))
    good = quality.run_assertions(rows, log, 3)
    assert [r["success"] for r in good.orderBy("check_id").collect()] == [True] * 4
    unset = rows.withColumn("notify_required", F.when(F.col("clients_affected_pct") == 30.0, True))
    got = quality.run_assertions(unset, log.withColumn("record_hash", F.lit("")), 4).orderBy("check_id").collect()
    assert [(r["success"], r["unexpected"]) for r in got] == [(False, 1), (True, 0), (False, 1), (False, 3)]
    nothing = quality.run_assertions(rows, log.limit(0), 3).filter("check_id = 4").first()
    assert nothing["success"] is False


def test_generic_checks(spark):
    rows = classified(spark, {"clients_affected_pct": -1.0}, {"clients_affected_pct": 0.0}, {"clients_affected_pct": None})
    assert [r[0] for r in quality.assert_between(rows, "clients_affected_pct", 0, 100).collect()] == [-1.0]
    assert quality.assert_no_null(rows, "clients_affected_pct", ["incident_id"]).count() == 1
    names = vendors(spark, ("a", None, None, None, None), ("a", None, None, None, None), (None, None, None, None, None))
    assert [tuple(r) for r in quality.duplicates(names, "vendor_name").collect()] == [("a", 2)]


def test_tampering_is_found(spark):
    rows = classified(spark, {}, {}, {}, {})
    log = audit.audit(audit.with_hash(rows), F.lit("2026-01-01").cast("timestamp"))
    number = F.substring("incident_id", -1, 1)
    stored = rows.filter(number != "3").withColumn("institution_id", F.when(number == "1", "other").otherwise(F.col("institution_id")))
    # A row stored twice and audited twice agrees; so does a row whose audit record was repeated.
    stored = stored.unionByName(rows.filter(number == "0"))
    records = log.filter(number != "2").unionByName(log.filter(number == "0"))
    got = {r["incident_id"][-1]: (r["status"], r["unmatched_rows"]) for r in audit.verify(stored, records).collect()}
    assert got == {"1": ("altered", 1), "2": ("unaudited", 1), "3": ("missing", 0)}
    assert "Join" not in plan_of(audit.verify(stored, records))
