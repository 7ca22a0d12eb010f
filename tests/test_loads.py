from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.frames import incidents, plan_of, vendors
from tidewarden import JobConfig, schemas
from tidewarden.functions.session import fresh_dir, path_exists, scratch_dir, shared_root
from tidewarden.operators import classify, incremental, quality
from tidewarden.plans.scheduled import RunPaths, now, read_run_log, run_scheduled
from tidewarden.sources import tables

DAY = datetime(2026, 6, 1, tzinfo=timezone.utc)
TABLE = "incidents_classified"


def rows(spark, *offsets_hours, **change):
    changes = [{"incident_ts": DAY + timedelta(hours=h), "incident_id": f"id-{h}"} | change for h in offsets_hours]
    return classify.add_reason(classify.classify(incidents(spark, *changes)))


def ids(df):
    return sorted(int(r["incident_id"][3:]) for r in df.select("incident_id").collect())


def test_watermark_is_strict(spark):
    source = rows(spark, 0, 1, 2, 3)
    assert ids(incremental.incremental(source, rows(spark, 1))) == [2, 3]
    assert ids(incremental.incremental(source, source.limit(0))) == [0, 1, 2, 3]
    assert ids(incremental.incremental(source, None)) == [0, 1, 2, 3]


def test_load_and_watermark_from_the_last_day(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.load_rows(rows(spark, 0, 30, 50), path, TABLE)
    target = tables.read_rows(spark, path, TABLE)
    assert incremental.watermark(target, "incident_ts", "incident_day") == datetime(2026, 6, 3, 2)
    tables.load_rows(incremental.incremental(rows(spark, 40, 50, 51), target), path, TABLE)
    assert ids(tables.read_rows(spark, path, TABLE)) == [0, 30, 50, 51]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_late_rows(spark, limit):
    source = rows(spark, 0, 1, 2, 3, 4).unionByName(rows(spark, 1)).withColumn(
        "incident_id", F.when(F.col("incident_id") == "id-0", F.lit(None)).otherwise(F.col("incident_id"))
    )
    late = incremental.late_rows(source, rows(spark, 2, 3), limit=limit)
    assert sorted(r["incident_id"] or "" for r in late.collect()) == ["", "id-1", "id-1"]
    assert late.columns == source.columns
    assert incremental.late_rows(source, rows(spark, 2).limit(0)).count() == 0


def test_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_rows(rows(spark, 0, 25, 49, 73), path, TABLE, "overwrite")
    found = tables.read_rows(
        spark, path, TABLE, since="2026-06-02 00:00:00", until="2026-06-03 01:00:00", tiers=["minor"]
    )
    assert ids(found) == [25]
    plan = plan_of(found)
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "incident_day" in partition_filters and "severity" in partition_filters
    assert "GreaterThanOrEqual(incident_ts" in plan
    assert plan.count("incident_day=") <= 2
    few = plan_of(found.select("incident_id"))
    assert "financial_impact_eur" not in few.split("ReadSchema")[1]


def test_newest_day_comes_from_the_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.newest_day(spark, path, "incidents_classified") is None
    for name in ("incident_day=2026-06-09", "incident_day=2026-06-10", "incident_day=__HIVE_DEFAULT_PARTITION__", "_SUCCESS"):
        (tmp_path / "t" / name).mkdir(parents=True)
    assert tables.newest_day(spark, path, "incidents_classified") == "2026-06-10"


def test_missing_path(spark, tmp_path):
    assert not path_exists(spark, str(tmp_path / "none"))


def test_tables_are_declared_once(spark, tmp_path):
    for _ in range(2):
        tables.create_tables(spark, "tw_test", str(tmp_path))
    tables.append_to_table(rows(spark, 0, 30), "tw_test", TABLE)
    tables.create_tables(spark, "tw_test", str(tmp_path))
    stored = spark.table(f"tw_test.{TABLE}")
    assert ids(stored) == [0, 30]
    assert {f.name for f in stored.schema.fields} == set(schemas.columns(schemas.CLASSIFIED)) | {"incident_day"}
    assert ids(stored.filter("incident_day = date'2026-06-02' and severity = 'minor'")) == [30]
    spark.sql("DROP DATABASE tw_test CASCADE")


def test_serving_rows(spark):
    assert incremental.serving_rows(rows(spark, 0, affected_systems=["a", 'b"'])).first()["affected_systems"] == '["a", "b\\""]'


def test_scheduled_run(spark, tmp_path):
    paths = RunPaths(str(tmp_path))
    names = vendors(spark, ("AWS", "cloud", False, True, 5))
    source = rows(spark, 0, 1, 2, 3, clients_affected_pct=30.0, ict_third_party_provider="AWS")
    as_of = "2026-06-10 00:00:00"
    first = run_scheduled(spark, source.filter("incident_id <= 'id-1'"), names, paths, as_of, "r1")
    assert (first.loaded_count, first.report.first()["incident_count_total"]) == (2, 2)
    second = run_scheduled(spark, source, names, paths, as_of, "r2", started=now() - timedelta(hours=1))
    assert (second.loaded_count, second.report.first()["incident_count_total"]) == (2, 4)
    assert second.alerts.first()["compliance_rate_pct"] == 0.0
    assert second.vendor_risk.first()["concentration_risk_tier"] == "HIGH"
    assert second.breaches.filter("sla_breached").count() == 4
    assert spark.sql("SELECT sum(incident_count_total) FROM regulatory_report").first()[0] == 4
    assert spark.table("incidents_derived").count() == 4
    third = run_scheduled(spark, source, names, paths, as_of, "r3")
    assert third.loaded_count == 0
    log = {r["run_id"]: r for r in read_run_log(spark, paths).collect()}
    assert {k: (r["record_count"], r["loaded_count"]) for k, r in log.items()} == {"r1": (2, 2), "r2": (4, 2), "r3": (4, 0)}
    assert 0 < log["r1"]["runtime_seconds"] < 600 and 3600 < log["r2"]["runtime_seconds"] < 4200


def test_a_failed_check_stops_the_run(spark, tmp_path):
    paths = RunPaths(str(tmp_path))
    bad = rows(spark, 0, financial_impact_eur=-5.0)
    with pytest.raises(quality.QualityGateError):
        run_scheduled(spark, bad, vendors(spark), paths, "2026-06-10 00:00:00", "r1")
    assert path_exists(spark, paths.landed)
    assert not path_exists(spark, paths.mart("regulatory_report"))


def test_marts_as_tables(spark, tmp_path):
    paths = RunPaths(str(tmp_path))
    source = rows(spark, 0, 1, clients_affected_pct=30.0, ict_third_party_provider="AWS")
    for run in ("r1", "r2"):
        run_scheduled(spark, source, vendors(spark, ("AWS", "cloud", False, True, 5)), paths, "2026-06-10 00:00:00", run, database="tw_marts")
    assert {t.name for t in spark.catalog.listTables("tw_marts")} >= {"regulatory_report", "vendor_risk", "breach_register"}
    assert spark.table("tw_marts.breach_register").count() == 2
    spark.sql("DROP DATABASE tw_marts CASCADE")


def test_late_rows_read_no_later_day(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    tables.write_rows(rows(spark, 0, 1, 30, 80), source, TABLE, "overwrite")
    tables.write_rows(rows(spark, 1, 30), target, TABLE, "overwrite")
    read = [tables.read_rows(spark, p, TABLE) for p in (source, target)]
    late = incremental.late_rows(*read, day="incident_day")
    assert ids(late) == [0]
    filters = [part.split("]")[0] for part in plan_of(late).split("PartitionFilters: [")[1:]]
    assert any("incident_day" in f for f in filters)


def test_scratch_folders_are_marked_for_removal(spark):
    path = scratch_dir(spark, "mark")
    assert path_exists(spark, path) and "/mark-" in path


def test_shared_folder_is_the_one_the_session_names(spark, tmp_path):
    class Named:
        """A session whose cluster names a folder."""

        class conf:
            @staticmethod
            def get(name, default=None):
                return {"spark.checkpoint.dir": f"{tmp_path}/"}.get(name, default)

        sparkContext = spark.sparkContext

    assert shared_root(Named) == str(tmp_path)
    assert fresh_dir(Named, "x").startswith(f"{tmp_path}/x-")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_settings_from_the_environment():
    config = JobConfig.from_env({"KAFKA_TOPIC_MAJOR": "m", "KAFKA_BROKER": "b:1", "TRIGGER_SECONDS": "3"})
    assert config.source_topics == "incidents.critical,m,incidents.minor"
    assert (config.brokers, config.trigger_seconds, config.enriched_topic) == ("b:1", 3, "incidents.enriched")
