"""Marts from parts against the marts of the whole table, load by load, and runs that were cut off."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.frames import BASE, incidents, plan_of, vendors
from tidewarden.operators import classify, marts, rollup
from tidewarden.operators.deadlines import derive
from tidewarden.operators.staging import stage_incidents, stage_vendors
from tidewarden.plans import rolling
from tidewarden.plans.scheduled import RunPaths, load_new, run_scheduled
from tidewarden.sources import tables

AS_OF = "2026-06-10 12:34:56"


def as_of(text=AS_OF):
    return F.lit(text).cast("timestamp")


def rows(spark, seed=0, n=120, start=0):
    """Incidents over four months, ascending in time, with every value that the marts treat on its own."""
    rng = random.Random(seed)
    changes = []
    for k in range(n):
        detected = BASE["detection_timestamp"] - timedelta(days=100 - (start + k) // 2, seconds=rng.randrange(3600))
        changes.append(
            {
                "incident_id": f"id-{start + k:05d}",
                "incident_ts": BASE["incident_ts"] - timedelta(days=100) + timedelta(hours=12 * (start + k)),
                "institution_id": rng.choice(["A", "B", "C", "D", None]),
                "institution_type": rng.choice(["bank", "insurer"]),
                "clients_affected_pct": rng.choice([1.0, 12.0, 30.0]),
                "financial_impact_eur": rng.choice([0.005, 1234.565, 99999.99, 2e6, 1e13, float("nan"), float("inf")][: rng.choice([4, 4, 4, 7])]),
                "detection_timestamp": detected,
                "containment_timestamp": rng.choice([None, detected + timedelta(seconds=rng.randrange(400_000))]),
                "ict_third_party_provider": rng.choice([None, "AWS", "AWS", "Nobody", "Murex", ""]),
            }
        )
    return classify.add_reason(classify.classify(incidents(spark, *changes)))


def names(spark):
    return stage_vendors(vendors(spark, ("AWS", "cloud", False, True, 5), ("Murex", "saas", True, False, 2), ("unused", None, None, None, None)))


def shown(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


def whole(spark, landed, at):
    derived = derive(stage_incidents(landed), names(spark), at)
    return {"regulatory_report": marts.regulatory_report(derived), "vendor_risk": marts.vendor_risk(derived, at), "breach_register": marts.breach_register(derived)}


def landed(spark, paths):
    return tables.read_rows(spark, paths.landed, "incidents_classified")


@pytest.mark.parametrize("fold_after", [(), (0, 1, 3)])
def test_marts_equal_those_of_the_whole_table(spark, tmp_path, fold_after):
    paths = RunPaths(str(tmp_path))
    source = rows(spark, n=160).cache()
    for load, until in enumerate(("id-00003", "id-00070", "id-00070", "id-00159")):
        load_new(spark, source.filter(F.col("incident_id") <= until), paths.landed)
        assert rolling.advance(spark, landed(spark, paths), paths.parts) == (0, 1, 1, 2)[load]
        if load in fold_after:
            assert len(rolling.fold_parts(spark, paths.parts)) == 1
        for at in (as_of(), as_of("2026-04-20 00:00:00"))[: load - 1]:
            want, got = whole(spark, landed(spark, paths), at), rolling.rolled_marts(spark, paths.parts, names(spark), at)
            for name, frame in want.items():
                assert shown(got[name]) == shown(frame), name
                assert dict(got[name].dtypes) == dict(frame.dtypes)
    assert len(rolling.spans(spark, paths.parts)) == (1 if fold_after else 3)


def test_an_unlogged_load_is_not_read_and_written_again(spark, tmp_path):
    paths = RunPaths(str(tmp_path))
    source = rows(spark, n=40)
    load_new(spark, source.filter("incident_id < 'id-00020'"), paths.landed)
    rolling.advance(spark, landed(spark, paths), paths.parts)
    # A load that was cut off after its first folder: rows that are in no mart.
    rollup.report_parts(stage_incidents(source)).write.parquet(f"{paths.parts}/report/span=1-1")
    before = shown(rolling.rolled_marts(spark, paths.parts, names(spark), as_of())["regulatory_report"])
    assert before == shown(whole(spark, landed(spark, paths), as_of())["regulatory_report"])
    load_new(spark, source, paths.landed)
    assert rolling.advance(spark, landed(spark, paths), paths.parts) == 1
    after = rolling.rolled_marts(spark, paths.parts, names(spark), as_of())["regulatory_report"]
    assert shown(after) == shown(whole(spark, landed(spark, paths), as_of())["regulatory_report"])
    # The same for a fold that was not logged.
    rollup.report_parts(stage_incidents(source)).write.parquet(f"{paths.parts}/report/span=0-1")
    assert shown(after) == shown(rolling.rolled_marts(spark, paths.parts, names(spark), as_of())["regulatory_report"])
    rolling.fold_parts(spark, paths.parts)
    assert [s.name for s in rolling.spans(spark, paths.parts)] == ["0-1"]
    assert shown(rolling.rolled_marts(spark, paths.parts, names(spark), as_of())["regulatory_report"]) == shown(after)


def test_a_load_reads_only_its_days(spark, tmp_path):
    paths = RunPaths(str(tmp_path))
    source = rows(spark, n=40)
    load_new(spark, source.filter("incident_id < 'id-00030'"), paths.landed)
    assert rolling.advance(spark, landed(spark, paths), paths.parts) == 0
    # Days before the newest event time in the table, and in parts, are not read any more.
    first_day = sorted((tmp_path / "incidents_classified").glob("incident_day=*"))[0]
    for file in first_day.rglob("*.parquet"):
        file.write_bytes(b"not parquet")
    assert load_new(spark, source, paths.landed) == 10
    assert rolling.advance(spark, landed(spark, paths), paths.parts) == 1


def test_nothing_landed(spark, tmp_path):
    empty = tables.with_partition_days(rows(spark, n=1).limit(0), "incidents_classified")
    assert rolling.advance(spark, empty, str(tmp_path / "parts")) == -1
    assert rolling.spans(spark, str(tmp_path / "parts")) == [] == rolling.fold_parts(spark, str(tmp_path / "parts"))


def test_scheduled_run_with_parts(spark, tmp_path):
    source = rows(spark, n=60).filter("not isnan(financial_impact_eur)").filter("institution_id is not null")
    vendor_rows = vendors(spark, ("AWS", "cloud", False, True, 5), ("Murex", "saas", True, False, 2))
    results = []
    for kind, options in (("whole", {}), ("rolled", {"rolled": True, "fold_at": 2})):
        paths = RunPaths(str(tmp_path / kind))
        for run, until in (("r1", "id-00020"), ("r2", "id-00040"), ("r3", "id-00059")):
            result = run_scheduled(spark, source.filter(F.col("incident_id") <= until), vendor_rows, paths, AS_OF, run, **options)
            results.append([shown(f) for f in (result.report, result.vendor_risk, result.breaches, result.alerts)])
    assert results[:3] == results[3:]
    assert not (tmp_path / "rolled" / "marts" / "breach_register").exists()
    assert "Exchange" not in plan_of(result.breaches)
