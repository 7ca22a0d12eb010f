from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.frames import BASE, incidents, plan_of, vendors
from tidewarden.functions.numbers import mean_2dp, percent_2dp
from tidewarden.operators import charts, classify, marts, staging
from tidewarden.operators.deadlines import derive

UTC = timezone.utc
DETECTED = BASE["detection_timestamp"]
CRITICAL = {"clients_affected_pct": 30.0}
MAJOR = {"financial_impact_eur": 200_000.0}


def now(text="2026-06-01 15:00:00"):
    return F.lit(text).cast("timestamp")


def derived(spark, changes, as_of="2026-06-01 15:00:00", vendor_rows=()):
    rows = classify.add_reason(classify.classify(incidents(spark, *changes)))
    names = staging.stage_vendors(vendors(spark, *vendor_rows))
    return derive(staging.stage_incidents(rows), names, now(as_of))


CASES = [
    # contained after, tier, as of -> within, breached, hours overdue
    (CRITICAL, timedelta(hours=4), (True, False, None)),
    (CRITICAL, timedelta(hours=4, seconds=14), (True, False, None)),
    (CRITICAL, timedelta(hours=4, seconds=36), (False, True, 0.01)),
    (CRITICAL, timedelta(hours=5, minutes=30), (False, True, 1.5)),
    (CRITICAL, timedelta(seconds=-90), (True, False, None)),
    (CRITICAL, None, (False, True, 1.75)),
    (MAJOR, timedelta(hours=72), (True, False, None)),
    (MAJOR, timedelta(hours=72, seconds=18), (False, True, 0.01)),
    (MAJOR, None, (False, False, None)),
    ({}, timedelta(hours=500), (False, None, None)),
    ({}, None, (False, None, None)),
]


def test_deadlines(spark):
    changes = [
        tier | {"containment_timestamp": None if after is None else DETECTED + after} for tier, after, _ in CASES
    ]
    rows = {r["incident_id"]: r for r in derived(spark, changes).collect()}
    for n, (tier, after, want) in enumerate(CASES):
        r = rows[f"00000000-0000-4000-8000-{n:012d}"]
        assert (r["is_within_deadline"], r["sla_breached"], r["hours_overdue"]) == want, (tier, after)
        assert r["reporting_period"] == "2026-06"
    assert rows["00000000-0000-4000-8000-000000000004"]["containment_hours"] == -0.03
    assert rows["00000000-0000-4000-8000-000000000009"]["deadline_timestamp"] is None
    assert rows["00000000-0000-4000-8000-000000000006"]["deadline_timestamp"] == datetime(2026, 6, 4, 9, 15)


def test_open_incident_at_its_deadline_is_not_breached(spark):
    assert derived(spark, [CRITICAL], "2026-06-01 13:15:00").first()["sla_breached"] is False
    late = derived(spark, [CRITICAL], "2026-06-01 13:15:01").first()
    assert (late["sla_breached"], late["hours_overdue"]) == (True, 0.0)


def test_unmatched_and_repeated_vendors(spark):
    rows = [("AWS", "cloud", False, True, 5), ("SAP", "saas", True, False, 2), ("SAP", "saas", True, False, 2)]
    changes = [{"ict_third_party_provider": p} for p in ("AWS", " AWS", "SAP", None)]
    got = sorted(
        (r["ict_third_party_provider"] or "", r["vendor_type"], r["designated_critical"], r["is_hyperscaler"])
        for r in derived(spark, changes, vendor_rows=rows).collect()
    )
    assert got == [
        ("", None, False, False),
        (" AWS", None, False, False),
        ("AWS", "cloud", True, True),
        ("SAP", "saas", False, False),
        ("SAP", "saas", False, False),
    ]


@pytest.mark.parametrize(
    "within, reportable, rate, status",
    [
        (0, 0, None, "COMPLIANT"),
        (19, 20, 95.0, "COMPLIANT"),
        (18999, 20000, 95.0, "COMPLIANT"),
        (9499, 10000, 94.99, "AT_RISK"),
        (4, 5, 80.0, "AT_RISK"),
        (7999, 10000, 79.99, "NON_COMPLIANT"),
        (0, 3, 0.0, "NON_COMPLIANT"),
    ],
)
def test_status_is_read_off_the_rounded_rate(spark, within, reportable, rate, status):
    frame = spark.range(max(reportable, 1)).select(
        F.lit("2026-06").alias("reporting_period"),
        F.lit("I").alias("institution_id"),
        F.lit("bank").alias("institution_type"),
        F.lit("major").alias("severity"),
        (F.col("id") < reportable).alias("notify_required"),
        (F.col("id") < within).alias("is_within_deadline"),
        F.lit(1.0).alias("containment_hours"),
    )
    row = marts.regulatory_report(frame).first()
    assert (row["compliance_rate_pct"], row["compliance_status"]) == (rate, status)
    assert marts.compliance_alerts(marts.regulatory_report(frame)).count() == (status == "NON_COMPLIANT")


def test_report_counts(spark):
    changes = [
        CRITICAL | {"containment_timestamp": DETECTED + timedelta(hours=1)},
        MAJOR | {"containment_timestamp": DETECTED + timedelta(hours=2, seconds=18)},
        {},
        {"institution_id": "B", "incident_ts": datetime(2026, 7, 1, tzinfo=UTC)},
    ]
    rows = {r["institution_id"]: r for r in marts.regulatory_report(derived(spark, changes)).collect()}
    one, two = rows["NL-INS-417"], rows["B"]
    assert (one["incident_count_total"], one["incident_count_critical"], one["incident_count_major"]) == (3, 1, 1)
    assert (one["incident_count_minor"], one["incidents_reported"]) == (1, 2)
    # 1.00 and 2.01 hours: the mean 1.505 is rounded up.
    assert (one["avg_time_to_contain_hours"], one["compliance_rate_pct"]) == (1.51, 100.0)
    assert (two["reporting_period"], two["avg_time_to_contain_hours"], two["compliance_status"]) == (
        "2026-07", None, "COMPLIANT",
    )


def test_vendor_risk(spark):
    day = datetime(2026, 6, 1, tzinfo=UTC)
    changes = [
        {"ict_third_party_provider": "Two", "institution_id": i, "financial_impact_eur": e, "incident_ts": t}
        for i, e, t in (
            ("A", 0.0, day), ("B", 0.01, day - timedelta(days=90)), ("B", 0.0, day - timedelta(days=90, seconds=1)),
        )
    ]
    changes += [{"ict_third_party_provider": "Five", "institution_id": f"I{n}"} for n in range(5)]
    changes += [{"ict_third_party_provider": "AWS"}, {"ict_third_party_provider": "One"}, {"ict_third_party_provider": ""}, {}]
    frame = derived(spark, changes, vendor_rows=[("AWS", "cloud", False, True, 5)])
    rows = {r["ict_third_party_provider"]: r for r in marts.vendor_risk(frame, now()).collect()}
    assert {k: r["concentration_risk_tier"] for k, r in rows.items()} == {
        "Two": "MEDIUM", "Five": "HIGH", "AWS": "HIGH", "One": "LOW", "": "LOW",
    }
    assert (rows["Two"]["incident_count_last_90d"], rows["Two"]["institutions_exposed"]) == (2, 2)
    assert rows["Two"]["avg_financial_impact_eur"] == 0.0


def test_exact_means(spark):
    def mean(*values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(mean_2dp(F.col("x"))).first()[0]

    assert mean(0.01, 0.0) == 0.01
    assert mean(-0.01, 0.0) == -0.01
    assert mean(1.0, None, 2.01) == 1.51
    assert mean(None) is None
    assert mean(9e15, 9e15) == 9e15
    assert mean(float("inf"), 1.0) == float("inf")
    assert str(mean(float("nan"), 1.0)) == "nan"
    row = spark.range(1).select(percent_2dp(F.lit(2), F.lit(3)), percent_2dp(F.lit(0), F.lit(0))).first()
    assert tuple(row) == (66.67, None)


def test_metric_limit_keeps_the_largest(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 5), ("c", 5), ("a", 2), ("d", None)], "k string, v int")
    top = charts.metric(frame, ["k"], {"total": ("sum", "v"), "rows": "count(*)"}, where="k <> 'b'", limit=2)
    assert [tuple(r) for r in top.collect()] == [("c", 5, 1), ("a", 3, 2)]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_staging_drops_unusable_rows(spark):
    changes = [{}, {"incident_id": None}, {"incident_ts": None}, {"severity": None}]
    frame = incidents(spark, *[{"severity": "minor"} | c for c in changes]).withColumn("classification_reason", F.lit("x"))
    kept = staging.stage_incidents(frame).collect()
    assert [r["incident_id"] for r in kept] == ["00000000-0000-4000-8000-000000000000"]
    assert len(kept[0]["incident_sk"]) == 32


def test_charts_from_stored_parameters(spark):
    from tidewarden.operators import charts

    frame = spark.sql(
        "SELECT * FROM VALUES ('a', timestamp '2026-06-01 10:00:00', 1, 2.0D), ('a', timestamp '2026-06-01 23:00:00', 5, 4.0D), "
        "('b', timestamp '2026-06-08 00:00:00', 9, NULL), ('b', timestamp '2026-06-09 00:00:00', 0, 1.0D) AS t(k, at, n, x)"
    )
    simple = {"expressionType": "SIMPLE", "aggregate": "AVG", "column": {"column_name": "x"}, "label": "mean"}
    unlabelled = {"expressionType": "SIMPLE", "aggregate": "SUM", "column": {"column_name": "n"}}
    keep = {"expressionType": "SQL", "sqlExpression": "n > 0 or k = 'z'", "clause": "WHERE"}
    params = {"x_axis": "at", "time_grain_sqla": "P1W", "groupby": ["k"], "metrics": [unlabelled, simple], "adhoc_filters": [keep, keep]}
    got = charts.from_params(frame, params)
    assert got.columns == ["at", "k", "SUM(n)", "mean"]
    assert sorted((str(r.at)[:10], *r[1:]) for r in got.collect()) == [("2026-06-01", "a", 6, 3.0), ("2026-06-08", "b", 9, None)]
    assert [tuple(r) for r in charts.from_params(frame, {"x_axis": "k", "metric": unlabelled, "row_limit": 1}).collect()] == [("b", 9)]
    for odd in ({"order_desc": True}, {"adhoc_filters": [keep | {"clause": "HAVING"}]}, {"adhoc_filters": [keep | {"expressionType": "SIMPLE"}]}):
        with pytest.raises(ValueError):
            charts.from_params(frame, {"metrics": [unlabelled]} | odd)
