import pytest
from pyspark.sql import functions as F

from tests.frames import incidents, plan_of, vendors
from tidewarden.operators import lookup
from tidewarden.operators.enrich import enrich
from tidewarden.operators.staging import orphan_providers, stage_vendors
from tidewarden.sources.vendors import load_vendors


def facts(spark):
    """A third of all rows with one key, a third without a key, copies, and many rare keys."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.lit(None))
        .when(F.col("id") < 600, "gone")
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    )
    return spark.range(3000).select((F.col("id") % 1000).alias("n"), key.alias("k"))


def dimension(spark):
    rows = spark.range(0, 500, 2).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("name"), "id")
    twice = rows.filter("id < 20")
    extra = spark.createDataFrame([("hot", -1), ("twins", -2), ("twins", -3), (None, -4)], "name string, id bigint")
    return rows.unionByName(twice).unionByName(extra)


def counted(df):
    return {tuple(r)[:-1]: r["count"] for r in df.groupBy(*df.columns).count().collect()}


def test_both_ways_give_the_same_rows(spark):
    f, d = facts(spark), dimension(spark)
    want = counted(f.join(d, f["k"] == d["name"], "left").select("n", "k", "id"))
    small = lookup.left_lookup(f, d, "k", "name")
    large = lookup.left_lookup(f, d, "k", "name", limit=0)
    assert "BroadcastHashJoin" in plan_of(small)
    assert counted(small) == want
    assert counted(large) == want


def test_shuffled_join_without_automatic_broadcast(spark):
    f, d = facts(spark), dimension(spark)
    want = counted(f.join(d, f["k"] == d["name"], "left").select("n", "k", "id"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        large = lookup.left_lookup(f.repartition(4, "n"), d, "k", "name", limit=0)
        assert "SortMergeJoin" in plan_of(large)
        assert counted(large) == want
        # Rows with a hot key or none, two thirds of all, do not meet in one task of the shuffled join.
        spread = large.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in spread) < 2000
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_hot_name_with_several_rows_fans_out(spark):
    f = spark.range(100).select(F.lit("twins").alias("k"), "id").withColumnRenamed("id", "n")
    got = lookup.left_lookup(f, dimension(spark), "k", "name", limit=0)
    assert got.count() == 200


def test_large_dimension_is_not_broadcast_whole(spark):
    plan = plan_of(lookup.left_lookup(facts(spark), dimension(spark), "k", "name", limit=0))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_keys_are_bounded(spark):
    keys = {r["hot_key"] for r in lookup.hot_keys(facts(spark), "k").collect()}
    assert {"hot", "gone"} <= keys and len(keys) <= lookup.HOT_SHARE


def test_measured_size_grows_with_the_text(spark):
    small = spark.createDataFrame([("a", 1)], "t string, n int")
    large = spark.createDataFrame([("a" * 1000, 1)], "t string, n int")
    assert lookup.measured_bytes(large) - lookup.measured_bytes(small) == 999
    assert lookup.fits_broadcast(small) and not lookup.fits_broadcast(large, limit=100)


def test_flag_of_listed_keys(spark):
    keys = spark.createDataFrame([("hot", True), ("gone", True)], "k string, listed boolean")
    for limit in (0, lookup.BROADCAST_BYTES):
        flagged = lookup.left_lookup(facts(spark), keys, "k", "k", limit)
        assert flagged.columns == ["n", "k", "listed"] and flagged.count() == facts(spark).count()
        assert flagged.filter("listed").count() == facts(spark).filter("k in ('hot', 'gone')").count()


CSV = """score,vendor_name,remark,critical, eu_headquartered,vendor_type
5,\t AWS ,x,TRUE,false,cloud\t
2,SAP,,\u00a0False ,true,saas
4,SAP,y,true,True,erp
"""
HEADERS = {"designated_critical": "critical", "concentration_risk_score": "score"}


def test_vendor_csv_by_name(spark, tmp_path):
    path = tmp_path / "vendors.csv"
    path.write_text(CSV)
    rows = {r["vendor_name"]: tuple(r)[1:] for r in load_vendors(spark, str(path), HEADERS).collect()}
    assert rows == {"AWS": ("cloud", False, True, 5), "SAP": ("erp", True, True, 4)}
    assert load_vendors(spark, str(tmp_path / "none.csv")).count() == 0
    with pytest.raises(ValueError, match="designated_critical, concentration_risk_score"):
        load_vendors(spark, str(path))


def test_the_last_vendor_file_counts(spark, tmp_path):
    head = "vendor_name,vendor_type,eu_headquartered,designated_critical,concentration_risk_score\n"
    (tmp_path / "a.csv").write_text(head + "".join(f"V{n},old,true,true,1\n" for n in range(500)) + "AWS,old,true,true,1\n")
    (tmp_path / "b.csv").write_text(head + "AWS,new,true,true,2\n")
    rows = {r["vendor_name"]: r["vendor_type"] for r in load_vendors(spark, str(tmp_path)).collect()}
    assert rows["AWS"] == "new" and rows["V7"] == "old"


def test_enrichment(spark):
    names = vendors(spark, ("AWS", "cloud", False, True, 5), ("SAP", "saas", True, False, 2))
    changes = [
        {"ict_third_party_provider": "\tAWS ", "severity": " Critical"},
        {"ict_third_party_provider": "SAP", "severity": "minor"},
        {"ict_third_party_provider": "Murex", "severity": "severe"},
        {"ict_third_party_provider": "  "},
        {},
    ]
    rows = sorted(enrich(incidents(spark, *changes), names).collect(), key=lambda r: r["incident_id"])
    assert [r["severity_label"] for r in rows] == [
        "Critical — BaFin notification within 4 hours",
        "Minor — internal logging only",
        "Unknown severity",
        "Unknown severity",
        "Unknown severity",
    ]
    assert [r["vendor_known"] for r in rows] == [True, True, False, False, False]
    assert [r["vendor_is_hyperscaler"] for r in rows] == [True, False, None, None, None]
    assert rows[0]["ict_third_party_provider"] == "\tAWS "
    empty = enrich(incidents(spark, *changes), names.limit(0))
    assert empty.filter("vendor_known").count() == 0 and empty.count() == 5


def test_staged_vendors_and_orphans(spark):
    staged = stage_vendors(vendors(spark, (" GCP ", " cloud", False, True, 4), ("Murex", "saas", True, False, 3)))
    rows = {r["vendor_name"]: r["is_hyperscaler"] for r in staged.collect()}
    assert rows == {"GCP": True, "Murex": False}
    used = incidents(spark, *[{"ict_third_party_provider": p} for p in ("GCP", "X", "X", "", None)])
    assert {tuple(r) for r in orphan_providers(used, staged).collect()} == {("X", 2), ("", 1)}
