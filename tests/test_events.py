import hashlib
import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tests.frames import BASE, incidents, plan_of
from tidewarden import schemas
from tidewarden.config import TIERS, WireNames
from tidewarden.functions import jsontext, keys
from tidewarden.operators import audit
from tidewarden.sources import events as ev



def stamp():
    return F.lit("2026-07-01 00:00:00").cast("timestamp")


STAMP_VALUE = datetime(2026, 7, 1)
GOOD = {
    "incident_id": "0a1b2c3d-0000-4000-8000-00000000000f",
    "timestamp": "2026-03-17T22:41:05+00:00",
    "institution_id": "PT-PAY-88",
    "institution_type": "payment_provider",
    "incident_type": "system_outage",
    "affected_systems": ["core-banking", "cards"],
    "clients_affected_pct": 12.5,
    "financial_impact_eur": 1000,
    "detection_timestamp": "2026-03-17T20:05:30.123456+00:00",
    "containment_timestamp": None,
    "ict_third_party_provider": None,
    "is_cross_border": True,
    "severity": None,
    "notify_required": None,
    "notify_deadline_hours": None,
}


def parse(spark, *values):
    texts = [v if isinstance(v, str) or v is None else json.dumps(v) for v in values]
    raw = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, value string").coalesce(1)
    return ev.parse(raw.select("value"), stamp()).collect()


def test_round_trip(spark):
    row = parse(spark, GOOD)[0]
    assert row["error_reason"] is None
    assert row["incident_id"] == GOOD["incident_id"]
    assert row["incident_ts"] == datetime(2026, 3, 17, 22, 41, 5)
    assert row["detection_timestamp"] == datetime(2026, 3, 17, 20, 5, 30, 123456)
    assert row["affected_systems"] == ["core-banking", "cards"]
    assert (row["clients_affected_pct"], row["financial_impact_eur"]) == (12.5, 1000.0)
    assert row["is_cross_border"] is True and row["severity"] is None


LAX = [
    ("clients_affected_pct", "12.5", 12.5),
    ("clients_affected_pct", " 1e1 ", 10.0),
    ("clients_affected_pct", True, 1.0),
    ("financial_impact_eur", "inf", float("inf")),
    ("is_cross_border", "yes", True),
    ("is_cross_border", "OFF", False),
    ("is_cross_border", 0, False),
    ("is_cross_border", 1.0, True),
    ("incident_id", "0A1B2C3D00004000800000000000000F", "0a1b2c3d-0000-4000-8000-00000000000f"),
    ("incident_id", "urn:uuid:0a1b2c3d-0000-4000-8000-00000000000f", "0a1b2c3d-0000-4000-8000-00000000000f"),
    ("incident_id", "{0a1b2c3d-0000-4000-8000-00000000000f}", "0a1b2c3d-0000-4000-8000-00000000000f"),
    ("detection_timestamp", "2026-06-01T12:30:00+05:30", datetime(2026, 6, 1, 7)),
    ("detection_timestamp", "2026-06-01T12:30:00Z", datetime(2026, 6, 1, 12, 30)),
    ("detection_timestamp", "2026-06-01t12:30:00z", datetime(2026, 6, 1, 12, 30)),
    ("detection_timestamp", "2026-06-01 12:30", datetime(2026, 6, 1, 12, 30)),
    ("detection_timestamp", "2026-06-01", datetime(2026, 6, 1)),
    ("detection_timestamp", 1780308000, datetime(2026, 6, 1, 10)),
    ("detection_timestamp", "1780308000", datetime(2026, 6, 1, 10)),
    ("detection_timestamp", 1780308000123, datetime(2026, 6, 1, 10, 0, 0, 123000)),
    ("notify_deadline_hours", "72", 72),
    ("notify_deadline_hours", 4.0, 4),
    ("severity", "major", "major"),
    ("ict_third_party_provider", "", ""),
    # A bare number in text is an epoch time.
    ("detection_timestamp", "2026", datetime(1970, 1, 1, 0, 33, 46)),
]


def test_lax_values(spark):
    rows = parse(spark, *[GOOD | {field: given} for field, given, _ in LAX])
    assert [r["error_reason"] for r in rows] == [None] * len(LAX)
    assert [r[field] for r, (field, _, _) in zip(rows, LAX)] == [want for _, _, want in LAX]


BAD = [
    ({"institution_id": None}, "missing"),
    ({"affected_systems": None}, "missing"),
    ({"is_cross_border": None}, "missing"),
    ({"institution_type": "hedge_fund"}, "literal"),
    ({"incident_type": "flood"}, "literal"),
    ({"severity": "severe"}, "literal"),
    ({"institution_type": 7}, "literal"),
    ({"incident_id": None}, "type"),
    ({"incident_id": "no uuid"}, "type"),
    ({"timestamp": None}, "type"),
    ({"timestamp": "10:00"}, "type"),
    ({"detection_timestamp": "2026-13-01"}, "type"),
    ({"institution_id": 7}, "type"),
    ({"ict_third_party_provider": {"name": "AWS"}}, "type"),
    ({"affected_systems": "core-banking"}, "type"),
    ({"affected_systems": ["a", 1]}, "type"),
    ({"affected_systems": ["a", None]}, "type"),
    ({"clients_affected_pct": "twelve"}, "type"),
    ({"clients_affected_pct": "1.5f"}, "type"),
    ({"clients_affected_pct": "true"}, "type"),
    ({"is_cross_border": "maybe"}, "type"),
    ({"is_cross_border": 2}, "type"),
    ({"notify_deadline_hours": 4.5}, "type"),
    ({"notify_deadline_hours": 99999999999}, "type"),
]


def test_bad_values(spark):
    rows = parse(spark, *[GOOD | change for change, _ in BAD])
    assert [r["error_reason"] for r in rows] == [reason for _, reason in BAD]


def test_broken_json(spark):
    rows = parse(spark, "{broken", "[1, 2]", '"text"', "", None, json.dumps(GOOD) + " tail", json.dumps(GOOD)[:-1])
    assert [r["error_reason"] for r in rows] == ["json"] * 7


def test_nan_unknown_keys_and_repeated_keys(spark):
    nan = json.dumps(GOOD | {"financial_impact_eur": float("nan"), "extra": [1, {"a": 2}]})
    twice = json.dumps(GOOD)[:-1] + ', "clients_affected_pct": 3.0}'
    rows = parse(spark, nan, twice)
    assert [r["error_reason"] for r in rows] == [None, None]
    assert rows[0]["financial_impact_eur"] != rows[0]["financial_impact_eur"]
    assert rows[1]["clients_affected_pct"] == 3.0


def test_defaults_are_the_same_on_replay(spark):
    bare = {k: v for k, v in GOOD.items() if k not in ("incident_id", "timestamp")}
    first, second = parse(spark, bare)[0], parse(spark, bare)[0]
    assert first["error_reason"] is None
    assert first["incident_id"] == second["incident_id"] and len(first["incident_id"]) == 36
    assert first["incident_ts"] == STAMP_VALUE


TEXTS = ["plain", 'a "quote"', "back\\slash", "tab\tnew\nline\r\b\f", "é — €", "emoji 😀 end", "\x01\x1f\x7f", "", None]
FLOATS = [
    0.0, -0.0, 1.0, 12.5, 0.1, 100.0, 1e7, 12345678.9, 123456789012.34, 9999999.0, 9999999.5, 1e15, 1e16, 1.5e300,
    0.001, 0.0001, 0.00012, 0.00001, 1.25e-7, -42.42, float("nan"), float("inf"), float("-inf"),
]


def test_canonical_json_text(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select(
        F.coalesce(jsontext.quoted(F.col("t")), F.lit("null")).alias("j")
    )
    assert [r["j"] for r in rows.collect()] == [json.dumps(t) for t in TEXTS]
    rows = spark.createDataFrame([(x,) for x in FLOATS], "x double").select(jsontext.float_text(F.col("x")).alias("j"))
    assert [r["j"] for r in rows.collect()] == [json.dumps(x) for x in FLOATS]
    rows = spark.createDataFrame([([t for t in TEXTS],), ([],)], "a array<string>").select(
        jsontext.list_text(F.col("a")).alias("j")
    )
    assert [r["j"] for r in rows.collect()] == [json.dumps(TEXTS), "[]"]


def test_escapes_take_one_step_a_run_of_plain_text(spark):
    """Not one step a character: each stated reason has one or two signs beyond ASCII."""
    text = "—" + "plain " * 200 + "€ 😀\u0001" + "end" * 100
    df = spark.createDataFrame([(text,)], "t string").select(jsontext.quoted(F.col("t")).alias("j"))
    assert df.first()["j"] == json.dumps(text)
    assert "conv(" not in plan_of(df)


def as_message(row: dict, names: dict[str, str]) -> dict:
    return {
        names[k]: v.isoformat() if isinstance(v, datetime) else v for k, v in row.items()
    }


def test_encode_and_hash_match_plain_json(spark):
    odd = {
        "incident_ts": datetime(2026, 6, 1, 10, 0, 0, 5, tzinfo=timezone.utc),
        "containment_timestamp": datetime(2026, 6, 2, tzinfo=timezone.utc),
        "ict_third_party_provider": 'Müller "IT"',
        "affected_systems": ["a", "b\\c"],
        "financial_impact_eur": 12345678.25,
        "severity": "major",
        "notify_required": True,
        "notify_deadline_hours": 72,
    }
    names = WireNames(severity="tier", notify_required="must_notify")
    df = incidents(spark, {}, odd)
    columns = schemas.columns(schemas.INCIDENT)
    rows = [
        as_message({c: (BASE | {"incident_id": f"00000000-0000-4000-8000-{n:012d}"} | change)[c] for c in columns}, dict(names.pairs()))
        for n, change in enumerate(({}, odd))
    ]
    encoded = ev.encode(df, names).collect()
    assert [r["value"] for r in encoded] == [json.dumps(r) for r in rows]
    assert [r["key"] for r in encoded] == ["NL-INS-417"] * 2
    hashes = [r["record_hash"] for r in audit.with_hash(df, names).collect()]
    assert hashes == [hashlib.sha256(json.dumps(r, sort_keys=True).encode()).hexdigest() for r in rows]


def test_decoding_what_was_encoded(spark):
    df = incidents(spark, {}, {"severity": "minor", "ict_third_party_provider": "x"})
    good, rejected = ev.decode(ev.encode(df).select("value"), stamp())
    assert rejected.count() == 0
    assert sorted(map(str, good.collect())) == sorted(map(str, df.collect()))


def test_renamed_keys_are_read(spark):
    names = WireNames(incident_ts="when", severity="tier")
    message = {("when" if k == "timestamp" else "tier" if k == "severity" else k): v for k, v in GOOD.items()}
    raw = spark.createDataFrame([(json.dumps(message | {"tier": "minor"}),)], "value string")
    row = ev.parse(raw, stamp(), names).first()
    assert (row["error_reason"], row["severity"], row["incident_ts"]) == (None, "minor", datetime(2026, 3, 17, 22, 41, 5))


def test_routing(spark):
    df = incidents(spark, *[{"severity": t} for t in (*TIERS, None)])
    rows = ev.route(df, {t: f"in.{t}" for t in TIERS}).collect()
    assert [r["topic"] for r in rows] == ["in.critical", "in.major", "in.minor", "incidents.untiered"]


def test_surrogate_key(spark):
    row = spark.sql("select 'a' as a, cast(null as int) as b").select(
        keys.surrogate_key(F.col("a")).alias("one"), keys.surrogate_key(F.col("a"), F.col("b")).alias("two")
    ).first()
    assert row["one"] == hashlib.md5(b"a").hexdigest()
    assert row["two"] == hashlib.md5(f"a-{keys.NULL_KEY}".encode()).hexdigest()


def test_the_parse_is_not_copied_into_the_filter(spark):
    raw = spark.range(3).select(F.col("id").cast("string").alias("value"))
    good, _ = ev.decode(raw, stamp())
    plan = plan_of(good)
    assert "Python" not in plan and "Exchange" not in plan
    assert all("from_json" not in line for line in plan.split("\n") if " Filter " in line)
    # One decode of the message; the others are of single keys, for records whose text leaves the type open.
    assert plan.count("_corrupt,StringType") == 1
