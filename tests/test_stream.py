import json
import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tests.frames import incidents, vendors
from tidewarden import JobConfig, Thresholds
from tidewarden.catalog import queries
from tidewarden.functions import keys
from tidewarden.operators import classify
from tidewarden.sources import events, external, tables
from tidewarden.streaming import fold, job

DAY = datetime(2026, 6, 1, tzinfo=timezone.utc)


def write_messages(path, spark, batches):
    """One file per batch of texts."""
    path.mkdir()
    for n, texts in enumerate(batches):
        (path / f"part-{n}.txt").write_text("\n".join(texts) + "\n")
    return external.text_stream(spark, str(path), files_per_batch=1)


def texts(df):
    return [r["value"] for r in events.encode(df).orderBy("value").collect()]


def run(source, sinks, checkpoint, **options):
    query = job.start_stream(source, sinks, str(checkpoint), available_now=True, **options)
    query.awaitTermination()
    assert query.exception() is None
    return query


def sample(spark, first, last):
    changes = [
        {"incident_id": f"00000000-0000-4000-8000-{n:012d}", "clients_affected_pct": float(n)} for n in range(first, last)
    ]
    return incidents(spark, *changes)


def test_stream_writes_every_sink(spark, tmp_path):
    df = sample(spark, 0, 30)
    source = write_messages(tmp_path / "in", spark, [texts(df)[:10] + ["{bad"], texts(df)[10:], ["[]"]])
    root = str(tmp_path / "out")
    run(source, job.Sinks(root, "q"), tmp_path / "cp")

    want = {r["incident_id"]: r["severity"] for r in classify.classify(df).collect()}
    stored = job.read_classified(spark, root).collect()
    assert {r["incident_id"]: r["severity"] for r in stored} == want and len(stored) == 30
    audit = job.read_audit(spark, root).collect()
    assert len(audit) == 30 and all(len(r["record_hash"]) == 64 for r in audit)
    # One stamp per micro-batch.
    assert len({(r["batch_id"], r["processed_at"]) for r in audit}) == len({r["batch_id"] for r in audit})
    raw = job.read_raw(spark, root).collect()
    assert len(raw) == 30 and {r["severity"] for r in raw} == {None}
    message = json.loads(job.read_messages(spark, root).orderBy("value").first()["value"])
    assert len(message) == 19 and message["incident_id"].endswith("0000") and message["pipeline_version"] == "1.0.0"
    assert message["record_hash"] == next(r["record_hash"] for r in audit if r["incident_id"] == message["incident_id"])
    assert [r["error_reason"] for r in job.read_rejected(spark, root).collect()] == ["json", "json"]
    log = job.read_batch_log(spark, root).collect()
    assert sorted((r["processed"], r["rejected"]) for r in log) == [(0, 1), (10, 1), (20, 0)]
    assert sum(r["critical"] for r in log) == sum(t == "critical" for t in want.values())


def test_replayed_batch_leaves_no_duplicates(spark, tmp_path):
    source = write_messages(tmp_path / "in", spark, [texts(sample(spark, 0, 30))])
    root = str(tmp_path / "out")
    run(source, job.Sinks(root, "q"), tmp_path / "cp1")
    # The same batch again, with other thresholds: every row has another tier and so another folder.
    stricter = Thresholds(critical_pct=1e9, cyber_pct=1e9, cross_border_pct=1e9, major_pct=1e9)
    run(source, job.Sinks(root, "q", thresholds=stricter), tmp_path / "cp2")
    assert [tuple(r) for r in job.read_classified(spark, root).groupBy("severity").count().collect()] == [("minor", 30)]
    assert job.read_audit(spark, root).count() == 30
    # Another query beside it keeps its own folders.
    run(source, job.Sinks(root, "other"), tmp_path / "cp3")
    assert job.read_classified(spark, root).count() == 60


def test_restart_continues_after_the_last_batch(spark, tmp_path):
    first, second = texts(sample(spark, 0, 5)), texts(sample(spark, 5, 12))
    source = write_messages(tmp_path / "in", spark, [first])
    root = str(tmp_path / "out")
    run(source, job.Sinks(root, "q"), tmp_path / "cp")
    (tmp_path / "in" / "part-9.txt").write_text("\n".join(second) + "\n")
    run(source, job.Sinks(root, "q"), tmp_path / "cp")
    assert job.read_classified(spark, root).count() == 12


def test_repeated_messages_are_dropped_within_the_time(spark, tmp_path):
    lines = texts(sample(spark, 0, 8))
    source = write_messages(tmp_path / "in", spark, [lines + lines[:3] + ["{bad", "{bad"], lines[4:] + ["{bad"]])
    root = str(tmp_path / "out")
    run(source, job.Sinks(root, "q"), tmp_path / "cp", dedup_within="1 hour")
    assert job.read_classified(spark, root).count() == 8
    assert job.read_rejected(spark, root).count() == 1


def test_amended_events_are_kept(spark, tmp_path):
    event = {"incident_id": "00000000-0000-4000-8000-000000000001", "clients_affected_pct": 1.0}
    first, amended = texts(incidents(spark, event)), texts(incidents(spark, event | {"clients_affected_pct": 60.0}))
    source = write_messages(tmp_path / "in", spark, [first + first, amended + first, amended])
    root = str(tmp_path / "out")
    run(source, job.Sinks(root, "q"), tmp_path / "cp", dedup_within="1 hour")
    stored = [(r["clients_affected_pct"], r["severity"]) for r in job.read_classified(spark, root).collect()]
    assert sorted(stored) == [(1.0, "minor"), (60.0, "critical")]
    assert job.read_rejected(spark, root).count() == 0
    assert "RocksDB" in spark.conf.get(job.STATE_STORE)


def test_copies_are_dropped_before_they_are_decoded(spark, tmp_path):
    source = write_messages(tmp_path / "in", spark, [texts(sample(spark, 0, 2))])
    plan = job.prepare(source, dedup_within="1 hour")._jdf.queryExecution().analyzed().toString().split("\n")
    # The tree is shown from its top, so what runs first comes last.
    last = {word: max(n for n, line in enumerate(plan) if word in line) for word in ("DeduplicateWithinWatermark", "from_json")}
    assert last["DeduplicateWithinWatermark"] > last["from_json"]


def test_events_that_differ_in_one_field_have_different_digests(spark):
    changes = [
        {}, {"incident_ts": DAY}, {"incident_ts": DAY + timedelta(microseconds=1)}, {"financial_impact_eur": float("nan")},
        {"financial_impact_eur": 0.0}, {"financial_impact_eur": -0.0}, {"affected_systems": ["a, b"]}, {"affected_systems": ["a", "b"]},
        {"affected_systems": []}, {"ict_third_party_provider": ""}, {"ict_third_party_provider": "null"}, {"severity": "minor"},
        {"notify_required": False}, {"notify_deadline_hours": 4}, {"containment_timestamp": DAY},
    ]
    same_id = {"incident_id": "00000000-0000-4000-8000-000000000001"}
    df = incidents(spark, *[change | same_id for change in changes + changes])
    found = [r["d"] for r in df.select(keys.event_digest().alias("d")).collect()]
    assert len(set(found)) == len(changes) and found[: len(changes)] == found[len(changes) :]


def test_large_parts_of_all_tables_come_from_one_pass(spark):
    hours = [{"incident_ts": DAY + timedelta(days=n % 3), "severity": None if n % 3 == 1 else "major"} for n in range(31)]
    rows, large = tables.large_parts(incidents(spark, *hours), ("incidents_raw", "incidents_classified"), 10)
    assert rows == 31
    assert [(r["incident_day"].day, r["n"]) for r in large["incidents_raw"]] == [(1, 11)]
    assert [(r["incident_day"].day, r["severity"], r["n"]) for r in large["incidents_classified"]] == [(1, "major", 11)]
    rows, large = tables.large_parts(incidents(spark, *hours), ("incidents_raw", "incidents_classified"), 9)
    assert sorted((r["incident_day"].day, r["severity"]) for r in large["incidents_classified"] if r["severity"]) == [(1, "major"), (3, "major")]
    assert [r["incident_day"].day for r in large["incidents_classified"] if r["severity"] is None] == [2]
    assert len(large["incidents_raw"]) == 3
    assert tables.large_parts(incidents(spark, {}).limit(0), ("incidents_raw",), 1) == (0, {"incidents_raw": []})


def test_a_batch_keeps_the_text_of_rejected_records_alone(spark, tmp_path):
    lines = texts(sample(spark, 0, 2)) + ["{bad"]
    parsed = events.parse(spark.createDataFrame([(t,) for t in lines], "value string"), F.lit(DAY))
    kept = job._settle(parsed, job.Sinks(str(tmp_path), "q")).select("value").collect()
    assert sorted(r["value"] or "" for r in kept) == ["", "", "{bad"]


def files(root, table):
    return len(list((root / table).rglob("part-*.parquet")))


def test_files_do_not_grow_with_tasks(spark, tmp_path):
    """A stateful batch runs without AQE; it writes as few files as a plain one, and splits a hot day."""
    hours = [{"incident_id": f"00000000-0000-4000-8000-{n:012d}", "incident_ts": DAY + timedelta(hours=n % 72)} for n in range(300)]
    lines = texts(incidents(spark, *hours))
    found = {}
    for name, options in (("plain", {}), ("dedup", {"dedup_within": "1 hour"})):
        source = write_messages(tmp_path / name, spark, [lines])
        root = tmp_path / f"out-{name}"
        run(source, job.Sinks(str(root), "q", rows_per_file=50), tmp_path / f"cp-{name}", **options)
        assert job.read_classified(spark, str(root)).count() == 300
        found[name] = {t: files(root, t) for t in ("incidents_raw", "incidents_classified", "audit_log")}
    # Days of 108, 96 and 96 rows make 3 + 2 + 2 parts; with AQE small parts may be written together.
    for table in ("incidents_classified", "incidents_raw"):
        assert 3 <= found["plain"][table] <= found["dedup"][table] <= 7
    assert found["dedup"]["audit_log"] > 1


def test_stop_waits_for_the_batch_in_flight(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(6):
        (tmp_path / "in" / f"part-{n}.txt").write_text("\n".join(texts(sample(spark, 10 * n, 10 * n + 10))) + "\n")
    source = external.text_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    began = []

    def slow(df, config):
        began.append(time.monotonic())
        time.sleep(3)
        df.write.mode("overwrite").format("noop").save()

    sinks = job.Sinks(str(tmp_path / "out"), "q", config=JobConfig(trigger_seconds=1), publish=slow)
    query = job.start_stream(source, sinks, str(tmp_path / "cp"))
    while not began:
        time.sleep(0.05)
    asked = time.monotonic()
    assert job.stop_gracefully(query, wait_seconds=60)
    assert time.monotonic() - asked < 20 and not query.isActive
    error = query.exception()
    assert error is None or "StopRequested" in str(error)
    done = len(began)
    time.sleep(2)
    assert len(began) == done
    root = sinks.root
    log = {r["batch_id"]: r["processed"] for r in job.read_batch_log(spark, root).collect()}
    for read in (job.read_raw, job.read_classified, job.read_audit):
        assert {r["batch_id"]: r["count"] for r in read(spark, root).groupBy("batch_id").count().collect()} == log
    assert log == {n: 10 for n in range(done)}


def test_folds_can_be_run_again(spark, tmp_path):
    lines = texts(sample(spark, 0, 30))
    source = write_messages(tmp_path / "in", spark, [lines[:10], lines[10:20], lines[20:]])
    root, landed = str(tmp_path / "out"), str(tmp_path / "landed")
    run(source, job.Sinks(root, "q"), tmp_path / "cp")
    assert fold.read_folded(spark, landed, "q") is None
    assert fold.fold_batches(spark, root, landed, "q", 0) == 0
    # A fold that was cut off before its log entry is not read.
    tables.write_rows(job.read_classified(spark, root).drop("query_id", "batch_id"), fold._folder(landed, "q", 0, 1), fold.TABLE, "overwrite")
    assert fold.read_folded(spark, landed, "q").count() == 10
    for _ in range(2):
        assert fold.fold_batches(spark, root, landed, "q", 2) == 2
    want = {r["incident_id"]: r["severity"] for r in job.read_classified(spark, root).collect()}
    got = fold.read_folded(spark, landed, "q").collect()
    assert len(got) == 30 and {r["incident_id"]: r["severity"] for r in got} == want
    assert fold.folds(spark, landed, "q") == [(-1, 0), (0, 2)]
    assert files(tmp_path / "landed", f"{fold.TABLE}/query_id=q/fold=0-2") <= files(tmp_path / "out", "incidents_classified")


def test_publish_receives_the_messages(spark, tmp_path):
    source = write_messages(tmp_path / "in", spark, [texts(sample(spark, 0, 4))])
    seen = []
    names = vendors(spark, ("AWS", "cloud", False, True, 5))

    def publish(df, config):
        seen.append((config.enriched_topic, [json.loads(r["value"]) for r in df.collect()]))

    query = run(source, job.Sinks(str(tmp_path / "out"), "q", publish=publish, vendors=names), tmp_path / "cp")
    (topic, messages), = seen
    assert topic == "incidents.enriched" and len(messages) == 4
    assert {m["severity_label"] for m in messages} == {"Minor — internal logging only"}
    assert all(m["vendor_known"] is False and m["vendor_type"] is None and len(m) == 26 for m in messages)
    job.stop_gracefully(query)
    assert not query.isActive


def test_stream_equals_batch(spark, tmp_path):
    df = sample(spark, 0, 20).withColumn("is_cross_border", F.col("clients_affected_pct") > 12)
    source = write_messages(tmp_path / "in", spark, [texts(df)[:7], texts(df)[7:]])
    root = str(tmp_path / "out")
    run(source, job.Sinks(root, "q"), tmp_path / "cp")
    batch = classify.add_reason(classify.classify(df))
    got = job.read_classified(spark, root).select(*batch.columns)
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_good_records_lose_their_text_before_their_identities_meet(spark, tmp_path):
    source = write_messages(tmp_path / "in", spark, [texts(sample(spark, 0, 2)) + ["{bad"]])
    seen = []
    prepared = job.prepare(source, dedup_within="1 hour").writeStream.option("checkpointLocation", str(tmp_path / "cp"))
    prepared.trigger(availableNow=True).foreachBatch(lambda df, n: seen.extend(df.select("value").collect())).start().awaitTermination()
    assert sorted(r["value"] or "" for r in seen) == ["", "", "{bad"]


def test_a_long_stream_keeps_few_versions_of_its_state(spark, tmp_path):
    lines = texts(sample(spark, 0, 8))
    source = write_messages(tmp_path / "in", spark, [lines[n : n + 2] for n in range(7)])
    run(source, job.Sinks(str(tmp_path / "out"), "q"), tmp_path / "cp", dedup_within="1 hour")
    assert job.read_classified(spark, str(tmp_path / "out")).count() == 8
    assert 1 <= len([f for f in (tmp_path / "cp" / "commits").iterdir() if f.name.isdigit()]) <= 5
    # What the session sets itself, or leaves alone, stays so.
    assert not job._is_set(spark, job.VERSIONS_KEPT)
    spark.conf.set(job.VERSIONS_KEPT, "50")
    try:
        run(source, job.Sinks(str(tmp_path / "other"), "q"), tmp_path / "cp2", dedup_within="1 hour")
        assert spark.conf.get(job.VERSIONS_KEPT) == "50"
        assert len([f for f in (tmp_path / "cp2" / "commits").iterdir() if f.name.isdigit()]) >= 7
    finally:
        spark.conf.unset(job.VERSIONS_KEPT)


def test_sinks_are_packed_unless_the_session_says_how(spark, tmp_path):
    source = write_messages(tmp_path / "in", spark, [texts(sample(spark, 0, 4)) + ["{bad"]])
    run(source, job.Sinks(str(tmp_path / "zstd"), "q"), tmp_path / "cp1")
    spark.conf.set(job.CODEC, "snappy")
    try:
        run(source, job.Sinks(str(tmp_path / "snappy"), "q"), tmp_path / "cp2")
    finally:
        spark.conf.unset(job.CODEC)
    for codec in ("zstd", "snappy"):
        for table in ("incidents_raw", "incidents_classified", "audit_log", "messages", "rejected", "batch_log"):
            names = [f.name for f in (tmp_path / codec / table).rglob("part-*.parquet")]
            assert names and all(name.endswith(f".{codec}.parquet") for name in names)


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(n).getName().startswith("shuffle") for n in range(found.size()))


def test_shuffles_of_finished_work_are_dropped(spark):
    df = spark.range(1000).repartition(4, "id")
    df.write.format("noop").mode("overwrite").save()
    before = shuffle_files(spark)
    del df
    job._drop_shuffles(spark)
    until = time.monotonic() + 60
    while shuffle_files(spark) >= before and time.monotonic() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) < before


def test_only_large_batches_drop_shuffles(spark, tmp_path, monkeypatch):
    lines = texts(sample(spark, 0, 12))
    source = write_messages(tmp_path / "in", spark, [lines[:2], lines[2:10], lines[10:]])
    dropped = []
    monkeypatch.setattr(job, "_drop_shuffles", dropped.append)
    run(source, job.Sinks(str(tmp_path / "out"), "q", rows_per_file=5), tmp_path / "cp")
    assert len(dropped) == 1


def test_packed_input_comes_in_several_batches(spark, monkeypatch):
    lines = texts(sample(spark, 0, 40))
    messages = spark.createDataFrame([(t,) for t in lines + lines[::3] + ["{bad"]], "value string").coalesce(1)
    monkeypatch.setattr(queries, "MESSAGES_A_FILE", 10)
    monkeypatch.setattr(queries, "FILES_A_BATCH", 2)
    root = queries.streamed(spark, messages, dedup_within="1 hour", packed=True)
    inputs = spark.read.text(f"{root}/../input").select(F.input_file_name().alias("f")).distinct().collect()
    assert len(inputs) == 6 and all(r["f"].endswith(".txt.gz") for r in inputs)
    assert job.read_batch_log(spark, root).count() >= 3
    assert sorted(texts(job.read_classified(spark, root).withColumns({n: F.lit(None).cast(t) for n, t in (("severity", "string"), ("notify_required", "boolean"), ("notify_deadline_hours", "int"))}))) == sorted(lines)
    assert job.read_rejected(spark, root).count() == 1
