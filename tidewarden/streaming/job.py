"""The stream: decode, classify, audit, and write every sink of a micro-batch as Spark jobs."""

from __future__ import annotations

import gc
import threading
import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewarden import schemas
from tidewarden.config import JobConfig, Thresholds, WireNames
from tidewarden.functions import keys
from tidewarden.operators import audit as auditing
from tidewarden.operators import classify as rules
from tidewarden.operators.enrich import enrich
from tidewarden.operators.summary import batch_summary
from tidewarden.sources import events, tables

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CODEC = "spark.sql.parquet.compression.codec"
VERSIONS_KEPT = "spark.sql.streaming.minBatchesToRetain"
# Queries started here, and the flag that keeps a further batch from starting.
_STOPPING: dict[str, threading.Event] = {}

ASSIGNED = ("severity", "notify_required", "notify_deadline_hours")
BATCH_DIRS = T.StructType(
    [T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())]
)


@dataclass(frozen=True)
class Sinks:
    """Where a stream writes.

    Each table is a folder `root/table/query_id=…/batch_id=…/`. A batch overwrites its own folder,
    so running it again after a failure leaves the same rows. Use a new `query_id` with a new
    checkpoint, whose batches count from 0 again. `publish` receives the enriched messages, or they
    are written below `root` like the rest; an outside system may see a batch's messages twice.
    With `vendors` the messages also carry the severity label and the vendor's attributes.
    """

    root: str
    query_id: str
    config: JobConfig = field(default_factory=JobConfig)
    names: WireNames = field(default_factory=WireNames)
    thresholds: Thresholds = field(default_factory=Thresholds)
    publish: Callable[[DataFrame, JobConfig], None] | None = None
    vendors: DataFrame | None = None
    storage_level: StorageLevel = field(default_factory=lambda: StorageLevel.MEMORY_AND_DISK)
    rows_per_file: int = 1_000_000

    def folder(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/query_id={self.query_id}/batch_id={batch_id}"


def prepare(raw: DataFrame, names: WireNames = WireNames(), dedup_within: str | None = None) -> DataFrame:
    """Decode a stream of JSON text in `value`.

    `processed_at` is the time of the micro-batch, which Spark keeps in the checkpoint, so a batch
    that is run again gets the same stamp. With `dedup_within` (such as "1 hour") a record that
    arrives again within that time is dropped; the span is measured in arrival time, so no event is
    ever too late to be kept. Only an event equal in all its fields is a repeat: one that amends an
    earlier event under the same id is another event. Two states are kept for the span: the texts of
    each input task, whose copies are dropped before they are decoded, and the identities as a whole.
    Then only rejected records keep their text in `value`.
    """
    if dedup_within is None:
        return events.parse(raw, F.current_timestamp(), names)
    text = F.col("value").cast("string")
    arrived = raw.select(
        text.alias("value"),
        F.current_timestamp().alias("processed_at"),
        _short(F.sha2(text, 256)).alias("text_digest"),
        F.spark_partition_id().alias("lane"),
    )
    once_a_lane = arrived.withWatermark("processed_at", dedup_within).dropDuplicatesWithinWatermark(["text_digest", "lane"])
    parsed = events.parse(once_a_lane, F.col("processed_at"), names)
    # An event that names no time is stamped on arrival, so its text tells it from others.
    decoded = F.col("error_reason").isNull() & (F.col("incident_ts") != F.col("processed_at"))
    identity = F.when(decoded, keys.event_digest()).otherwise(F.sha2(F.col("value"), 256))
    identified = parsed.withColumn("identity", _short(identity)).withColumn("value", _text_of_rejected())
    return identified.dropDuplicatesWithinWatermark(["identity"]).drop("identity")


def _short(digest: Column) -> Column:
    """Half of a SHA-256 in hex, as bytes: enough to tell records apart, and half the state."""
    return F.unhex(F.left(digest, F.lit(32)))


def _text_of_rejected() -> Column:
    """Only rejected records need their text, which is most of what a record would carry along."""
    return F.when(F.col("error_reason").isNotNull(), F.col("value"))


def _settle(parsed: DataFrame, sinks: Sinks) -> DataFrame:
    """Everything the sinks need of each record, side by side: as it arrived, as classified, its hash."""
    arrived = parsed.withColumns({"value": _text_of_rejected()} | {f"arrived_{name}": F.col(name) for name in ASSIGNED})
    classified = rules.add_reason(rules.classify(arrived, sinks.thresholds), sinks.thresholds)
    return auditing.with_hash(classified, sinks.names)


def _as_arrived(good: DataFrame) -> DataFrame:
    given = {name: F.col(f"arrived_{name}") for name in ASSIGNED}
    return good.withColumns(given)


def write_batch(parsed: DataFrame, batch_id: int, sinks: Sinks) -> int:
    """Write one decoded micro-batch: raw landing, classified, audit, messages, rejects, counts. The number of good rows.

    The files are packed by zstd unless the session names another codec.
    """
    with _settings(parsed.sparkSession, {CODEC: "zstd"}):
        return _write_sinks(parsed, batch_id, sinks)


def _write_sinks(parsed: DataFrame, batch_id: int, sinks: Sinks) -> int:
    spark = parsed.sparkSession
    batch = _settle(parsed, sinks).persist(sinks.storage_level)
    try:
        good = batch.filter(F.col("error_reason").isNull())
        stored = sinks.folder("incidents_classified", batch_id)
        rejected = sinks.folder("rejected", batch_id)
        # Both tables lie by the day of the event, which is the same as it arrived and as classified.
        rows, large = tables.large_parts(good, ("incidents_raw", "incidents_classified"), sinks.rows_per_file)
        tables.write_dealt(
            _as_arrived(good),
            sinks.folder("incidents_raw", batch_id),
            "incidents_raw",
            sinks.rows_per_file,
            large["incidents_raw"],
        )
        tables.write_dealt(good, stored, "incidents_classified", sinks.rows_per_file, large["incidents_classified"])
        # All audit records of a batch have one day: the tasks of the kept batch write them as they are.
        tables.write_as_dealt(
            auditing.audit(good, F.col("processed_at")),
            sinks.folder("audit_log", batch_id),
            "audit_log",
            max(spark.sparkContext.defaultParallelism, -(-rows // sinks.rows_per_file)),
        )
        told = good if sinks.vendors is None else enrich(good, sinks.vendors)
        messages = events.enriched_messages(told, sinks.config.enriched_topic, sinks.names)
        if sinks.publish is not None:
            sinks.publish(messages, sinks.config)
        else:
            messages.write.mode("overwrite").parquet(sinks.folder("messages", batch_id))
        events.rejected_rows(batch).write.mode("overwrite").parquet(rejected)

        batch_summary(batch).select(F.lit(batch_id).cast("bigint").alias("batch_id"), "*").write.mode(
            "overwrite"
        ).parquet(sinks.folder("batch_log", batch_id))
        return rows
    finally:
        batch.unpersist()


def _drop_shuffles(spark: SparkSession) -> None:
    """Let the cleaner remove the shuffle files of finished work.

    It does so when the driver's heap lets go of their handles, which are small: a driver with a large heap would keep
    the files of many batches on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings for what is started within, unless the session has its own."""
    new = {name: value for name, value in values.items() if not _is_set(spark, name)}
    for name, value in new.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in new:
            spark.conf.unset(name)


def _is_set(spark: SparkSession, name: str) -> bool:
    return spark._jsparkSession.sessionState().conf().contains(name)


def start_stream(
    raw: DataFrame,
    sinks: Sinks,
    checkpoint: str,
    available_now: bool = False,
    dedup_within: str | None = None,
) -> StreamingQuery:
    """Start the job on a streaming frame with a `value` column.

    With `dedup_within` the session's state store is set to RocksDB, unless it names another provider than Spark's
    default: the identities of the span would otherwise lie in the executors' heaps. The state of the last three batches
    is kept, unless the session names another number: Spark's hundred would fill the checkpoint with outdated files.
    After a batch of more than `rows_per_file` rows the files of its shuffles are removed.
    """
    spark = raw.sparkSession
    if dedup_within is not None and "HDFSBacked" in spark.conf.get(STATE_STORE, "HDFSBacked"):
        spark.conf.set(STATE_STORE, ROCKSDB)
    writer = prepare(raw, sinks.names, dedup_within).writeStream.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{sinks.config.trigger_seconds} seconds")
    stopping = threading.Event()

    def write(df: DataFrame, batch_id: int) -> None:
        if stopping.is_set():
            raise StopRequested(f"batch {batch_id} is left for the next start")
        if write_batch(df, batch_id, sinks) > sinks.rows_per_file:
            _drop_shuffles(spark)

    with _settings(spark, {} if dedup_within is None else {VERSIONS_KEPT: "3"}):
        query = writer.foreachBatch(write).start()
    _STOPPING[str(query.runId)] = stopping
    return query


class StopRequested(RuntimeError):
    """Ends a query whose next batch began although a stop was asked for; the batch has written nothing."""


def _last_batch(query: StreamingQuery) -> int:
    progress = query.lastProgress
    return -1 if progress is None else progress["batchId"]


def stop_gracefully(query: StreamingQuery, wait_seconds: float = 60, pause: float = 0.02) -> bool:
    """Let the batch in flight end, keep a further one from starting, and stop. Whether it ended in time.

    A batch is over when its progress is reported or the trigger rests. After `wait_seconds` the query is stopped
    anyway; the batch that is cut off runs again on the next start.
    """
    began, until = _last_batch(query), time.monotonic() + wait_seconds
    if query.isActive and query.status["isTriggerActive"]:
        flag = _STOPPING.get(str(query.runId))
        if flag is not None:
            # The batch in flight has passed its check already, or will be left to the next start.
            flag.set()
        while query.isActive and query.status["isTriggerActive"] and _last_batch(query) == began:
            if time.monotonic() > until:
                break
            time.sleep(pause)
    in_time = time.monotonic() <= until
    query.stop()
    _STOPPING.pop(str(query.runId), None)
    return in_time


def _read_folder(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType(schema.fields + BATCH_DIRS.fields)).parquet(f"{root}/{table}")


def read_classified(spark: SparkSession, root: str, **bounds) -> DataFrame:
    return tables.read_rows(
        spark, f"{root}/incidents_classified", "incidents_classified", extra=BATCH_DIRS, **bounds
    )


def read_raw(spark: SparkSession, root: str, **bounds) -> DataFrame:
    return tables.read_rows(spark, f"{root}/incidents_raw", "incidents_raw", extra=BATCH_DIRS, **bounds)


def read_audit(spark: SparkSession, root: str, **bounds) -> DataFrame:
    return tables.read_rows(spark, f"{root}/audit_log", "audit_log", extra=BATCH_DIRS, **bounds)


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    return _read_folder(spark, root, "rejected", schemas.REJECTED)


def read_messages(spark: SparkSession, root: str) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("topic", "key", "value")])
    return _read_folder(spark, root, "messages", schema)


def read_batch_log(spark: SparkSession, root: str) -> DataFrame:
    return _read_folder(spark, root, "batch_log", T.StructType(schemas.BATCH_LOG.fields[1:]))
