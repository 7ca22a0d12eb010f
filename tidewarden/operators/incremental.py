"""High-watermark loads, the rows such a load leaves behind, and the run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden import schemas
from tidewarden.functions.jsontext import list_text
from tidewarden.functions.session import scratch_dir
from tidewarden.operators.lookup import BROADCAST_BYTES, left_lookup
from tidewarden.sources.tables import materialise


def watermark(target: DataFrame | None, column: str = "incident_ts", day: str | None = None) -> datetime | None:
    """The largest time in the target; None when it is absent or empty.

    With the name of the target's day partition only the last day's files are read for it.
    """
    if target is None:
        return None
    if day is not None:
        last = target.agg(F.max(day).alias("last")).first()["last"]
        if last is None:
            return None
        target = target.filter(F.col(day) == F.lit(last))
    return target.agg(F.max(column).alias("last")).first()["last"]


def newer_than(source: DataFrame, mark: datetime | None, column: str = "incident_ts", day: str | None = None) -> DataFrame:
    """Source rows strictly after the watermark; all rows without one."""
    if mark is None:
        return source
    bound = F.lit(mark)
    rows = source.filter(F.col(column) > bound)
    return rows if day is None else rows.filter(F.col(day) >= F.to_date(bound))


def incremental(source: DataFrame, target: DataFrame | None, column: str = "incident_ts") -> DataFrame:
    """Source rows that an incremental load of the target would add."""
    return newer_than(source, watermark(target, column), column)


def late_rows(
    source: DataFrame,
    target: DataFrame,
    column: str = "incident_ts",
    key: str = "incident_id",
    limit: int = BROADCAST_BYTES,
    day: str | None = None,
) -> DataFrame:
    """Source rows at or before the target's watermark whose key the target lacks; rows without a key are among them.

    The keys of both sides are reduced per key first, so a key with very many rows reaches the shuffle once per task;
    only the keys found late are looked up among the source rows. With the name of a day partition that both sides
    have, the watermark comes from the target's last day and later days of the source are not read.
    """
    mark = watermark(target, column, day)
    if mark is None:
        return source.limit(0)
    bound = F.lit(mark)
    due = source.filter(F.col(column) <= bound)
    if day is not None:
        due = due.filter(F.col(day) <= F.to_date(bound))
    sides = due.select(key, F.lit(False).alias("loaded")).unionByName(
        target.select(key, F.lit(True).alias("loaded"))
    )
    missing = sides.groupBy(key).agg(F.bool_or("loaded").alias("loaded")).filter(
        ~F.col("loaded") & F.col(key).isNotNull()
    )
    # Written once: its size decides the join, and the join reads it again.
    missing = materialise(missing.select(key), scratch_dir(source.sparkSession, "late-keys"))
    flagged = left_lookup(due, missing.withColumn("is_missing", F.lit(True)), key, key, limit)
    return flagged.filter(F.col("is_missing") | F.col(key).isNull()).drop("is_missing")


def serving_rows(classified: DataFrame) -> DataFrame:
    """Rows for a row store: the list column as JSON text."""
    return classified.withColumn("affected_systems", list_text(F.col("affected_systems")))


def run_log(
    table: DataFrame, loaded_count: int | None, run_id: str, logged_at: Column, runtime_seconds: float | None
) -> DataFrame:
    """One row: size of the whole table, rows this run added, run time."""
    row = table.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(run_id).alias("run_id"),
        "record_count",
        F.lit(loaded_count).cast("bigint").alias("loaded_count"),
        F.lit(runtime_seconds).cast("double").alias("runtime_seconds"),
        logged_at.alias("logged_at"),
    )
    return row.select(*schemas.columns(schemas.RUN_LOG))
