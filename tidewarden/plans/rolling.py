"""Marts kept up load by load: parts of new rows are appended, and folded together from time to time.

Parts lie in folders named by the loads they cover. An entry in the log, written last, makes a folder count; what was cut
off before is never read and is overwritten by the next try. Folding writes the sum of several folders as one more; the
widest finished folders are read, so old ones may go once their fold is logged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.functions.session import path_exists
from tidewarden.operators import incremental, rollup
from tidewarden.operators.staging import stage_incidents
from tidewarden.sources import tables

TABLE = "incidents_classified"
DAY = "incident_day"
LOG = "first_load long, last_load long, until_us long"


@dataclass(frozen=True)
class Span:
    """A finished folder: the loads it covers, and the newest event time in them."""

    first: int
    last: int
    until_us: int

    @property
    def name(self) -> str:
        return f"{self.first}-{self.last}"


def spans(spark: SparkSession, root: str) -> list[Span]:
    """The folders to read: of those that finished, the widest ones, each load once."""
    if not path_exists(spark, f"{root}/log"):
        return []
    rows = spark.read.schema(LOG).parquet(f"{root}/log").distinct().collect()
    chosen: list[Span] = []
    for span in sorted((Span(r.first_load, r.last_load, r.until_us) for r in rows), key=lambda s: (s.first, -s.last)):
        if not chosen or span.first > chosen[-1].last:
            chosen.append(span)
    return chosen


def _folder(root: str, name: str, span: Span) -> str:
    return f"{root}/{name}/span={span.name}"


def _log(spark: SparkSession, root: str, span: Span) -> None:
    entry = spark.createDataFrame([(span.first, span.last, span.until_us)], LOG).coalesce(1)
    entry.write.mode("overwrite").parquet(f"{root}/log/entry={span.name}")


def advance(spark: SparkSession, landed: DataFrame, root: str) -> int:
    """Aggregate the landed rows newer than those already in parts; the number of the load, -1 before any.

    `landed` is a table with the day partition, filled by loads that take strictly newer rows than it holds. Of it only the
    days from the newest event time in parts on are read. Without newer rows nothing is written.
    """
    done = spans(spark, root)
    number, mark_us = (done[-1].last, done[-1].until_us) if done else (-1, None)
    rows = landed
    if mark_us is not None:
        mark = F.timestamp_micros(F.lit(mark_us))
        rows = landed.filter((F.col("incident_ts") > mark) & (F.col(DAY) >= F.to_date(mark)))
    # Rows that land from here on belong to the next load.
    until_us = rows.agg(F.unix_micros(F.max("incident_ts")).alias("us")).first()["us"]
    if until_us is None:
        return number
    rows = rows.filter(F.col("incident_ts") <= F.timestamp_micros(F.lit(until_us)))
    span = Span(number + 1, number + 1, until_us)
    staged = stage_incidents(rows)
    for name, (parts_of, _) in rollup.PARTS.items():
        parts_of(staged).write.mode("overwrite").parquet(_folder(root, name, span))
    _log(spark, root, span)
    return span.last


def fold_parts(spark: SparkSession, root: str, at_least: int = 2) -> list[Span]:
    """Add up all finished folders into one, if they are as many; the folders that are read from now on."""
    done = spans(spark, root)
    if len(done) < max(2, at_least):
        return done
    whole = Span(done[0].first, done[-1].last, done[-1].until_us)
    for name in rollup.PARTS:
        rollup.merged(name, read_parts(spark, root, name)).write.mode("overwrite").parquet(_folder(root, name, whole))
    _log(spark, root, whole)
    return [whole]


def read_parts(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parts of all finished loads; there must be one."""
    folders = [_folder(root, name, span) for span in spans(spark, root)]
    schema = spark.read.parquet(folders[0]).schema
    return spark.read.schema(schema).parquet(*folders)


def rolled_marts(spark: SparkSession, root: str, vendors: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """The three marts as of a time, from staged vendors and the parts of all finished loads."""
    return {
        "regulatory_report": rollup.regulatory_report(read_parts(spark, root, "report")),
        "vendor_risk": rollup.vendor_risk(read_parts(spark, root, "provider"), vendors, as_of),
        "breach_register": rollup.breach_register(read_parts(spark, root, "breach"), as_of),
    }
