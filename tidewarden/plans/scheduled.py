"""The scheduled run: load, check, stage, derive, marts, alerts, log, in that order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden import schemas
from tidewarden.functions.session import path_exists
from tidewarden.operators import incremental, marts, quality, staging
from tidewarden.operators.deadlines import derive
from tidewarden.plans import rolling
from tidewarden.sources import tables

TABLE = "incidents_classified"
DAY = "incident_day"


@dataclass(frozen=True)
class RunPaths:
    """Folders of a run, all below one root."""

    root: str

    @property
    def landed(self) -> str:
        return f"{self.root}/{TABLE}"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    def log(self, name: str) -> str:
        return f"{self.root}/logs/{name}"

    @property
    def parts(self) -> str:
        return f"{self.root}/parts"


@dataclass(frozen=True)
class RunResult:
    report: DataFrame
    vendor_risk: DataFrame
    breaches: DataFrame
    alerts: DataFrame
    checks: DataFrame
    loaded_count: int


def load_new(spark: SparkSession, source: DataFrame, path: str) -> int:
    """Append the source rows newer than the landed table; the first load writes them all."""
    landed = tables.read_rows(spark, path, TABLE) if path_exists(spark, path) else None
    # The newest folder shows the watermark; a query for the largest day would open every file of the table.
    newest = tables.newest_day(spark, path, TABLE)
    mark = None if newest is None else incremental.watermark(landed.filter(F.col(DAY) >= F.lit(newest)), "incident_ts")
    if mark is None:
        mark = incremental.watermark(landed, "incident_ts", DAY)
    day = DAY if DAY in source.columns else None
    new = incremental.newer_than(source, mark, "incident_ts", day)
    # A target that exists but holds no row has no watermark and is replaced, as on the first load.
    tables.write_rows(new, path, TABLE, "overwrite" if mark is None else "append")
    # Only the days from the watermark on are counted, whatever else has been written meanwhile.
    return incremental.newer_than(tables.read_rows(spark, path, TABLE), mark, "incident_ts", DAY).count()


def now() -> datetime:
    return datetime.now(timezone.utc)


def run_scheduled(
    spark: SparkSession,
    source: DataFrame,
    vendors: DataFrame,
    paths: RunPaths,
    as_of: str,
    run_id: str,
    started: datetime | None = None,
    suite: list[quality.Check] = quality.INCIDENT_SUITE,
    database: str | None = None,
    clock: Callable[[], datetime] = now,
    rolled: bool = False,
    fold_at: int = 96,
) -> RunResult:
    """Run the chain for a time given as UTC text. A failed check stops it before any mart is built.

    The logged run time is the time from `started` (this call, unless an earlier start is given) to the writing of the
    log row. With a `database` the marts are tables of the catalog; it is created if it is not there.

    The shared layer is a plan, not a table: it is a projection with one broadcast join, so each mart
    scans only the columns it needs instead of all of them being written and read back. Staging and
    the shared layer become views and the marts tables, each with a temporary view for SQL.

    With `rolled` the marts are made from parts: only the rows of this load are aggregated, and added to what earlier
    runs have left, see `plans.rolling`; the parts are folded together once they are `fold_at` folders. The breach
    register is then a view, a table only in a `database`: nothing of it is written again. Vendor names must be unique.
    """
    started = started or clock()
    if database is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{paths.root}/database'")
    table_name = lambda name: None if database is None else f"{database}.{name}"
    loaded = load_new(spark, source, paths.landed)
    landed = tables.read_rows(spark, paths.landed, TABLE)

    checks = tables.materialise(quality.run_suite(landed, suite), paths.log(f"checks/run_id={run_id}"))
    quality.gate(checks)

    at = F.lit(as_of).cast("timestamp")
    staged, names = staging.stage_incidents(landed), staging.stage_vendors(vendors)
    derived = derive(staged, names, at)
    if rolled:
        rolling.advance(spark, landed, paths.parts)
        rolling.fold_parts(spark, paths.parts, fold_at)
    made = (
        rolling.rolled_marts(spark, paths.parts, names, at)
        if rolled and rolling.spans(spark, paths.parts)
        else {
            "regulatory_report": marts.regulatory_report(derived),
            "vendor_risk": marts.vendor_risk(derived, at),
            "breach_register": marts.breach_register(derived),
        }
    )
    report, risk, breaches = (
        frame if rolled and database is None and name == "breach_register" else tables.materialise(frame, paths.mart(name), table_name(name))
        for name, frame in made.items()
    )
    alerts = tables.materialise(marts.compliance_alerts(report), paths.log(f"alerts/run_id={run_id}"))

    views = {
        "stg_incidents": staged,
        "stg_vendors": names,
        "incidents_derived": derived,
        "regulatory_report": report,
        "vendor_risk": risk,
        "breach_register": breaches,
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)

    runtime = (clock() - started).total_seconds()
    incremental.run_log(landed, loaded, run_id, at, runtime).write.mode("append").parquet(
        paths.log("runs")
    )
    return RunResult(report, risk, breaches, alerts, checks, loaded)


def read_run_log(spark: SparkSession, paths: RunPaths) -> DataFrame:
    return spark.read.schema(schemas.RUN_LOG).parquet(paths.log("runs"))
