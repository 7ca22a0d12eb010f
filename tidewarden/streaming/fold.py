"""Folding the folders of many micro-batches into a table of fewer files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.functions.session import path_exists
from tidewarden.sources import tables
from tidewarden.streaming import job

TABLE = "incidents_classified"
LOG = "query_id string, after_batch long, until_batch long"


def folds(spark: SparkSession, landed: str, query_id: str) -> list[tuple[int, int]]:
    """(after, until) of each finished fold of a query; one entry a fold."""
    if not path_exists(spark, f"{landed}/folds"):
        return []
    log = spark.read.schema(LOG).parquet(f"{landed}/folds").filter(F.col("query_id") == query_id)
    return sorted((r.after_batch, r.until_batch) for r in log.distinct().collect())


def _folder(landed: str, query_id: str, after: int, until: int) -> str:
    return f"{landed}/{TABLE}/query_id={query_id}/fold={after}-{until}"


def fold_batches(spark: SparkSession, root: str, landed: str, query_id: str, until_batch: int) -> int:
    """Write the classified rows of the batches up to `until_batch` that no fold holds yet as one more fold.

    A fold counts once it stands in the log, which is written last; one that was cut off is never read, and running
    it again overwrites its folder. Returns the last batch that is folded. Batches up to it may then be removed.
    """
    done = folds(spark, landed, query_id)
    after = max((until for _, until in done), default=-1)
    if until_batch <= after:
        return after
    batches = F.col("batch_id")
    rows = job.read_classified(spark, root).filter((F.col("query_id") == query_id) & (batches > after) & (batches <= until_batch))
    tables.write_rows(rows.drop("query_id", "batch_id"), _folder(landed, query_id, after, until_batch), TABLE, "overwrite")
    entry = spark.createDataFrame([(query_id, after, until_batch)], LOG).coalesce(1)
    entry.write.mode("overwrite").parquet(f"{landed}/folds/entry={query_id}-{until_batch}")
    return until_batch


def read_folded(spark: SparkSession, landed: str, query_id: str, **bounds) -> DataFrame | None:
    """The rows of all finished folds of a query; None before the first."""
    found = [
        tables.read_rows(spark, _folder(landed, query_id, after, until), TABLE, **bounds)
        for after, until in folds(spark, landed, query_id)
    ]
    out = None
    for frame in found:
        out = frame if out is None else out.unionByName(frame)
    return out
