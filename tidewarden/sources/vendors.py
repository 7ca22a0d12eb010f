"""Vendor reference data from CSV."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden import schemas
from tidewarden.functions.session import path_exists
from tidewarden.operators.enrich import EDGE_SPACE


def _bare(name: str) -> Column:
    return F.regexp_replace(name, EDGE_SPACE, "")


def _flag(name: str) -> Column:
    return (F.lower(_bare(name)) == "true").alias(name)


def load_vendors(spark: SparkSession, path: str, headers: Mapping[str, str] | None = None) -> DataFrame:
    """Read vendor CSV files by the names in their header; empty when the path is missing.

    `headers` gives the name in the file of each column that is called otherwise there. The columns may stand in any order, all files in the same one, and others are not read; a missing one is an error.
    White space around values does not count. Of several rows with one name the last counts: the last in a file, and
    of several files the last by name.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.VENDOR)
    rows = spark.read.options(header=True, enforceSchema=False).csv(path)
    column_of = {given: name for name, given in (headers or {}).items()}
    rows = rows.withColumnsRenamed({c: column_of.get(c.strip(), c.strip()) for c in rows.columns})
    absent = [name for name in schemas.columns(schemas.VENDOR) if name not in rows.columns]
    if absent:
        raise ValueError(f"vendor columns missing in {path}: {', '.join(absent)}")
    # Ids grow within one part of a file; the parts of a file are ordered by where they begin.
    position = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    typed = rows.select(
        _bare("vendor_name").alias("vendor_name"),
        F.struct(
            _bare("vendor_type").alias("vendor_type"),
            _flag("eu_headquartered"),
            _flag("designated_critical"),
            _bare("concentration_risk_score").cast("int").alias("concentration_risk_score"),
        ).alias("attributes"),
        position.alias("position"),
    )
    last = typed.groupBy("vendor_name").agg(F.max_by("attributes", "position").alias("attributes"))
    return last.select("vendor_name", "attributes.*")
