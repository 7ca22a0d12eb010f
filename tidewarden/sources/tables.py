"""Partitioned Parquet tables: declare, write, append, and read with partition pruning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden import schemas
from tidewarden.functions.session import path_exists

DAY_OF = {"incident_day": "incident_ts", "processed_day": "processed_at"}
# Table name -> (schema, partition columns).
LAYOUT = {
    "incidents_raw": (schemas.INCIDENT, ("incident_day",)),
    "incidents_classified": (schemas.CLASSIFIED, ("incident_day", "severity")),
    "audit_log": (schemas.AUDIT, ("processed_day",)),
}


def table_schema(table: str) -> T.StructType:
    """Data columns followed by the partition columns, as Spark lays them out."""
    schema, partitions = LAYOUT[table]
    data = [f for f in schema.fields if f.name not in partitions]
    kinds = {f.name: f.dataType for f in schema.fields}
    return T.StructType(data + [T.StructField(p, kinds.get(p, T.DateType()), True) for p in partitions])


def create_tables(spark: SparkSession, database: str, location: str) -> None:
    """Declare the database and its tables; those that exist are left alone."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for table, (_, partitions) in LAYOUT.items():
        schema = table_schema(table)
        declared = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({declared}) USING parquet "
            f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{location}/{table}'"
        )


def with_partition_days(df: DataFrame, table: str) -> DataFrame:
    for partition in LAYOUT[table][1]:
        if partition in DAY_OF:
            df = df.withColumn(partition, F.to_date(DAY_OF[partition]))
    return df


def _spread(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Group rows by target partition; AQE splits a hot partition and merges small ones."""
    return df.hint("rebalance", *partitions)


def large_parts(df: DataFrame, tables: Sequence[str], rows_per_file: int) -> tuple[int, dict[str, list[Row]]]:
    """(rows in all, target partitions of more than `rows_per_file` rows by table), from one pass.

    At most one partition of a table per `rows_per_file` rows comes back to the driver.
    """
    for table in tables:
        df = with_partition_days(df, table)
    names = sorted({name for table in tables for name in LAYOUT[table][1]})
    # Spark numbers a grouping set by the columns it leaves out, the last column in the lowest bit.
    level = {t: sum(1 << n for n, name in enumerate(reversed(names)) if name not in LAYOUT[t][1]) for t in tables}
    total = (1 << len(names)) - 1
    sets = {LAYOUT[table][1] for table in tables} | {()}
    counts = df.groupingSets([list(columns) for columns in sets], *names).agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n")
    )
    found = counts.filter((F.col("n") > rows_per_file) | (F.col("level") == total)).collect()
    large = {t: [r for r in found if r["level"] == level[t] and r["n"] > rows_per_file] for t in tables}
    return sum(r["n"] for r in found if r["level"] == total), large


def dealt(df: DataFrame, partitions: Sequence[str], rows_per_file: int, large: Sequence[Row]) -> DataFrame:
    """Group rows by target partition with or without AQE, which is off in the batches of a stateful stream.

    Each of the `large` partitions is split into as many parts as `rows_per_file` asks for.
    """
    part = F.lit(0)
    for row in large:
        here = F.lit(True)
        for name in partitions:
            here = here & F.col(name).eqNullSafe(F.lit(row[name]))
        part = F.when(here, F.pmod(F.xxhash64("incident_id"), F.lit(-(-row["n"] // rows_per_file))).cast("int")).otherwise(part)
    return df.repartition(*partitions, part)


def write_dealt(df: DataFrame, path: str, table: str, rows_per_file: int, large: Sequence[Row]) -> None:
    """Overwrite a folder in the layout of a table, one file for each target partition and part of it."""
    partitions = LAYOUT[table][1]
    rows = with_partition_days(df, table).select(*table_schema(table).fieldNames())
    dealt(rows, partitions, rows_per_file, large).write.mode("overwrite").partitionBy(*partitions).parquet(path)


def write_as_dealt(df: DataFrame, path: str, table: str, files: int) -> None:
    """Overwrite a folder whose rows all have one target partition: no shuffle, at most `files` tasks."""
    partitions = LAYOUT[table][1]
    rows = with_partition_days(df, table).select(*table_schema(table).fieldNames())
    rows.coalesce(files).write.mode("overwrite").partitionBy(*partitions).parquet(path)


def append_to_table(df: DataFrame, database: str, table: str) -> None:
    """Append rows to a declared table."""
    partitions = LAYOUT[table][1]
    rows = with_partition_days(df, table).select(*table_schema(table).fieldNames())
    _spread(rows, partitions).write.mode("append").insertInto(f"{database}.{table}")


def write_rows(df: DataFrame, path: str, table: str, mode: str) -> None:
    """Write rows below a path in the layout of a table."""
    partitions = LAYOUT[table][1]
    rows = with_partition_days(df, table).select(*table_schema(table).fieldNames())
    _spread(rows, partitions).write.mode(mode).partitionBy(*partitions).parquet(path)


def load_rows(df: DataFrame, path: str, table: str) -> None:
    """The first load replaces, later loads append."""
    write_rows(df, path, table, "append" if path_exists(df.sparkSession, path) else "overwrite")


def read_rows(
    spark: SparkSession,
    path: str,
    table: str,
    since: str | None = None,
    until: str | None = None,
    tiers: Sequence[str] | None = None,
    extra: T.StructType | None = None,
) -> DataFrame:
    """Rows of a table with since <= event time < until (UTC text) and the given tiers.

    Each time bound becomes two predicates: one on the day, which prunes directories, and one on the
    time itself, which reaches the Parquet row groups. `extra` names further directory levels.
    """
    schema = T.StructType(table_schema(table).fields + (extra.fields if extra else []))
    rows = spark.read.schema(schema).parquet(path)
    day = LAYOUT[table][1][0]
    clock = DAY_OF[day]
    if since is not None:
        bound = F.lit(since).cast("timestamp")
        rows = rows.filter((F.col(day) >= F.to_date(bound)) & (F.col(clock) >= bound))
    if until is not None:
        bound = F.lit(until).cast("timestamp")
        rows = rows.filter((F.col(day) <= F.to_date(bound)) & (F.col(clock) < bound))
    if tiers is not None:
        rows = rows.filter(F.col("severity").isin(*tiers))
    return rows


def newest_day(spark: SparkSession, path: str, table: str) -> str | None:
    """The largest day among the folders of a table, by one listing and without reading a file; None without any."""
    prefix = f"{LAYOUT[table][1][0]}="
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not file_system.exists(hadoop_path):
        return None
    names = (status.getPath().getName() for status in file_system.listStatus(hadoop_path))
    days = [name.removeprefix(prefix) for name in names if name.startswith(prefix)]
    # Rows without a time lie in a folder whose name is no day.
    return max((day for day in days if day[:1].isdigit()), default=None)


def materialise(df: DataFrame, path: str, name: str | None = None) -> DataFrame:
    """Write a mart and read it back: later readers share one computation.

    With a name (`database.table`) it is a table of the catalog at that path, found after the session has ended.
    """
    if name is not None:
        df.write.mode("overwrite").option("path", path).saveAsTable(name)
        return df.sparkSession.table(name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
