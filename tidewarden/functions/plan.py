"""Control over where Spark evaluates an expression."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns so that their expressions are evaluated once per row.

    Spark copies the expression of a projected column into every filter and column that reads it,
    which multiplies a costly one such as a JSON parse. It does not copy through a generator, so the
    columns come from a one-element list. Use it only where all the columns are needed: a column
    that nobody reads is not pruned away.
    """
    kept = [c for c in df.columns if c not in columns]
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(made)))


def over_all_cores(df: DataFrame, rows_per_task: int = 250_000) -> DataFrame:
    """Deal the rows of a scan evenly to all cores, and to more tasks where one would get over `rows_per_task`.

    The frame must be a scan with projections and filters. Its rows are counted by partition, which of a Parquet file
    reads the footer only. A file can have many splits and few row groups, so that most splits are empty. A table
    whose rows lie in enough parts is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    counted = parts.agg(F.sum("n").alias("rows"), F.max("n").alias("largest")).first()
    tasks = max(cores, -(-(counted["rows"] or 0) // rows_per_task))
    return df if (counted["largest"] or 0) * tasks <= 2 * (counted["rows"] or 0) else df.repartition(tasks)


def pinned(column: Column) -> Column:
    """The same value, which Spark will not copy into a filter above the projection.

    The partition number is never negative and stays the same when a task is run again, but Spark
    counts it as non-deterministic and leaves the projection where it is. Columns that nobody reads
    are still pruned.
    """
    return F.when(F.spark_partition_id() >= 0, column)
