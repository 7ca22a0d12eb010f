"""Join facts to a dimension without letting the dimension's size or a hot key decide the outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.functions.session import scratch_dir
from tidewarden.sources.tables import materialise

BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot when it holds at least one in this many rows, so there are at most this many hot keys.
HOT_SHARE = 1000

_FIXED_WIDTH = 16


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size, from one aggregate over the rows."""
    width = F.lit(_FIXED_WIDTH * (len(df.columns) + 1))
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def hot_keys(facts: DataFrame, key: str) -> DataFrame:
    """The keys that hold at least 1/HOT_SHARE of the keyed rows; never more than HOT_SHARE rows."""
    keyed = facts.filter(F.col(key).isNotNull())
    # Written once, so that the facts are grouped once for the total and the hot keys.
    counts = keyed.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, scratch_dir(facts.sparkSession, "key-counts"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()["total"]
    return counts.filter(F.col("n") * F.lit(HOT_SHARE) >= F.lit(total)).select("hot_key")


def row_spread() -> Column:
    """A positive number per input task: the same when the task is run again, and it reads no column."""
    return (F.spark_partition_id() + 1).cast("bigint")


def left_lookup(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """LEFT JOIN facts to a dimension, keeping every fact row and the dimension's other columns.

    Up to `limit` measured bytes the dimension is broadcast and the facts are not shuffled. Beyond
    that the rows of hot keys take their one dimension row from a broadcast of at most HOT_SHARE
    rows, and the others are shuffled by key. A key that several dimension rows share is always
    shuffled, so it fans out as in any join.
    """
    attributes = [c for c in dimension.columns if c != dimension_key]
    if fits_broadcast(dimension, limit):
        matched = facts.join(
            F.broadcast(dimension), facts[fact_key] == dimension[dimension_key], "left"
        )
        return matched.select(*[facts[c] for c in facts.columns], *[dimension[c] for c in attributes])

    packed = dimension.select(
        F.col(dimension_key).alias("dim_key"), F.struct(*attributes).alias("dim_row")
    ).filter(F.col("dim_key").isNotNull())
    hot = (
        packed.join(F.broadcast(hot_keys(facts, fact_key)), F.col("dim_key") == F.col("hot_key"), "right")
        .groupBy("hot_key")
        .agg(F.first("dim_row").alias("hot_row"), F.count("dim_key").alias("matches"))
        .filter("matches <= 1")
        .drop("matches")
    )
    first = facts.join(F.broadcast(hot), F.col(fact_key) == F.col("hot_key"), "left")
    cold_key = F.when(F.col("hot_key").isNull(), F.col(fact_key))
    # Rows with no key left to look up match nothing. They are spread by input task instead of meeting
    # in one task: at most what one input task holds goes the same way.
    spread = F.when(cold_key.isNull(), row_spread()).otherwise(F.lit(0).cast("bigint"))
    # The pair is one key: of two conditions Spark would fold the constant one out of the shuffle.
    second = first.withColumn("pair", F.struct(cold_key.alias("key"), spread.alias("lane"))).join(
        packed.select(
            F.struct(F.col("dim_key").alias("key"), F.lit(0).cast("bigint").alias("lane")).alias("dim_pair"),
            "dim_row",
        ),
        F.col("pair") == F.col("dim_pair"),
        "left",
    )
    found = F.coalesce(F.col("hot_row"), F.col("dim_row"))
    return second.withColumn("found", found).select(
        *facts.columns, *[F.col("found").getField(c).alias(c) for c in attributes]
    )
