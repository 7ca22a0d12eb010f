"""Counts of a batch and of a run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.config import TIERS
from tidewarden.functions.numbers import mean_2dp


def batch_summary(judged: DataFrame) -> DataFrame:
    """One row: events processed, per tier, and records rejected.

    Good and rejected records come in one frame of classified rows with `error_reason`, so that they are parsed once.
    """
    good, tier = F.col("error_reason").isNull(), F.col("severity")
    return judged.agg(
        F.count_if(good).alias("processed"),
        *[F.count_if(good & (tier == name)).alias(name) for name in TIERS],
        F.count_if(~good).alias("rejected"),
    )


def since_start(df: DataFrame, start: str, column: str) -> DataFrame:
    """Rows of a run: time known and not before the start (UTC text)."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) >= F.lit(start).cast("timestamp")))


def run_summary(classified: DataFrame) -> DataFrame:
    """One row: incidents in all, per tier, without a tier, and their mean impact (0 if none)."""
    tier = F.col("severity")
    return classified.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(tier == name).alias(name) for name in TIERS],
        F.count_if(tier.isNull()).alias("unknown"),
        F.coalesce(mean_2dp(F.col("financial_impact_eur")), F.lit(0.0)).alias("avg_financial_impact_eur"),
    )
