"""Kafka and JDBC through Spark's own connectors, which must be on the class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidewarden.config import JobConfig


def kafka_stream(spark: SparkSession, config: JobConfig) -> DataFrame:
    """The tier topics as one stream with a `value` text column."""
    options = {
        "kafka.bootstrap.servers": config.brokers,
        "subscribe": config.source_topics,
        "startingOffsets": config.starting_offsets,
        "maxOffsetsPerTrigger": config.max_offsets_per_trigger,
        "minPartitions": config.min_partitions,
    }
    given = {name: value for name, value in options.items() if value is not None}
    return spark.readStream.format("kafka").options(**given).load().selectExpr("CAST(value AS STRING) AS value")


def write_kafka(messages: DataFrame, config: JobConfig) -> None:
    """Publish (topic, key, value) rows."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", config.brokers).save()


def text_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder of JSON-lines files as a stream with a `value` column."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str, options: Mapping[str, str] | None = None) -> None:
    """Load rows into a serving database; array columns must be JSON text by then."""
    df.write.format("jdbc").options(url=url, dbtable=table, **(options or {})).mode(mode).save()


def read_jdbc(spark: SparkSession, url: str, table: str, options: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {})).load()
