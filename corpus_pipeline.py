"""From raw documents to a training mixture, each stage on all that the one before it kept.

toxicity: rejected documents go; line_dedup: lines that many sites carry go, the documents stay; jaccard: one document
of each class of similar texts stays; decontamination: documents that hold a benchmark item go; mixing: how many words
the mixture takes of each document that is left.

A stage is (spark, docs, sf_dir) -> DataFrame. All but the last return the columns of documents. Null texts and texts
without words pass every stage, repeated rows pass as they are up to the join, which keeps one; extra columns are kept
up to the last stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewarden.llm.decontaminate import without_contaminated
from tidewarden.llm.frames import stored
from tidewarden.llm.jaccard import one_of_each
from tidewarden.llm.linespread import without_spread_lines
from tidewarden.llm.mixing import mixture
from tidewarden.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, learnt from the labels, does not reject."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten sites carry, in copies of a page as well."""
    return without_spread_lines(docs)


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each class of similar texts."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a benchmark item."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of each document."""
    return mixture(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("jaccard", jaccard),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The first stage is a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
