"""The registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm.alignment import alignment
from tidewarden.llm.decontaminate import contamination
from tidewarden.llm.divergence import divergence
from tidewarden.llm.htmlblocks import main_text
from tidewarden.llm.jaccard import near_duplicates
from tidewarden.llm.langid import identify
from tidewarden.llm.likelihood import likelihood
from tidewarden.llm.linespread import without_spread_lines
from tidewarden.llm.mixing import mixture
from tidewarden.llm.pii import personal_data
from tidewarden.llm.topk import top_k
from tidewarden.llm.toxicity import toxicity
from tidewarden.llm.winnowing import compared


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op3_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return likelihood(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_spread_lines(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_topk": op1_topk,
    "op2_pii": op2_pii,
    "op3_likelihood": op3_likelihood,
    "op4_toxicity": op4_toxicity,
    "op5_jaccard": op5_jaccard,
    "op6_decontamination": op6_decontamination,
    "op7_html": op7_html,
    "op8_line_dedup": op8_line_dedup,
    "op9_mixing": op9_mixing,
    "op10_language": op10_language,
    "op11_winnowing": op11_winnowing,
    "op12_alignment": op12_alignment,
    "op13_divergence": op13_divergence,
}
