"""Small tables for the corpus operators: every edge case in one, and a corpus with hot groups."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that users may have and that operators use as names inside.
CLASHING = ("row_a", "row_b", "line", "lines_dropped", "hits", "toxicity", "Row", "size", "word", "pii_row", "key", "tie", "bin", "pairs", "digest", "rank")
WORDS = [a + b for a in ("ba", "ce", "di", "fo", "gu", "la", "mer", "nit", "sol", "tra") for b in ("n", "rk", "lo", "st", "mu", "xi")]


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows (doc_id, text, lang, source)."""
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], DOCUMENT)


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, texts without words, repeated rows, a repeated id."""
    rng = random.Random(4)
    same = sentence(rng, 40)
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n ", "en", None),
        (4, "...!?", None, "b"),
        (None, sentence(rng, 30), "en", "a"),
        (None, None, None, None),
        (5, sentence(rng, 60_000), "en", "a"),
        (6, "x" * 150_000, "en", "c"),
        (7, "1 " * 50_000, None, "c"),
        (8, same, "en", "a"),
        (8, same, "en", "a"),
        (9, same, "de", "b"),
        (9, sentence(rng, 12), "de", "b"),
        (10, "Ünï 😀 cödé \x00 ́ 漢字", "en", "z"),
    ]


def odd_documents(spark: SparkSession) -> DataFrame:
    return documents(spark, odd_rows())


def clashing(df: DataFrame) -> DataFrame:
    """The table with further columns whose names the operators use themselves."""
    taken = {c.lower() for c in df.columns}
    return df.selectExpr("*", *[f"'{c}' as `{c}`" for c in CLASHING if c.lower() not in taken])


def empty_documents(spark: SparkSession) -> DataFrame:
    return documents(spark, [])


def rows_of(df: DataFrame) -> list[tuple]:
    """All rows in one order, whatever their partitions."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
