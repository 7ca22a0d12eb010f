"""Small helpers on DataFrames shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.functions.session import scratch_dir

# White space as the contracts name it: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later work no longer depends on its lineage."""
    path = f"{scratch_dir(df.sparkSession, purpose)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of the frame has it, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_of_id(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; null for a null id."""
    return F.crc32(doc_id.cast("string")) % modulus


def whole_text(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def row_key(*columns: Column) -> list[Column]:
    """Two 64-bit digests that stand for the values of a row; repeated rows have the same."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(0x5EED), *reversed(columns))]
