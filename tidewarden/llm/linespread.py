"""Removing lines that many sites carry, by HyperLogLog sketches of distinct sites per line.

Every line is known by a 64-bit hash of its trimmed text. A line's spread is the number of distinct sites among
the texts that hold it. Where a page copied as a whole is to be no boilerplate, the number of distinct texts can be
asked for as well.
Sketches are built per line and task and merged by aggregation, so a frequent line sends one row per task. An estimate
clearly above or below the threshold decides; for the lines near it sites (and texts) are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.frames import free_name, row_key, stored, whole_text


def _lines(text: Column) -> Column:
    return F.split(whole_text(text), "\n", -1)


def _hash(line: Column) -> Column:
    """The hash of a line's trimmed text; null for lines without any."""
    bare = F.btrim(line, F.lit(" \t\r\x0b\x0c"))
    return F.when(bare != "", F.xxhash64(bare))


def _occurrences(docs: DataFrame) -> DataFrame:
    """(line, site, words, place, row_a, row_b): one row for each distinct line of each document."""
    a, b = row_key(F.col("doc_id"), F.col("source"), F.col("text"))
    keyed = docs.select(
        F.xxhash64(F.lit(1), F.col("source")).alias("site"),
        F.xxhash64(F.col("text")).alias("words"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("place"),
        a.alias("row_a"),
        b.alias("row_b"),
        F.array_distinct(F.transform(_lines(F.col("text")), _hash)).alias("lines"),
    )
    return keyed.select("site", "words", "place", "row_a", "row_b", F.explode("lines").alias("line")).filter("line is not null")


def spread_lines(
    occurrences: DataFrame, sites: int, lg_k: int = 10, band: float = 0.15, salts: int = 16, distinct_texts: bool = False
) -> DataFrame:
    """(line): the lines on at least `sites` distinct sites and, with `distinct_texts`, in as many distinct texts.

    The relative error of a sketch is about 1.04 / sqrt(2 ** lg_k), 3 % by default; `band` is several times that.
    """
    counted = ["site", "words"] if distinct_texts else ["site"]
    sketches = [F.hll_sketch_estimate(F.hll_sketch_agg(c, lg_k)) for c in counted]
    estimates = occurrences.groupBy("line").agg((F.least(*sketches) if distinct_texts else sketches[0]).alias("estimate"))
    low, high = sites * (1 - band), sites * (1 + band)
    estimated = stored(estimates.filter(F.col("estimate") >= low), "line-spread")
    sure = estimated.filter(F.col("estimate") > high).select("line")
    # A line near the threshold may still be very frequent: its rows are dealt out by document as well.
    near = estimated.filter(F.col("estimate") <= high).select("line", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    dealt = occurrences.select("line", "site", "words", F.pmod("row_b", F.lit(salts)).cast("int").alias("salt"))
    close = dealt.join(near, ["line", "salt"], "left_semi")
    # Distinct pairs first: a frequent line sends no more than one row per task, site and text.
    by_site = close.select("line", "site").distinct().groupBy("line").agg(F.count("*").alias("n")).filter(F.col("n") >= sites)
    if not distinct_texts:
        return sure.unionByName(by_site.select("line"))
    by_words = close.select("line", "words").distinct().groupBy("line").agg(F.count("*").alias("n")).filter(F.col("n") >= sites)
    exact = by_site.select("line").join(by_words.select("line"), "line", "left_semi")
    return sure.unionByName(exact)


def without_spread_lines(
    docs: DataFrame, sites: int = 10, lg_k: int = 10, keep_first: bool = True, distinct_texts: bool = False
) -> DataFrame:
    """The documents without their boilerplate lines: the columns and rows of `docs`, `text` changed.

    A line found on at least `sites` sites is removed, every time it occurs, in pages copied to many sites as well;
    with `distinct_texts` it must be in as many different texts too. With `keep_first` the document of the smallest id
    that has it keeps it, so no content leaves the corpus altogether. Blank lines stay. A null text stays null and has
    no lines; an empty one stays empty; a document that consists of such lines alone keeps its row with an empty text; a
    null source is a site, a null id comes last; repeated rows are treated alike. An empty table gives an empty result. An
    `n_chars` column is set anew.
    """
    occurrences = _occurrences(docs.select("doc_id", "source", "text"))
    spread = stored(spread_lines(occurrences, sites, lg_k, distinct_texts=distinct_texts), "spread-lines")
    found = stored(occurrences.join(spread, "line", "left_semi").select("line", "place", "row_a", "row_b"), "spread-found")
    if keep_first:
        first = found.groupBy("line").agg(F.min(F.struct("place", "row_a", "row_b")).alias("first"))
        first = first.select("line", "first.row_a", "first.row_b")
        found = found.join(first, ["line", "row_a", "row_b"], "left_anti")
    drop_name = free_name(docs, "lines_dropped")
    a_name, b_name = free_name(docs, "row_a"), free_name(docs, "row_b")
    by_row = found.groupBy(F.col("row_a").alias(a_name), F.col("row_b").alias(b_name)).agg(F.collect_set("line").alias(drop_name))
    a, b = row_key(F.col("doc_id"), F.col("source"), F.col("text"))
    joined = docs.withColumns({a_name: a, b_name: b}).join(stored(by_row, "spread-rows"), [a_name, b_name], "left")
    # The lines and their hashes side by side, so that neither is computed again for each line.
    lines = _lines(F.col("text"))
    pairs = F.arrays_zip(lines.alias("words"), F.transform(lines, _hash).alias("line"))
    stay = F.filter(pairs, lambda x: x["line"].isNull() | ~F.array_contains(F.col(drop_name), x["line"]))
    cleaned = F.array_join(F.transform(stay, lambda x: x["words"]), "\n")
    unchanged = F.col(drop_name).isNull()
    out = joined.withColumn("text", F.when(unchanged, F.col("text")).otherwise(cleaned))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(unchanged, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)
