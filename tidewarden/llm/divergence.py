"""Divergence of the sources of a language from each other and from the language, term by term.

The counting shuffles carry terms as 64-bit digests only. The spelling of the kept digests is gathered once per task
and digest as smallest and largest string; where the two differ, terms collide, and the documents are counted again for
these digests by the terms themselves. Text is joined back for the reported terms alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.llm.frames import stored
from tidewarden.llm.tokens import chunks, run_hashes, runs, string_bytes

SCALE = 1_000_000_000
# Counts below this times SCALE are exact in 64 bits.
MOST_COUNT = 9_000_000_000
TERM_BYTE = np.array([b > 127 or chr(b).isalpha() for b in range(256)])
LOWER = np.array([b + 32 if ord("A") <= b <= ord("Z") else b for b in range(256)], dtype=np.uint8)
CHUNK = 1 << 23


def terms(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct, codes, bounds): value i of the column has the terms `distinct[codes[bounds[i]:bounds[i + 1]]]`.

    A term is a run of ASCII letters, lower-cased, and of characters beyond ASCII, taken as they are.
    """
    data, offsets = string_bytes(column)
    data = LOWER[data]
    inside = TERM_BYTE[data]
    starts, stops = runs(inside, offsets[1:-1])
    ends = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(stops - starts, out=ends[1:])
    letters = pa.py_buffer(data[inside].tobytes())
    spelt = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.tobytes()), letters)
    encoded = spelt.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(), np.searchsorted(starts, offsets)


def digests(distinct: pa.Array, bits: int) -> np.ndarray:
    """A digest of `bits` bits of each term, as signed 64-bit numbers."""
    data, offsets = string_bytes(distinct)
    hashes = run_hashes(data, offsets[:-1], offsets[1:]) if len(data) else np.zeros(0, dtype=np.uint64)
    return (hashes >> np.uint64(64 - bits)).view(np.int64)


def _counts(lang: pa.Array, source: pa.Array, text: pa.Array, bits: int) -> tuple[pa.Array, list[pa.Array]]:
    """Distinct terms of some documents, and of each term and group: place of the term, lang, source, digest, n, docs."""
    distinct, codes, bounds = terms(text)
    lang_codes, source_codes = (c.dictionary_encode().indices.to_numpy().astype(np.int64) for c in (lang, source))
    group = lang_codes * len(source) + source_codes
    # Documents by group, so that a term's documents of one group are neighbours.
    order = np.argsort(group, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    each, n = np.unique(codes * np.int64(len(order)) + np.repeat(rank, np.diff(bounds)), return_counts=True)
    code, doc = each // len(order), order[each % len(order)]
    first = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(group[doc], prepend=-1) != 0))
    docs = np.diff(first, append=len(each))
    n = np.add.reduceat(n, first) if len(first) else n
    where = pa.array(doc[first])
    digest = digests(distinct, bits)[code[first]]
    return distinct, [pa.array(code[first]), lang.take(where), source.take(where), *map(pa.array, (digest, n, docs))]


def counted(slim: DataFrame, bits: int) -> DataFrame:
    """(lang, source, digest, n, docs): occurrences of a digest in a group, and how many documents have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in chunks(batch.column(2), CHUNK):
                _, (_, *columns) = _counts(*(batch.column(i).slice(low, high - low) for i in range(3)), bits)
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "digest", "n", "docs"])

    rows = slim.mapInArrow(count, "lang string, source string, digest long, n long, docs long")
    return rows.groupBy("lang", "source", "digest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _marks(kept: DataFrame, log_words: int = 20) -> np.ndarray:
    """A bit for the low bits of each digest, 8 MB whatever their number: a digest without its bit is not among them."""
    word = F.shiftright("digest", 6).bitwiseAND(F.lit((1 << log_words) - 1))
    bit = F.expr("shiftleft(1L, cast(digest & 63 as int))")
    rows = kept.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    marks = np.zeros(1 << log_words, dtype=np.int64)
    marks[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return marks


def _marked(marks: np.ndarray, digest: np.ndarray) -> np.ndarray:
    return (marks[(digest >> 6) & (len(marks) - 1)] >> (digest & 63)) & 1 == 1


def spellings(slim: DataFrame, kept: DataFrame, bits: int) -> DataFrame:
    """(digest, low, high): the smallest and the largest term of each kept digest, of some others too."""
    sent = slim.sparkSession.sparkContext.broadcast(_marks(kept))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in chunks(batch.column(0), CHUNK):
                distinct, *_ = terms(batch.column(0).slice(low, high - low))
                digest = digests(distinct, bits)
                some = np.flatnonzero(_marked(sent.value, digest))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest[some]), distinct.take(pa.array(some)).cast(pa.string())], names=["digest", "term"]
                )

    rows = slim.select("text").mapInArrow(spell, "digest long, term string")
    return rows.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high"))


def recounted(slim: DataFrame, collided: DataFrame, bits: int) -> DataFrame:
    """(lang, source, digest, term, n, docs): counts of the collided digests by the terms themselves."""
    sent = slim.sparkSession.sparkContext.broadcast(_marks(collided))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in chunks(batch.column(2), CHUNK):
                distinct, (code, lang, source, digest, n, docs) = _counts(*(batch.column(i).slice(low, high - low) for i in range(3)), bits)
                some = pa.array(np.flatnonzero(_marked(sent.value, digest.to_numpy())))
                columns = [c.take(some) for c in (lang, source, digest, distinct.take(code).cast(pa.string()), n, docs)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "digest", "term", "n", "docs"])

    rows = slim.mapInArrow(count, "lang string, source string, digest long, term string, n long, docs long")
    rows = rows.join(collided.select("digest"), "digest", "left_semi")
    return rows.groupBy("lang", "source", "digest", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _per_term(counts: DataFrame, keys: list[str], least_docs: int) -> DataFrame:
    """One row for each kept term of a language: n in the language, and `entries` with n of each of its sources.

    A list is no longer than the sources of its language, whose pairs are all reported.
    """
    by_term = counts.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("entries")
    )
    return by_term.filter(F.col("docs") >= least_docs).drop("docs")


def kept_terms(slim: DataFrame, least_docs: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """(kept, spelt): (lang, digest, split, n, entries), `split` the term where its digest is shared; (digest, term)."""
    kept = stored(_per_term(counted(slim, bits), ["lang", "digest"], least_docs), "divergence-terms")
    spelt = stored(spellings(slim, kept, bits), "divergence-spelt")
    collided = stored(spelt.filter("low != high").select("digest"), "divergence-collided")
    kept = kept.select("lang", "digest", F.lit(None).cast("string").alias("split"), "n", "entries")
    if not collided.isEmpty():
        again = _per_term(recounted(slim, collided, bits), ["lang", "digest", "term"], least_docs)
        whole = kept.join(collided, "digest", "left_anti").select(kept.columns)
        kept = stored(whole.unionByName(again.withColumnRenamed("term", "split")), "divergence-split")
    return kept, spelt.select("digest", F.col("low").alias("term"))


def _group_totals(slim: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, vocabulary) of each group that occurs; 0 where nothing was kept."""
    entries = kept.select("lang", F.inline("entries"))
    by_group = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("vocabulary"))
    groups = slim.select("lang", "source").distinct().join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
    return groups.fillna(0, ["total", "lang_total", "vocabulary"])


def _share(n: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + vocabulary)), exactly."""
    small = F.expr(f"{SCALE}L") * (n + 1)
    large = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    whole = total + vocabulary
    return 1 + F.when(n < MOST_COUNT, F.call_function("div", small, whole)).otherwise(
        F.call_function("div", large, whole.cast("decimal(20,0)"))
    )


def _shares(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    if len(n) and n.max() >= MOST_COUNT:
        return np.array([1 + SCALE * (int(a) + 1) // int(b) for a, b in zip(n, whole, strict=True)], dtype=np.int64)
    return 1 + SCALE * (n + 1) // whole


def _between(kept: DataFrame, totals: DataFrame, terms_per_part: int, cells: int = 1 << 20) -> DataFrame:
    """(lang, source, item, value): divergence of each source from each other source of its language.

    The terms of a language are dealt to parts, each with the list of the sources. A task adds up its part in
    matrices of terms and sources; a source's absent terms have the share of the count 0.
    """

    def add(key: tuple, part: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("source")
        names = groups.column("source").combine_chunks()
        whole = groups.column("total").to_numpy() + groups.column("vocabulary").to_numpy()
        n, sums = len(names), np.zeros((len(names), len(names)), dtype=np.int64)
        entries = part.column("entries").combine_chunks()
        entries = entries.chunk(0) if isinstance(entries, pa.ChunkedArray) else entries
        rows = max(1, cells // max(1, n))
        for low in range(0, len(entries), rows):
            some = entries.slice(low, rows)
            flat, bounds = some.flatten(), some.offsets.to_numpy()
            row = np.repeat(np.arange(len(some)), np.diff(bounds))
            column = pc.index_in(flat.field("source"), names).to_numpy()
            # Shares of absent terms; SCALE * 1 is small.
            share = np.repeat((1 + SCALE // whole)[None, :], len(some), axis=0)
            share[row, column] = _shares(flat.field("n").to_numpy(), whole[column])
            for j in range(n):
                other = share[:, j : j + 1]
                sums[:, j] += ((share - other) ** 2 // other).sum(axis=0)
        i, j = np.nonzero(~np.eye(n, dtype=bool))
        return pa.table(
            {"lang": pa.array([key[0].as_py()] * len(i), pa.string()), "source": names.take(pa.array(i)), "item": names.take(pa.array(j)), "value": sums[i, j]}
        )

    parts = max(1, -(-kept.count() // terms_per_part))
    number = F.pmod(F.xxhash64("digest", "split"), F.lit(parts)).cast("int")
    dealt = kept.select("lang", "entries", number.alias("part")).groupBy("lang", "part")
    everywhere = totals.select("lang", "source", "total", "vocabulary", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    sums = dealt.cogroup(everywhere.groupBy("lang", "part")).applyInArrow(add, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, least_docs: int = 3, most_terms: int = 200, bits: int = 64, terms_per_part: int = 4000) -> DataFrame:
    """(lang, source, part, item, value, rank): how the groups (lang, source) differ in the terms of the language.

    A language keeps the terms found in at least `least_docs` of its documents. A group's share of a term is p =
    1 + floor(10^9 * (count + 1) / (N + V)), N its kept occurrences, V the kept terms of the language, and so is the
    language's; the difference of p from q is floor((p - q)^2 / q). Part `pair`: the differences from every other source
    of the language, summed over the kept terms. Part `term`: the differences from the language of the terms that the group
    has and uses more, the first `most_terms` of them. Ranks are by value, then by item in the order of UTF-8.

    A null text, lang or source is an empty one; a group without terms has rows of part `pair` only, a language with
    a single source none of these; repeated rows count as documents of their own; an empty table gives an empty result.
    Other columns are not read.
    """
    slim = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept, spelt = kept_terms(slim, least_docs, bits)
    totals = stored(_group_totals(slim, kept), "divergence-groups")
    pairs = _ranked(_between(kept, totals, terms_per_part)).withColumn("part", F.lit("pair"))
    entries = kept.select("lang", "digest", "split", F.col("n").alias("lang_n"), F.inline("entries")).join(totals, ["lang", "source"])
    shares = entries.select(
        "lang", "source", "digest", "split",
        _share(F.col("n"), F.col("total"), F.col("vocabulary")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("vocabulary")).alias("q"),
    ).filter("p > q")
    valued = shares.select("lang", "source", "digest", "split", F.expr("(p - q) * (p - q) div q").alias("value"))
    # With ties at the last place: only their text can tell them apart.
    near = F.rank().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc()))
    first = valued.withColumn("near", near).filter(F.col("near") <= most_terms).drop("near")
    told = first.join(spelt, "digest").select("lang", "source", F.coalesce("split", "term").alias("item"), "value")
    reported = _ranked(told).filter(F.col("rank") <= most_terms).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(reported.select(columns))
