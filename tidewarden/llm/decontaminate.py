"""Benchmark decontamination by spaced seeds.

A seed is a hash of the words at the selected places of a window; the other places are ignored, so a window matches
although words there were replaced. The seeds of all windows of the documents are joined to those of the test items
in the tasks that read the documents. Around each hit the two word sequences are laid side by side, and the best
of the segments that are long enough counts if it is nearly equal.

The seeds lose nothing at an identity of 0.8: segments without four equal words in a row have three unequal words at
most, so at most 15 words, and the other masks cover these.

Test items of a bounded number of words in all are sent to the tasks as a whole, and the documents are not shuffled. A
larger benchmark stays distributed: its seeds meet those of the documents in a join, each document then meets the items
with which it shares a seed, and the overlaps are searched among these alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.llm.frames import free_name, stored, whole_text
from tidewarden.llm.jaccard import bitmap_of, marked
from tidewarden.llm.tokens import STEP, chunks, mixed, words

# 1: the word counts, 0: any word may stand there.
MASKS = ("1111", "11011")
# For items of just their length.
SHORT_MASKS = ("10111", "11101")
# Shares of equal words are compared in whole numbers of this size.
UNIT = 1_000_000

HIT = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("words", T.LongType()),
        T.StructField("equal", T.LongType()),
    ]
)


@dataclass
class Rule:
    masks: tuple[str, ...] = MASKS
    short_masks: tuple[str, ...] = SHORT_MASKS
    least_words: int = 13
    identity: float = 0.8
    shortest_item: int = 5

    def all_masks(self) -> list[str]:
        """Items too short for the masks are looked for as they are."""
        return [*self.masks, *self.short_masks, *("1" * n for n in range(self.shortest_item, min(map(len, self.masks))))]


def _seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """One hash per window, beginning at every word that has enough words after it."""
    n = len(hashes) - len(mask) + 1
    out = np.full(max(n, 0), len(mask), dtype=np.uint64)
    factor = int(STEP)
    for place, counts in enumerate(mask):
        if counts == "1" and n > 0:
            out += hashes[place : place + n] * np.uint64(factor)
        factor = (factor * int(STEP) + 2) % (1 << 64) | 1
    return mixed(out)


def _item_seeds(hashes: np.ndarray, bounds: np.ndarray, rule: Rule) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """(mask, seeds, first word of each, item of each) of the windows in which items are looked for."""
    lengths = np.diff(bounds)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    for mask in rule.all_masks():
        seeds = _seeds(hashes, mask)
        at = np.arange(len(seeds))
        inside = owner[at] == owner[at + len(mask) - 1]
        own_length = lengths[owner[at]]
        inside &= (own_length >= max(rule.shortest_item, len(mask))) if mask in rule.masks else (own_length == len(mask))
        yield mask, seeds[inside], at[inside], owner[at[inside]]


class Index:
    """The seeds of some test items."""

    def __init__(self, ids: list[int], texts: pa.Array, rule: Rule):
        self.rule, self.ids = rule, ids
        self.hashes, self.bounds, *_ = words(texts)
        lengths = np.diff(self.bounds)
        self.need = np.minimum(lengths, rule.least_words)
        self.tables: list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for mask, seeds, at, owner in _item_seeds(self.hashes, self.bounds, rule):
            order = np.argsort(seeds, kind="stable")
            bits = 1 << max(10, math.ceil(math.log2(16 * len(seeds) + 1)))
            seen = np.zeros(bits, dtype=bool)
            seen[(seeds & np.uint64(bits - 1)).astype(np.int64)] = True
            if len(seeds):
                self.tables.append((mask, seeds[order], at[order], owner[order], seen))

    def found(self, hashes: np.ndarray, bounds: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
        """For each text with an overlap, by place: (item id, first word, words, equal words), the longest of each item."""
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        texts, items, shifts = [], [], []
        for mask, seeds, at, item, seen in self.tables:
            own = _seeds(hashes, mask)
            likely = np.flatnonzero(seen[(own & np.uint64(len(seen) - 1)).astype(np.int64)])
            likely = likely[owner[likely] == owner[likely + len(mask) - 1]]
            low = np.searchsorted(seeds, own[likely], side="left")
            high = np.searchsorted(seeds, own[likely], side="right")
            n = high - low
            hit = np.repeat(likely, n)
            place = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            texts.append(owner[hit])
            items.append(item[place])
            # Where the item's first word would stand in the text.
            shifts.append(hit - bounds[owner[hit]] - (at[place] - self.bounds[item[place]]))
        if not texts:
            return {}
        lanes = np.unique(np.stack([np.concatenate(c) for c in (texts, items, shifts)], axis=1), axis=0)
        best: dict[tuple[int, int], list[int]] = {}
        for text, item, *overlap in self._overlaps(hashes, bounds, lanes):
            # Of an item's overlaps the longest, the first of equally long ones.
            if (text, item) not in best or overlap[1] > best[text, item][1]:
                best[text, item] = overlap
        out: dict[int, list[tuple[int, int, int, int]]] = {}
        for (text, item), overlap in best.items():
            out.setdefault(text, []).append((self.ids[item], *overlap))
        return out

    def _overlaps(self, hashes: np.ndarray, bounds: np.ndarray, lanes: np.ndarray, cells: int = 1 << 20) -> list[list[int]]:
        """(text, item, first word, words, equal words) of each lane whose best segment counts, in the lanes' order.

        Of all segments with enough words that is the one in which the equal words exceed the needed share the most.
        """
        text, item, shift = lanes.T
        low = np.maximum(0, shift)
        size = np.minimum(bounds[text + 1] - bounds[text], shift + np.diff(self.bounds)[item]) - low
        need = self.need[item]
        share = round(self.rule.identity * UNIT)
        out = []
        long = size >= need
        for n, least in np.unique(np.stack([size[long], need[long]], axis=1), axis=0).tolist():
            alike = np.flatnonzero((size == n) & (need == least))
            rows = max(1, cells // n)
            for at in (alike[i : i + rows] for i in range(0, len(alike), rows)):
                there = (bounds[text[at]] + low[at])[:, None] + np.arange(n)
                here = (self.bounds[item[at]] + low[at] - shift[at])[:, None] + np.arange(n)
                equal = hashes[there] == self.hashes[here]
                upto = np.zeros((len(at), n + 1), dtype=np.int64)
                np.cumsum(np.where(equal, UNIT - share, -share), axis=1, out=upto[:, 1:])
                gain = upto[:, least:] - np.minimum.accumulate(upto[:, : n + 1 - least], axis=1)
                last = np.argmax(gain, axis=1)
                for row in np.flatnonzero(gain[np.arange(len(at)), last] >= 0).tolist():
                    end = int(last[row]) + least
                    begin = int(np.argmin(upto[row, : end - least + 1]))
                    lane, n_equal = int(at[row]), int(equal[row, begin:end].sum())
                    out.append([lane, int(text[lane]), int(item[lane]), int(low[lane]) + begin, end - begin, n_equal])
        return [found[1:] for found in sorted(out)]


def _size(text: Column) -> Column:
    """The bytes of a text; a word has five and more, in scripts without blanks about three."""
    return F.octet_length(text)


def _sent(rows: DataFrame, items: DataFrame, text: str, name: str, rule: Rule) -> DataFrame:
    """`rows` with the overlaps, found in the tasks that read them: all items are sent to each."""
    bench = items.toArrow().sort_by("item_id")
    column = bench.column("text").cast(pa.large_string()).combine_chunks()
    texts = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    sent = rows.sparkSession.sparkContext.broadcast((bench.column("item_id").to_pylist(), texts))
    out = rows.select("*", F.array().cast(T.ArrayType(HIT)).alias(name))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*sent.value, rule)
        for batch in batches:
            *kept, before = batch.columns
            texts = batch.column(text)
            hits = before.to_pylist()
            for low, high in chunks(texts):
                values, bounds, *_ = words(texts.slice(low, high - low))
                for place, found in index.found(values, bounds).items():
                    hits[low + place] = [dict(zip(HIT.names, x, strict=True)) for x in found]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(hits, before.type)], names=batch.schema.names)

    return out.mapInArrow(search, out.schema)


def _seeds_of_items(items: DataFrame, rule: Rule) -> DataFrame:
    """(item, seed), each once, of rows (item, item_id, text)."""

    def seeds_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in chunks(batch.column(1)):
                values, bounds, *_ = words(batch.column(1).slice(low, high - low))
                for _, seeds, _, owner in _item_seeds(values, bounds, rule):
                    item = batch.column(0).take(pa.array(low + owner))
                    yield pa.RecordBatch.from_arrays([item, pa.array(seeds.view(np.int64))], names=["item", "seed"])

    return items.select("item", "text").mapInArrow(seeds_of, "item long, seed long").distinct()


def _seeds_of_docs(texts: DataFrame, bitmap: np.ndarray, rule: Rule) -> DataFrame:
    """(row, seed), each once, of rows (row, text), of the seeds that the bitmap marks."""
    sent = texts.sparkSession.sparkContext.broadcast(bitmap)

    def seeds_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in chunks(batch.column(1)):
                values, bounds, *_ = words(batch.column(1).slice(low, high - low))
                owner = np.repeat(np.arange(high - low), np.diff(bounds))
                for mask in rule.all_masks():
                    seeds = _seeds(values, mask).view(np.int64)
                    at = np.flatnonzero(marked(sent.value, seeds))
                    at = at[owner[at] == owner[at + len(mask) - 1]]
                    once = np.unique(np.stack([owner[at], seeds[at]], axis=1), axis=0)
                    row = batch.column(0).take(pa.array(low + once[:, 0]))
                    yield pa.RecordBatch.from_arrays([row, pa.array(once[:, 1])], names=["row", "seed"])

    return texts.mapInArrow(seeds_of, "row long, seed long")


def _joined(rows: DataFrame, items: DataFrame, text: str, name: str, rule: Rule, pack_bytes: int) -> DataFrame:
    """`rows` with the overlaps, however many items there are: nothing of the benchmark but a bitmap passes the driver.

    The items that share a seed with a document are dealt to packs of about `pack_bytes`, and the document is searched
    for one pack at a time. A seed that is frequent on both sides makes a candidate of each document and item that have it.
    """
    row = free_name(rows, "row_to_search")
    rows = stored(rows.withColumn(row, F.monotonically_increasing_id()), "decontaminate-docs")
    items = stored(items.withColumn("item", F.monotonically_increasing_id()), "decontaminate-items")
    item_seeds = stored(_seeds_of_items(items, rule), "decontaminate-seeds")
    texts = rows.select(F.col(row).alias("row"), F.col(text).alias("text"))
    doc_seeds = _seeds_of_docs(texts, bitmap_of(item_seeds.select("seed").distinct(), "seed"), rule)
    candidates = doc_seeds.join(item_seeds, "seed").select("row", "item").distinct().join(items, "item")
    before = Window.partitionBy("row").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    pack = F.floor(F.coalesce(F.sum(_size(F.col("text"))).over(before), F.lit(0)) / pack_bytes)
    packs = candidates.withColumn("pack", pack).groupBy("row", "pack").agg(F.collect_list(F.struct("item_id", "text")).alias("items"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, hits = [], []
            for k in range(len(batch)):
                bench = batch.column(2).slice(k, 1).flatten()
                index = Index(bench.field("item_id").to_pylist(), bench.field("text").cast(pa.large_string()), rule)
                values, bounds, *_ = words(batch.column(1).slice(k, 1))
                for found in index.found(values, bounds).values():
                    at.append(k)
                    hits.append([dict(zip(HIT.names, x, strict=True)) for x in found])
            kind = pa.list_(pa.struct([(field, pa.int64()) for field in HIT.names]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(hits, kind)], names=["row", "hits"])

    shape = T.StructType([T.StructField("row", T.LongType()), T.StructField("hits", T.ArrayType(HIT))])
    searched = texts.join(packs, "row").select("row", "text", "items").mapInArrow(search, shape)
    hits = searched.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
    # Its size is known once it is stored: few hits are broadcast, many are joined.
    hits = stored(hits, "decontaminate-hits").select(F.col("row").alias(row), F.col("hits").alias(name))
    none = F.array().cast(T.ArrayType(HIT))
    kept = [c for c in rows.columns if c != row]
    return rows.join(hits, row, "left").select(*kept, F.coalesce(F.col(name), none).alias(name))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, name: str, rule: Rule | None = None, sent_bytes: int = 10_000_000, pack_bytes: int = 20_000
) -> DataFrame:
    """The rows and columns of `docs` with `name`: an array of (item_id, start, words, equal), one for each item found.

    An item is found in a text where, on one alignment, a segment of at least `least_words` words (or the whole item,
    if it is shorter) agrees in `identity` of them; the longest on any alignment is told, `start` counts words from 0.
    Words are those of `tokens.words`. Items of fewer than `shortest_item` words are not sought. With the given masks
    nothing is missed at an identity of 0.8 or more and a `least_words` of 6 or more. A null or empty text has no overlap;
    null items are left out; of an item id that repeats each text counts. The items are measured first: up to `sent_bytes`
    (some two million words) are sent to the tasks, more are joined.
    """
    rule = rule or Rule()
    text = free_name(docs, "text_to_search")
    items = benchmark.filter("item_id is not null and text is not null").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    rows = docs.select("*", whole_text(F.col("text")).alias(text))
    if (items.agg(F.sum(_size(F.col("text")))).first()[0] or 0) <= sent_bytes:
        return _sent(rows, items, text, name, rule).drop(text)
    return _joined(rows, items, text, name, rule, pack_bytes).drop(text)


def contamination(docs: DataFrame, benchmark: DataFrame, rule: Rule | None = None) -> DataFrame:
    """(doc_id, contaminated, item_ids, n_items, longest) for each row, see `overlaps`.

    `item_ids` are the distinct items found, ascending; `longest` is the number of words of the longest overlap, 0 if
    there is none. An empty table of documents gives an empty result, an empty benchmark finds nothing.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = overlaps(slim, benchmark, "hits", rule)
    ids = F.array_sort(F.array_distinct(F.col("hits.item_id")))
    return found.select(
        "doc_id",
        (F.size("hits") > 0).alias("contaminated"),
        ids.alias("item_ids"),
        F.size(ids).alias("n_items"),
        F.coalesce(F.array_max(F.col("hits.words")), F.lit(0)).alias("longest"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, rule: Rule | None = None) -> DataFrame:
    """The rows and columns of `docs` in which no test item is found."""
    name = free_name(docs, "hits")
    return overlaps(docs, benchmark, name, rule).filter(F.size(name) == 0).select(*docs.columns)
