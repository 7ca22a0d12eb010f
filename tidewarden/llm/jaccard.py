"""Similarity join of texts on word shingles, with Bayesian pruning of candidate pairs.

1. Texts of the same words are one text from here on: copies are counted and never paired.
2. Each text gets MinHash values of its shingles. Texts whose values agree on a band are candidates; bands that only
   one text has are left out at once.
3. Candidates that hang together form a pool (connected components over band buckets, one row per text and bucket,
   never per pair). Pools are independent; a large one is cut into blocks and every pair of blocks is one unit of work.
4. In a unit, pairs of a pool compare their MinHash values a few at a time. With m of n values equal, the similarity
   has the posterior Beta(m + 1, n - m + 1); a pair is dropped when the probability of reaching the threshold falls
   below the tolerance. The rest is verified exactly on the shingle sets. A unit gives the number of
   links of each of its texts and a spanning tree of them, not the pairs.
5. Links add up over units; the trees give the classes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.frames import free_name, row_key, stored
from tidewarden.llm.tokens import MIX, STEP, chunks, mixed, shingles, words


def _multipliers(n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, n, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def _distinct(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values once, in ascending order."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    out = np.zeros(len(bounds), dtype=np.int64)
    np.cumsum(np.bincount(owner[new], minlength=len(bounds) - 1), out=out[1:])
    return hashes[new], out


def _list(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def signatures(texts: DataFrame, size: int, hashes: int, band_rows: int) -> DataFrame:
    """(text_a, text_b, n_words, bands, place, row_a, row_b) of (text, place, row_a, row_b).

    `text_a`, `text_b` are digests of the words; `bands` one digest for each `band_rows` MinHash values, none for a
    text without words.
    """
    factors = _multipliers(hashes)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in chunks(batch.column(0)):
                values, bounds, *_ = words(batch.column(0).slice(low, high - low))
                a, b = text_digests(values, bounds)
                made, ends = shingles(values, bounds, size)
                minima = min_values(made, ends, factors)
                bands = band_digests(minima, band_rows)
                filled = np.diff(ends) > 0
                band_bounds = np.concatenate([[0], np.cumsum(filled * bands.shape[1])])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                        pa.array(np.diff(bounds)),
                        _list(bands[filled].ravel().view(np.int64), band_bounds, pa.int64()),
                        *[batch.column(c).slice(low, high - low) for c in (1, 2, 3)],
                    ],
                    names=["text_a", "text_b", "n_words", "bands", "place", "row_a", "row_b"],
                )

    shape = "text_a long, text_b long, n_words long, bands array<long>, place long, row_a long, row_b long"
    return texts.select("text", "place", "row_a", "row_b").mapInArrow(signed, shape)


def text_digests(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each row's sequence of words."""
    place = np.arange(len(values), dtype=np.uint64) - np.repeat(bounds[:-1], np.diff(bounds)).astype(np.uint64)
    out = []
    for salt in (STEP, MIX):
        upto = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(mixed(values + (place + np.uint64(1)) * salt), dtype=np.uint64, out=upto[1:])
        out.append(mixed(upto[bounds[1:]] - upto[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))
    return out[0], out[1]


def min_values(made: np.ndarray, bounds: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """MinHash values, rows x hash functions, as 32 bits; zeros for rows without shingles."""
    out = np.zeros((len(bounds) - 1, len(factors)), dtype=np.uint32)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        product = np.empty_like(made)
        for k, factor in enumerate(factors):
            np.multiply(made, factor, out=product)
            out[filled, k] = np.minimum.reduceat(product, bounds[filled]) >> np.uint64(32)
    return out


def band_digests(minima: np.ndarray, band_rows: int) -> np.ndarray:
    """One 64-bit digest for each band of each row; equal values in different bands differ."""
    n_bands = minima.shape[1] // band_rows
    values = minima[:, : n_bands * band_rows].reshape(len(minima), n_bands, band_rows).astype(np.uint64)
    digests = np.broadcast_to(np.arange(1, n_bands + 1, dtype=np.uint64) * STEP, values.shape[:2]).copy()
    for k in range(band_rows):
        digests = mixed(digests + values[:, :, k] * MIX)
    return digests


def least_equal(threshold: float, tolerance: float, steps: list[int]) -> list[int]:
    """For each number n of compared values, the fewest equal ones for which a pair is kept.

    With a uniform prior, P(similarity >= t | m of n equal) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in steps:
        reached, m = 0.0, -1
        while reached < tolerance and m <= n:
            m += 1
            reached += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def components(edges: DataFrame, purpose: str, most_rounds: int = 40) -> DataFrame:
    """(node, root) for each node of the undirected (a, b), root being the least node it hangs together with.

    Every node hooks onto its least smaller neighbour, chains of hooks are followed to their ends by doubling, and the
    edges are carried over to these ends; edges within one tree fall away, so each round has fewer. A node of very
    many edges is no group: minima are combined before the shuffle.
    """
    turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    left = stored(turned.distinct(), purpose)
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    labels = stored(nodes.withColumn("root", F.col("node")), purpose)
    for _ in range(most_rounds):
        if left.isEmpty():
            return labels
        trees = _followed(stored(left.groupBy("a").agg(F.min("b").alias("b")), purpose), purpose)
        ends = trees.select(F.col("a").alias("from"), F.col("b").alias("end"))
        labels = labels.join(ends, F.col("root") == F.col("from"), "left")
        labels = stored(labels.select("node", F.coalesce("end", "root").alias("root")), purpose)
        moved = left.join(ends, F.col("a") == F.col("from")).select(F.col("end").alias("a"), "b")
        moved = moved.join(ends, F.col("b") == F.col("from"), "left").select("a", F.coalesce("end", "b").alias("b"))
        turned = moved.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        left = stored(turned.distinct(), purpose)
    raise RuntimeError(f"edges are left after {most_rounds} rounds")


def _followed(hooks: DataFrame, purpose: str, most_rounds: int = 64) -> DataFrame:
    """(a, b) with every chain of hooks followed to its end; a hook's b is always smaller than its a."""
    for _ in range(most_rounds):
        ahead = hooks.select(F.col("a").alias("b"), F.col("b").alias("next"))
        longer = stored(hooks.join(ahead, "b", "left").select("a", F.coalesce("next", "b").alias("b"), F.col("next").isNotNull().alias("moved")), purpose)
        hooks = longer.select("a", "b")
        if longer.filter("moved").isEmpty():
            return hooks
    raise RuntimeError(f"chains are longer than 2 ** {most_rounds}")


def bitmap_of(wanted: DataFrame, key: str, most_bits: int = 1 << 28) -> np.ndarray:
    """Bits of the distinct keys of `wanted`, see `marked`: 16 bits a key, `most_bits` (32 MB) at most."""
    bits = 1 << 15
    while bits < min(most_bits, 16 * wanted.count()):
        bits *= 2
    place = F.pmod(F.col(key), F.lit(bits)) + 1
    parts = wanted.select(place.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("part"))
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for part in parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("set")).collect():
        low = (part.part - 1) << 12
        bitmap[low : low + (1 << 12)] = np.frombuffer(part.set, dtype=np.uint8)
    return bitmap


def marked(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be among those of the bitmap."""
    at = keys & (8 * len(bitmap) - 1)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def possible(rows: DataFrame, wanted: DataFrame, key: str, most_bits: int = 1 << 28) -> DataFrame:
    """The rows whose `key` may be among the keys of `wanted`, which are distinct: none is lost, some others stay.

    Beyond the keys that `most_bits` is enough for more rows stay.
    """
    sent = rows.sparkSession.sparkContext.broadcast(bitmap_of(wanted, key, most_bits))
    column = rows.columns.index(key)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marked(sent.value, batch.column(column).to_numpy())))

    return rows.mapInArrow(passed, rows.schema)


class Unit:
    """The texts of one or two blocks of a pool, and the links among them."""

    def __init__(self, sets: list[np.ndarray], minima: np.ndarray, threshold: float, tolerance: float, step: int):
        self.minima, self.threshold, self.step = minima, threshold, step
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        _, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.marked = np.zeros(int(self.flat.max(initial=-1)) + 1, dtype=np.int64)
        self.steps = list(range(step, minima.shape[1] + 1, step))
        self.least = least_equal(threshold, tolerance, self.steps)

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of `others` whose similarity to text i reaches the threshold."""
        # Sets whose sizes differ too much cannot be similar enough.
        n, sizes = self.sizes[i], self.sizes[others]
        others = others[(sizes >= self.threshold * n - 1e-9) & (n >= self.threshold * sizes - 1e-9)]
        equal = np.zeros(len(others), dtype=np.int64)
        for upto, least in zip(self.steps, self.least, strict=True):
            if not len(others):
                return others
            part = slice(upto - self.step, upto)
            equal += (self.minima[others, part] == self.minima[i, part]).sum(axis=1)
            going = equal >= least
            others, equal = others[going], equal[going]
        return others[self._similar(i, others)]

    def _similar(self, i: int, others: np.ndarray) -> np.ndarray:
        if not len(others):
            return np.zeros(0, dtype=bool)
        own = self.flat[self.starts[i] : self.starts[i + 1]]
        self.marked[own] = 1
        sizes = self.sizes[others]
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        place = np.arange(int(sizes.sum())) + np.repeat(self.starts[others] - begins, sizes)
        common = np.add.reduceat(self.marked[self.flat[place]], begins)
        self.marked[own] = 0
        return common >= self.threshold * (len(own) + sizes - common) - 1e-9


def _unit_links(unit: Unit, left: np.ndarray, right: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Per text of the unit: its number of links and the place of its root; among `left`, or from `left` to `right`."""
    root = np.arange(len(unit.sizes))
    n_links = np.zeros(len(unit.sizes), dtype=np.int64)
    for k, i in enumerate(left):
        found = unit.linked(i, left[k + 1 :] if right is None else right)
        if len(found):
            n_links[i] += len(found)
            n_links[found] += 1
            merged = np.unique(root[np.append(found, i)])
            if len(merged) > 1:
                root[np.isin(root, merged)] = merged[0]
    return n_links, root


def _joined_up(size: int, factors: np.ndarray, threshold: float, tolerance: float, step: int) -> Callable:
    """The links within rows (pool, block, left, right, node, text): (node, root, n_links) per linked text.

    The rows are one unit of a large pool, or several small pools as a whole.
    """

    def links(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pool").combine_chunks()
        node, pool, block = (rows.column(c).to_numpy() for c in ("node", "pool", "block"))
        left, right = rows.column("left")[0].as_py(), rows.column("right")[0].as_py()
        sets, minima = [], np.zeros((len(node), len(factors)), dtype=np.uint32)
        text = rows.column("text").chunk(0)
        for low, high in chunks(text):
            values, bounds, *_ = words(text.slice(low, high - low))
            made, ends = _distinct(*shingles(values, bounds, size))
            minima[low:high] = min_values(made, ends, factors)
            sets += [made[ends[k] : ends[k + 1]] for k in range(high - low)]
        edges = np.append(np.flatnonzero(np.append(True, pool[1:] != pool[:-1])), len(pool))
        out = []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            unit = Unit(sets[low:high], minima[low:high], threshold, tolerance, step)
            own = np.flatnonzero(block[low:high] == left)
            facing = None if left == right else np.flatnonzero(block[low:high] == right)
            n_links, root = _unit_links(unit, own, facing)
            some = n_links > 0
            out.append((node[low:high][some], node[low:high][root[some]], n_links[some]))
        names = ("node", "root", "n_links")
        return pa.table({name: np.concatenate(c) for name, c in zip(names, zip(*out, strict=True), strict=True)})

    return links


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, class_id, text_id, n_links, n_copies) for each row; see `classes` for what they are."""
    keys = dict(zip(("row_a", "row_b"), row_key(F.col("doc_id"), F.col("text")), strict=True))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[k.alias(n) for n, k in keys.items()])
    found = classes(docs, **how)
    return slim.join(found, ["row_a", "row_b"]).select("doc_id", "class_id", "text_id", "n_links", "n_copies")


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows and columns of `docs`, of each class only the document of the least id, once."""
    row_a, row_b = free_name(docs, "row_a"), free_name(docs, "row_b")
    keys = dict(zip((row_a, row_b), row_key(F.col("doc_id"), F.col("text")), strict=True))
    first = classes(docs, **how).filter("is_first").select(F.col("row_a").alias(row_a), F.col("row_b").alias(row_b))
    kept = docs.withColumns(keys).join(first, [row_a, row_b], "left_semi")
    return kept.dropDuplicates([row_a, row_b]).select(*docs.columns)


def classes(
    docs: DataFrame,
    threshold: float = 0.8,
    size: int = 5,
    hashes: int = 150,
    band_rows: int = 5,
    tolerance: float = 1e-6,
    step: int = 25,
    block_rows: tuple[int, int] = (128, 2048),
    block_words: int = 1_000_000,
) -> DataFrame:
    """(row_a, row_b, class_id, text_id, n_links, n_copies, is_first) for each distinct (doc_id, text).

    Two texts are linked if the Jaccard similarity of their sets of `size`-word shingles reaches the threshold; a
    shorter text is one shingle. Texts of the same words are one text: `text_id` is the least id among its copies,
    `n_copies` their number and `n_links` the number of other texts it is linked to. `class_id` is the least id among
    all documents that links and copies connect. A null text or one without words is a class of its own, without
    links. Rows without an id come after all others. Repeated rows share one result and count as copies.
    """
    most = F.lit(2**63 - 1)
    a, b = row_key(F.col("doc_id"), F.col("text"))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), most).alias("place"), "text", a.alias("row_a"), b.alias("row_b"))
    factors = _multipliers(hashes)
    signed = signatures(keyed.withColumn("text", F.coalesce("text", F.lit(""))), size, hashes, band_rows)
    signed = stored(signed, "jaccard-signatures")
    rows = signed.groupBy("row_a", "row_b").agg(
        F.min("place").alias("place"),
        F.count("*").alias("times"),
        F.max("n_words").alias("n_words"),
        # A text without words is its row alone.
        F.max(F.when(F.col("n_words") > 0, F.col("text_a")).otherwise(F.col("row_a"))).alias("text_a"),
        F.max(F.when(F.col("n_words") > 0, F.col("text_b")).otherwise(F.col("row_b"))).alias("text_b"),
    )
    rows = stored(rows, "jaccard-rows")
    texts = rows.groupBy("text_a", "text_b").agg(
        F.min(F.struct("place", "row_a", "row_b")).alias("first"), F.sum("times").alias("n_copies"), F.max("n_words").alias("n_words")
    )
    # A text's node is the digest of its words.
    texts = stored(texts.withColumn("node", F.xxhash64("text_a", "text_b")), "jaccard-texts")
    banded = signed.select(F.xxhash64("text_a", "text_b").alias("node"), F.explode("bands").alias("band")).distinct()
    banded = stored(banded, "jaccard-bands")
    buckets = banded.groupBy("band").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead <> last")
    buckets = stored(buckets.select("band", "lead"), "jaccard-buckets")
    stars = banded.join(buckets, "band").filter("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    pools = components(stars, "jaccard-pools")
    pools = pools.join(texts.select("node", "n_words", "first.row_a", "first.row_b"), "node")
    pools = stored(pools.withColumnRenamed("root", "pool"), "jaccard-pools")
    sized = pools.groupBy("pool").agg(F.count("*").alias("members"), F.sum("n_words").alias("words"))
    # A text of a large pool goes to a bounded number of units, as long as units can grow.
    block_size = F.greatest(F.lit(block_rows[0]), F.least(F.lit(block_rows[1]), F.ceil(F.col("members") / 24)))
    n_blocks = F.greatest(F.ceil(F.col("members") / block_size), F.ceil(F.col("words") / block_words))
    sized = stored(sized.select(F.col("pool").alias("of"), n_blocks.cast("int").alias("n_blocks")), "jaccard-sizes")
    chosen = pools.join(sized, F.col("pool") == F.col("of")).select(
        "node", "pool", "n_blocks", "row_a", "row_b", F.pmod(F.xxhash64("node", F.lit(3)), F.col("n_blocks")).cast("int").alias("block")
    )
    chosen = stored(chosen, "jaccard-chosen")
    # Small pools share a cell, so that a group of rows is worth a call.
    cells = max(1, chosen.count() // block_rows[0])
    # Most texts have no candidate: they are left out before the join.
    read = possible(keyed.select("row_a", "row_b", "text"), chosen, "row_a")
    read = read.join(chosen, ["row_a", "row_b"]).dropDuplicates(["row_a", "row_b"])
    read = read.select(
        "node", "pool", "n_blocks", "block", "text",
        F.when(F.col("n_blocks") > 1, F.col("pool")).otherwise(F.pmod(F.xxhash64("pool"), F.lit(cells))).alias("cell"),
    )
    # A block meets itself and every other block of its pool once.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("n_blocks") - 1),
        lambda other: F.struct(F.least("block", other).alias("left"), F.greatest("block", other).alias("right")),
    )
    units = read.select("node", "pool", "block", "text", "cell", (F.col("n_blocks") > 1).alias("large"), F.inline(meets))
    link = _joined_up(size, factors, threshold, tolerance, step)
    linked = units.groupBy("large", "cell", "left", "right").applyInArrow(link, "node long, root long, n_links long")
    linked = stored(linked, "jaccard-links")
    roots = components(linked.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")), "jaccard-classes")
    n_links = linked.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    known = texts.join(n_links, "node", "left").join(roots, "node", "left").select(
        "text_a", "text_b", "first", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        # A text without links is its own class, whatever its node collides with.
        F.coalesce("root", "node").alias("root"), F.col("root").isNull().alias("alone"),
    )
    known = stored(known, "jaccard-known")
    leads = known.filter("not alone").groupBy("root").agg(F.min("first").alias("lead"))
    known = known.join(stored(leads, "jaccard-leads"), "root", "left").select(
        "text_a", "text_b", "first", "n_copies", "n_links", F.when(F.col("alone"), F.col("first")).otherwise(F.col("lead")).alias("lead")
    )
    value = lambda place: F.when(place != most, place)
    joined = rows.select("row_a", "row_b", "text_a", "text_b").join(stored(known, "jaccard-known"), ["text_a", "text_b"])
    return joined.select(
        "row_a", "row_b",
        value(F.col("lead.place")).alias("class_id"),
        value(F.col("first.place")).alias("text_id"),
        "n_links", "n_copies",
        ((F.col("lead.row_a") == F.col("row_a")) & (F.col("lead.row_b") == F.col("row_b"))).alias("is_first"),
    )
