"""Exact top-k search by inner product with MaxScore, for blocks of queries.

The components of a vector, floor(scale * x), are its terms: term (dimension, sign) has a posting for every vector
whose component has that sign, with the absolute value as impact. A query scores with the terms of its own signs and
loses with the opposite ones, so the sum over its own terms bounds the score from above. A block of queries carries the
k best of the shards it has met; the last of them is a query's threshold. The terms with the smallest bounds that cannot
reach it together are non-essential: a query without other terms skips the shard. Where the postings of the essential
terms are few, only these are traversed, and the non-essential terms are probed for the vectors that are still
competitive, largest bound first; what is left is scored exactly. Where they are many, as with dense vectors, all terms
of such queries are traversed at once by a product of matrices, in floats that hold every partial sum exactly. Shards
are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewarden.llm.frames import stored

# Components beyond this size are held to it, so that sums of products stay within 64 bits.
MOST = 1 << 26
LANES_A_CORE = 4


# No score is as small; it marks a free place.
FREE = np.iinfo(np.int64).min
# A product of matrices takes about so many components in the time of one posting.
COMPONENTS_A_POSTING = 64
# Scores of a product that are held at once.
SCORES = 1 << 21


def _unpacked(ids: pa.ListScalar, sizes: pa.ListScalar, flat: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """The ids and the matrix of a packed shard; shorter vectors are filled up with zeros."""
    sizes = sizes.values.to_numpy(zero_copy_only=False)
    width = int(np.max(sizes, initial=0))
    matrix = np.zeros((len(sizes), width), dtype=np.int64)
    matrix[np.arange(width)[None, :] < sizes[:, None]] = flat.values.to_numpy(zero_copy_only=False)
    return ids.values.to_numpy(zero_copy_only=False), matrix


class Best:
    """The k best ids of each query of a block, over the shards met so far."""

    def __init__(self, queries: int, k: int):
        self.scores = np.full((queries, k), FREE, dtype=np.int64)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max, dtype=np.int64)

    @property
    def thresholds(self) -> np.ndarray:
        """What a further id must reach, FREE where places are left."""
        return self.scores[:, -1]

    def add(self, at: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Take in ids with their scores for the queries `at`; an id keeps its best score."""
        last = self.scores[at, -1]
        going = (scores > last) | ((scores == last) & (ids < self.ids[at, -1]))
        at, ids, scores = at[going], ids[going], scores[going]
        if not len(at):
            return
        touched = np.unique(at)
        held, place = np.nonzero(self.scores[touched] > FREE)
        at = np.concatenate([at, touched[held]])
        ids = np.concatenate([ids, self.ids[touched[held], place]])
        scores = np.concatenate([scores, self.scores[touched[held], place]])
        order = np.lexsort((-scores, ids, at))
        at, ids, scores = at[order], ids[order], scores[order]
        first = np.ones(len(at), dtype=bool)
        first[1:] = (at[1:] != at[:-1]) | (ids[1:] != ids[:-1])
        at, ids, scores = at[first], ids[first], scores[first]
        order = np.lexsort((ids, -scores, at))
        at, ids, scores = at[order], ids[order], scores[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        kept = rank < self.scores.shape[1]
        # The ids held before stand among the new ones, so no place gets free.
        self.scores[at[kept], rank[kept]] = scores[kept]
        self.ids[at[kept], rank[kept]] = ids[kept]

    def batch(self, q_ids: np.ndarray) -> pa.RecordBatch:
        at, place = np.nonzero(self.scores > FREE)
        columns = (q_ids[at], self.ids[at, place], self.scores[at, place])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


class Shard:
    """Posting lists of one shard, ordered by impact, and its matrix in the order of the ids."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.matrix = ids[order], matrix[order]
        self.distinct, self.starts = np.unique(self.ids, return_index=True)
        self.repeats = len(self.distinct) < len(ids)
        self.norm = _largest_norm(self.matrix)
        self.most = {1: np.max(self.matrix, axis=0, initial=0), -1: -np.min(self.matrix, axis=0, initial=0)}
        self.lengths = {sign: np.count_nonzero(sign * self.matrix > 0, axis=0) for sign in (1, -1)}
        self.postings: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.floats: dict[type, np.ndarray] = {}

    def posting(self, d: int, sign: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows and impacts of a term, the highest impact first."""
        if (d, sign) not in self.postings:
            impact = sign * self.matrix[:, d]
            at = np.flatnonzero(impact > 0)
            at = at[np.argsort(-impact[at], kind="stable")]
            self.postings[d, sign] = (at, impact[at])
        return self.postings[d, sign]

    def _distinct(self, rows: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the rows of an id one with its best score, and the scores."""
        if not self.repeats:
            return rows, scores
        order = np.lexsort((-scores, self.ids[rows]))
        _, first = np.unique(self.ids[rows][order], return_index=True)
        return rows[order[first]], scores[order[first]]

    def best(
        self, query_id: int, query: np.ndarray, k: int, seeds: int = 16, threshold: int | None = None
    ) -> list[tuple[int, int]]:
        """The (id, score) of the k best ids but the query's own: higher scores first, then smaller ids.

        An id has the best score of its vectors. With a threshold ids that do not reach it may be left out.
        """
        terms = []
        for d in np.flatnonzero(query):
            at, impact = self.posting(d, 1 if query[d] > 0 else -1)
            if len(at):
                weight = abs(int(query[d]))
                terms.append((weight * int(impact[0]), int(d), weight, at, impact))
        terms.sort(key=lambda t: (t[0], t[1]))
        others = self.ids != query_id
        if terms and threshold is None:
            seen = np.unique(np.concatenate([t[3][:seeds] for t in terms[-8:]]))
            seen = seen[others[seen]]
            _, scores = self._distinct(seen, self.matrix[seen] @ query)
            if len(scores) >= k:
                threshold = int(np.partition(scores, -k)[-k])
        if threshold is None or threshold <= 0:
            # A vector without any posting for the query's terms may still be among the best.
            alive = np.flatnonzero(others)
        else:
            upto = np.cumsum([t[0] for t in terms])
            essential = int(np.searchsorted(upto, threshold, side="left"))
            sums = np.zeros(len(self.ids), dtype=np.int64)
            for _, _, weight, at, impact in terms[essential:]:
                sums[at] += weight * impact
            rest = int(upto[essential - 1]) if essential else 0
            alive = np.flatnonzero(others & (sums > 0) & (sums + rest >= threshold))
            sums = sums[alive]
            for bound, d, _, _, _ in reversed(terms[:essential]):
                rest -= bound
                sums = sums + np.maximum(self.matrix[alive, d] * query[d], 0)
                going = sums + rest >= threshold
                alive, sums = alive[going], sums[going]
        alive, scores = self._distinct(alive, self.matrix[alive] @ query)
        if len(alive) > k:
            kept = scores >= np.partition(scores, -k)[-k]
            alive, scores = alive[kept], scores[kept]
        order = np.lexsort((self.ids[alive], -scores))[:k]
        return [(int(self.ids[alive[i]]), int(scores[i])) for i in order]

    def search(self, q_ids: np.ndarray, queries: np.ndarray, best: Best) -> None:
        """Add to `best` what this shard has for the queries of a block."""
        width = self.matrix.shape[1]
        queries = np.pad(queries[:, :width], ((0, 0), (0, max(0, width - queries.shape[1]))))
        signs = [queries > 0, queries < 0]
        bounds = np.abs(queries) * np.select(signs, [self.most[1], self.most[-1]])
        order = np.argsort(bounds, axis=1)
        upto = np.cumsum(np.take_along_axis(bounds, order, axis=1), axis=1)
        lengths = np.take_along_axis(np.select(signs, [self.lengths[1], self.lengths[-1]]), order, axis=1)
        postings = np.sum(lengths, axis=1, where=upto >= best.thresholds[:, None])
        bounded = best.thresholds > 0
        skipped = bounded & (np.sum(bounds, axis=1) < best.thresholds)
        kind = _exact_floats(self.norm * _largest_norm(queries))
        walked = bounded & (postings * COMPONENTS_A_POSTING < self.matrix.size) if kind else np.ones(len(queries), dtype=bool)
        for at in np.flatnonzero(walked & ~skipped):
            threshold = int(best.thresholds[at]) if bounded[at] else None
            found = self.best(int(q_ids[at]), queries[at], best.scores.shape[1], threshold=threshold)
            ids, scores = np.array(found, dtype=np.int64).reshape(-1, 2).T
            best.add(np.full(len(ids), at), ids, scores)
        dense = np.flatnonzero(~walked & ~skipped)
        step = max(1, SCORES // max(1, len(self.ids)))
        for at in (dense[n : n + step] for n in range(0, len(dense), step)):
            self._product(q_ids[at], queries[at].astype(kind), at, best)

    def _product(self, q_ids: np.ndarray, queries: np.ndarray, at: np.ndarray, best: Best) -> None:
        """Score all vectors with the queries `at` of the block, and add those that reach the thresholds."""
        kind, k = queries.dtype.type, best.scores.shape[1]
        if kind not in self.floats:
            self.floats[kind] = self.matrix.astype(kind)
        scores = self.floats[kind] @ queries.T
        if self.repeats:
            scores = np.maximum.reduceat(scores, self.starts, axis=0)
        own = np.minimum(np.searchsorted(self.distinct, q_ids), len(self.distinct) - 1)
        same = np.flatnonzero(self.distinct[own] == q_ids)
        scores[own[same], same] = -np.inf
        # The k-th of the largest scores of runs of ids is reached by k ids; only runs that reach it are looked at.
        run = max(1, len(scores) // max(64, 4 * k))
        whole = len(scores) // run * run
        tops = np.max(scores[:whole].reshape(-1, run, scores.shape[1]), axis=1)
        if whole < len(scores):
            tops = np.concatenate([tops, np.max(scores[whole:], axis=0, keepdims=True)])
        least = np.where(best.thresholds[at] > FREE, best.thresholds[at].astype(np.float64), -np.inf)
        if len(tops) >= k:
            least = np.maximum(least, np.partition(tops, len(tops) - k, axis=0)[len(tops) - k])
        runs, query = np.nonzero((tops >= least) & (tops > -np.inf))
        rows = runs[:, None] * run + np.arange(run)
        found = scores[np.minimum(rows, len(scores) - 1), query[:, None]]
        hit, place = np.nonzero((rows < len(scores)) & (found >= least[query, None]) & (found > -np.inf))
        best.add(at[query[hit]], self.distinct[rows[hit, place]], found[hit, place].astype(np.int64))


def _largest_norm(matrix: np.ndarray) -> float:
    return float(np.sqrt(np.max(np.sum(np.square(matrix, dtype=np.float64), axis=1), initial=0)))


def _exact_floats(most: float) -> type | None:
    """The floats that hold whole numbers up to `most`, so all partial sums of products of vectors, exactly."""
    most *= 1.001
    return np.float32 if most <= 1 << 24 else np.float64 if most <= 1 << 53 else None


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Each row is one shard and one block of queries, packed; a task tells the k best of all its shards."""
    met: dict[int, tuple[np.ndarray, Best]] = {}
    last = shard = None
    for batch in batches:
        for row in range(len(batch)):
            number, ids, sizes, flat, block, q_ids, q_sizes, q_flat = (batch.column(c)[row] for c in range(8))
            # The rows of a shard come one after another.
            if number.as_py() != last:
                last, shard = number.as_py(), Shard(*_unpacked(ids, sizes, flat))
            q_ids, queries = _unpacked(q_ids, q_sizes, q_flat)
            if block.as_py() not in met:
                met[block.as_py()] = (np.array(q_ids), Best(len(q_ids), k))
            shard.search(q_ids, queries, met[block.as_py()][1])
    for q_ids, best in met.values():
        yield best.batch(q_ids)


def _groups(vectors: DataFrame, rows: int) -> int:
    return max(1, -(-vectors.count() // rows))


def _packed(vectors: DataFrame, rows: int, group: str) -> DataFrame:
    """Vectors dealt to groups of about `rows` by a digest of their id, each group as one row of flat arrays."""
    groups = _groups(vectors, rows)
    dealt = vectors.withColumn(group, F.pmod(F.xxhash64("id", "terms"), F.lit(groups)))
    packed = dealt.groupBy(group).agg(F.collect_list(F.struct("id", "terms")).alias("all"))
    return packed.select(
        group,
        F.transform("all", lambda v: v["id"]).alias(f"{group}_ids"),
        F.transform("all", lambda v: F.size(v["terms"])).alias(f"{group}_sizes"),
        F.flatten(F.transform("all", lambda v: v["terms"])).alias(f"{group}_flat"),
    )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_rows: int = 4096,
    query_rows: int = 512,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that `is_query` marks, the k best of all other rows.

    Scores are integer inner products of floor(scale * x); ties go to the smaller id; a query gets fewer than k rows
    if there are fewer vectors. Vectors that are null or hold null or non-finite components, and rows without an id,
    take no part. A shorter vector counts as filled up with zeros. An id that occurs several times is one candidate
    with the best score of its vectors, and one query with the best results of its vectors; exact repeats count
    once. Scaled components are held to 2**26 in size. An empty table gives an empty result. Every block of queries
    meets every shard once; no pair of vectors becomes a row unless it is among the k best of a task's shards.
    """
    x = F.col(vector_column).cast("array<double>")
    usable = F.col(id_column).isNotNull() & x.isNotNull()
    usable = usable & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    term = lambda v: F.floor(F.greatest(F.least(v * scale, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("int")
    valid = vectors.filter(usable).select(
        F.col(id_column).cast("long").alias("id"),
        F.transform(x, term).alias("terms"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    )
    valid = stored(valid.groupBy("id", "terms").agg(F.max("asked").alias("asked")), "topk")
    # A lane is some of the shards; every block goes to each lane once, however many shards there are.
    lanes = min(_groups(valid, shard_rows), LANES_A_CORE * vectors.sparkSession.sparkContext.defaultParallelism)
    shards = _packed(valid.select("id", "terms"), shard_rows, "shard").withColumn("lane", F.pmod("shard", F.lit(lanes)))
    blocks = _packed(valid.filter("asked").select("id", "terms"), query_rows, "block")
    units = blocks.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))
    paired = shards.join(units, "lane").select(
        "shard", "shard_ids", "shard_sizes", "shard_flat", "block", "block_ids", "block_sizes", "block_flat"
    )
    found = paired.mapInArrow(lambda batches: _searched(batches, k), "query_id long, vec_id long, score long")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
