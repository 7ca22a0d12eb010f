"""Exact search against all inner products."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidewarden.llm import topk
from tidewarden.llm.topk import Best, Shard, top_k

SCHEMA = "vec_id long, embedding array<float>, extra string"


def brute(rows, k=5):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, a in {(i, tuple(v)) for i, v in usable if i % 50 == 0}:
        best = out.setdefault(q, {})
        for j, b in usable:
            if j != q:
                score = sum(x * y for x, y in zip(a, b, strict=False))
                best[j] = max(score, best.get(j, score))
    return sorted((q, r, j, s) for q, best in out.items() for r, (j, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1))


def found(spark, rows, **how):
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in top_k(frame, F.col("vec_id") % 50 == 0, **how).collect())


def test_equals_brute_force_over_several_shards_and_blocks(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(16)]) for i in range(400)]
    assert found(spark, rows, shard_rows=64, query_rows=3) == brute(rows)


def test_ties_repeats_and_a_very_common_vector(spark):
    rng = random.Random(2)
    common = [0.5, 0.25, -0.5, 0.0]
    rows = [(i, common if i % 3 else [rng.gauss(0, 0.2) for _ in range(4)]) for i in range(200)]
    rows += rows[:20]
    assert found(spark, rows, shard_rows=32, query_rows=2) == brute(rows)


def test_an_id_with_many_different_high_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(120)]
    rows += [(7, [rng.choice([-1, 1]) * rng.uniform(2, 3) for _ in range(8)]) for _ in range(60)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, shard_rows=40) == brute(rows)


def test_negative_scores_and_few_vectors(spark):
    rows = [(0, [1.0, 1.0]), (1, [-1.0, -1.0]), (2, [-0.5, 0.0])]
    assert found(spark, rows) == [(0, 1, 2, -32768), (0, 2, 1, -131072)]


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [1.0]), (6, [])]
    assert found(spark, rows) == brute(rows) == [(0, 1, 5, 65536), (0, 2, 6, 0)]


def test_empty_table(spark):
    assert found(spark, []) == []


def test_non_essential_terms_are_probed_only_where_competitive():
    rng = np.random.Generator(np.random.PCG64(3))
    # A few strong dimensions decide; the others are small.
    matrix = np.concatenate([rng.integers(-200, 200, (500, 2)), rng.integers(-5, 5, (500, 14))], axis=1)
    shard = Shard(np.arange(500), matrix.astype(np.int64))
    for q in range(20):
        scores = matrix @ matrix[q]
        order = [j for j in np.lexsort((np.arange(500), -scores)) if j != q][:5]
        assert shard.best(q, matrix[q].astype(np.int64), 5) == [(int(j), int(scores[j])) for j in order]


def best_of(matrix, ids, queries, q_ids, k=5):
    out = []
    for q_id, query in zip(q_ids, queries, strict=True):
        scores = {}
        for i, v in zip(ids, matrix, strict=True):
            if i != q_id:
                scores[int(i)] = max(int(v @ query), scores.get(int(i), topk.FREE))
        out.append(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k])
    return out


def searched(matrix, ids, queries, q_ids, shards=3, k=5):
    best = Best(len(queries), k)
    for part in np.array_split(np.arange(len(ids)), shards):
        Shard(ids[part], matrix[part]).search(q_ids, queries, best)
    return [[(int(i), int(s)) for i, s in zip(*row, strict=True) if s > topk.FREE] for row in zip(best.ids, best.scores, strict=True)]


def test_a_block_of_dense_queries_walks_no_postings(monkeypatch):
    """Walked one by one, the queries take most of a shard's postings each: a millisecond and more a query and shard."""
    rng = np.random.Generator(np.random.PCG64(5))
    matrix = np.floor(256 * rng.normal(0, 0.125, (600, 64))).astype(np.int64)
    ids = rng.permutation(600)
    want = best_of(matrix, ids, matrix[:40], ids[:40])
    monkeypatch.setattr(Shard, "best", None)
    assert searched(matrix, ids, matrix[:40], ids[:40]) == want


def test_ids_of_many_vectors_and_equal_scores_in_a_block(monkeypatch):
    rng = np.random.Generator(np.random.PCG64(6))
    matrix = rng.integers(-3, 4, (500, 6))
    ids = rng.integers(0, 60, 500)
    for kind in (np.float32, np.float64, None):
        monkeypatch.setattr(topk, "_exact_floats", lambda most, kind=kind: kind)
        assert searched(matrix, ids, matrix[:50], ids[:50]) == best_of(matrix, ids, matrix[:50], ids[:50])
        assert searched(matrix[:4], ids[:4], matrix[:4], ids[:4]) == best_of(matrix[:4], ids[:4], matrix[:4], ids[:4])


def test_floats_hold_every_partial_sum():
    assert topk._exact_floats(2**23) is np.float32 and topk._exact_floats(2**24) is np.float64 and topk._exact_floats(2**53) is None
    rng = np.random.Generator(np.random.PCG64(7))
    for most in (1 << 8, 1 << 16, 1 << 25):
        matrix = rng.integers(-most, most, (300, 32))
        # Scores that differ by one.
        matrix = np.concatenate([matrix, matrix + (np.arange(32) == 3)])
        ids = np.arange(600)
        assert searched(matrix, ids, matrix[:20], ids[:20]) == best_of(matrix, ids, matrix[:20], ids[:20])


def test_shards_out_of_reach_are_skipped_and_short_postings_walked(monkeypatch):
    rng = np.random.Generator(np.random.PCG64(8))
    matrix = np.zeros((4000, 40), dtype=np.int64)
    matrix[np.arange(4000), rng.integers(0, 40, 4000)] = rng.integers(1, 100, 4000)
    matrix[:1000] *= 50
    ids, queries = np.arange(4000), matrix[1000:1020]
    want = best_of(matrix, ids, queries, ids[1000:1020])
    calls, product, walk = [], Shard._product, Shard.best
    monkeypatch.setattr(Shard, "_product", lambda self, *a: calls.append("product") or product(self, *a))
    monkeypatch.setattr(Shard, "best", lambda self, *a, **b: calls.append("walk") or walk(self, *a, **b))
    assert searched(matrix, ids, queries, ids[1000:1020], shards=4) == want
    assert calls == ["product"]
    matrix[:1000] //= 50
    calls.clear()
    assert searched(matrix, ids, queries, ids[1000:1020], shards=4) == best_of(matrix, ids, queries, ids[1000:1020])
    assert calls[0] == "product" and "walk" in calls


def test_vectors_of_other_lengths_than_the_queries():
    rng = np.random.Generator(np.random.PCG64(9))
    long, short = rng.integers(-9, 10, (30, 7)), rng.integers(-9, 10, (30, 4))
    filled = np.pad(short, ((0, 0), (0, 3)))
    ids = np.arange(30)
    assert searched(long, ids, short[:9], ids[:9]) == best_of(long, ids, filled[:9], ids[:9])
    assert searched(short, ids, long[:9], ids[:9]) == best_of(filled, ids, long[:9], ids[:9])
    none = np.zeros((3, 0), dtype=np.int64)
    assert searched(none, ids[:3], none, ids[:3], shards=1) == [[(1, 0), (2, 0)], [(0, 0), (2, 0)], [(0, 0), (1, 0)]]
