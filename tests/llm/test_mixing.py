"""Weighted fair queueing: targets by repeated resharing, what is taken, the order of the queues."""

import random

import pytest

from tests.llm import frames
from tidewarden.llm.mixing import mixture


def plain_targets(sizes, share=1.5, most=2):
    """Water filling step by step, as the contract words it."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def corpus(seed, n=800, hot=0.4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < hot else rng.choice([None, "a", "b", "c", "é", "z", "Z"])
        rows.append((i, None if i % 97 == 0 else frames.sentence(rng, rng.randrange(0, 60)), "en", source))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_what_is_taken(spark, seed):
    rows = corpus(seed)
    out = mixture(frames.documents(spark, rows), rows_per_bin=40).collect()
    assert len(out) == len(rows)
    size = {i: len((t or "").split()) for i, t, *_ in rows}
    source = {i: s for i, *_, s in rows}
    totals = {}
    for i in size:
        totals[source[i]] = totals.get(source[i], 0) + size[i]
    targets, taken = plain_targets(totals), dict.fromkeys(totals, 0)
    for r in out:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], totals[s])
        assert r.target == pytest.approx(targets[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 2 * 60 for s in totals)
    budget = 1.5 * sum(size.values())
    assert budget - 60 <= sum(taken.values()) <= budget


def test_bins_do_not_change_the_result(spark):
    docs = frames.documents(spark, corpus(4))
    want = frames.rows_of(mixture(docs, rows_per_bin=100_000))
    assert frames.rows_of(mixture(docs, rows_per_bin=25)) == want
    assert frames.rows_of(mixture(docs.repartition(13), rows_per_bin=60)) == want


def test_another_seed_takes_others(spark):
    docs = frames.documents(spark, corpus(5))
    assert frames.rows_of(mixture(docs)) != frames.rows_of(mixture(docs, seed=18))


def test_repeated_rows_stand_one_after_the_other(spark):
    rows = [(7, "one two three", "en", "a")] * 300 + [(100 + i, "w " * 9, "en", "b") for i in range(20)]
    out = mixture(frames.documents(spark, rows), rows_per_bin=10).collect()
    assert len(out) == 320 and {r.taken for r in out if r.doc_id == 7} <= {0, 3, 6}
    total = 300 * 3 + 20 * 9
    assert 1.5 * total - 9 <= sum(r.taken for r in out) <= 1.5 * total


def test_a_sole_source_and_texts_without_words(spark):
    out = {r.doc_id: r for r in mixture(frames.documents(spark, [(1, "a b", "en", None), (2, None, None, None), (3, "", "en", "s")])).collect()}
    assert (out[1].target, out[2].taken, out[3].target, out[3].taken) == (3.0, 0, 0.0, 0)
