"""Winnowing against its definition, its guarantee, and the walk to the next document against a sorted list."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm import frames
from tidewarden.llm import winnowing as wi
from tidewarden.llm.tokens import STEP

RULE = wi.Winnower()


def plain(text, k=RULE.k, window=RULE.window):
    """(hash, position) of each kept gram, window after window."""
    if not text:
        return []
    k = min(k, len(text))
    grams = [sum((ord(c) + 1) * pow(int(STEP), j, 1 << 64) for j, c in enumerate(text[i : i + k])) % (1 << 64) for i in range(len(text) - k + 1)]
    kept = set()
    for start in range(max(1, len(grams) - window + 1)):
        some = range(start, min(start + window, len(grams)))
        kept.add(max(i for i in some if grams[i] == min(grams[j] for j in some)))
    return [(grams[i], i) for i in sorted(kept)]


TEXTS = ["", "a", "ab\x00", "abc" * 40, "x" * 300, "Ünï 😀 cödé ́ 漢字" * 9, frames.sentence(random.Random(1), 300)]


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("rule", [RULE, wi.Winnower(4, 1), wi.Winnower(1, 5), wi.Winnower(5, 4, block=7), wi.Winnower(3, 16, block=1)])
def test_kept_hashes(text, rule):
    hashes, places = rule(text)
    assert list(zip(hashes.tolist(), places.tolist(), strict=True)) == plain(text, rule.k, rule.window)


def test_rightmost_of_equal_hashes():
    assert wi.minima(np.array([3, 1, 1, 2, 1, 5], dtype=np.uint64), 3).tolist() == [2, 4]
    # A long run of one letter keeps one position a window.
    assert RULE("x" * 200)[1].tolist() == list(range(RULE.window - 1, 200 - RULE.k + 1))


def test_a_shared_passage_shares_a_hash_inside_it():
    rng = random.Random(5)
    for _ in range(50):
        passage = frames.sentence(rng, 40)[: RULE.k + RULE.window - 1]
        before = [frames.sentence(rng, n) for n in (20, 33)]
        texts = [f"{b} {passage} {frames.sentence(rng, 15)}" for b in before]
        inside = []
        for text, b in zip(texts, before, strict=True):
            hashes, places = RULE(text)
            low = len(b) + 1
            inside.append({h for h, p in zip(hashes.tolist(), places.tolist(), strict=True) if low <= p <= low + len(passage) - RULE.k})
        assert inside[0] & inside[1]


def wanted(rows):
    """The report over (doc_id, text), by sorting all rows."""
    rows = [(i, t or "") for i, t in rows]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for place, (doc_id, text) in enumerate(order):
        after = order[(place + 1) % len(order)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        prints = [plain(t) for t in (text, edited, after)]
        bags = [Counter(h for h, _ in p) for p in prints]
        near = [(bags[0] & b).total() / (bags[0] | b).total() if bags[0] | b else 1.0 for b in bags[1:]]
        said = [",".join(f"{h:016x}:{p}" for h, p in x) for x in prints[:2]]
        yield doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *said, *near


def some_rows(n=60):
    rng = random.Random(9)
    rows = [(i * 7 % 61 - 20, frames.sentence(rng, rng.choice([0, 1, 3, 30, 90]))) for i in range(n)]
    return [*rows, (1000, None), (None, "without an id")]


@pytest.mark.parametrize("bins", [1, 4, 40])
def test_report_equals_the_sorted_rows(spark, bins):
    rows = some_rows()
    docs = frames.documents(spark, [(*r, "en", "a") for r in rows]).repartition(3)
    got = frames.rows_of(wi.compared(docs) if bins == 1 else _with_bins(docs, bins))
    assert got == sorted(wanted(rows), key=repr)


def _with_bins(docs, bins, walk=wi.with_next):
    original = wi.with_next
    wi.with_next = lambda d: walk(d, chars_per_bin=1, rows_per_bin=10**9, most_bins=bins)
    try:
        return wi.compared(docs)
    finally:
        wi.with_next = original


@pytest.mark.parametrize("bins", [1, 12])
def test_repeated_rows_fill_no_bin_of_their_own(spark, bins):
    same = frames.sentence(random.Random(2), 60)
    rows = [(5, same)] * 300 + [(4, "after it"), (9, "before it"), (None, same), (None, None)] + [(None, f"text {i}") for i in range(150)]
    docs = frames.documents(spark, [(*r, "en", "a") for r in rows]).repartition(4)
    found = wi.with_next(docs, chars_per_bin=1, rows_per_bin=10**9, most_bins=bins).filter("not last")
    assert found.selectExpr("sum(copies) n").first().n == len(rows)
    if bins > 1:
        assert found.filter("doc_id = 5").selectExpr("max(copies) n").first().n == 300
        assert found.filter("doc_id is null").select("bin").distinct().count() > 2
    got = _with_bins(docs, bins).collect()
    assert len(got) == len(rows)
    fives = [r for r in got if r.doc_id == 5]
    assert len(fives) == 300 and sorted(r.near_next for r in fives)[1:] == [1.0] * 299
    assert {r.fingerprint for r in fives} == {r.fingerprint for r in got if r.fingerprint and r.n_chars == len(same)}
    nine = next(r for r in got if r.doc_id == 9)
    assert nine.edited_sha256 == hashlib.sha256(("before" + same[:3]).encode()).hexdigest()


def test_smallest_id_stands_before_a_null_one(spark):
    rows = [(-(2**63), "smallest"), (None, "nothing"), (2**63 - 1, "greatest")]
    got = {r.doc_id: r.edited_sha256 for r in _with_bins(frames.documents(spark, [(*r, "en", "a") for r in rows]), 3).collect()}
    for own, text in ((2**63 - 1, "greatesm"[:6] + "sm"), (-(2**63), "smalle" + "no"), (None, "nothi" + "gr")):
        assert got[own] == hashlib.sha256(text.encode()).hexdigest()


def test_fingerprints_of_a_table(spark):
    docs = frames.odd_documents(spark)
    for r in wi.fingerprints(docs.filter("length(text) < 1000 or text is null")).collect():
        assert len(r.hashes) == len(r.positions) and (len(r.hashes) > 0) == (r.n_chars > 0)
        assert r.positions == sorted(set(r.positions))
