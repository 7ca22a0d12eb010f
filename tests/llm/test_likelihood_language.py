"""Lattices against all segmentations written out; scores, held-out rows and languages."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm import frames
from tidewarden.llm.langid import identify
from tidewarden.llm.lattice import Lattice, public_pieces, scores_of, starting_scores
from tidewarden.llm.likelihood import VOCABULARY, likelihood

PIECES = [b" a", b" ab", b"b", b"ab", b"c", b" ", b"a", b"bc", b"\xc3", b"\xa9", b"\xc3\xa9"]


def segmentations(text, pieces):
    if not text:
        return [[]]
    return [[p, *rest] for p in pieces if text.startswith(p) for rest in segmentations(text[len(p) :], pieces)]


@pytest.fixture(scope="module")
def small():
    rng = np.random.Generator(np.random.PCG64(1))
    return Lattice(PIECES), np.log(rng.dirichlet(np.ones(len(PIECES))))


def test_score_sums_all_segmentations(small):
    lattice, logp = small
    words = [b"ab", b"abc", b"a", b"abab", b"cabc", "éa".encode(), b"", b"ab" * 40]
    got = lattice.score(words, logp)
    for word, score in zip(words[:-1], got, strict=False):
        paths = segmentations(b" " + word, PIECES)
        want = math.log(sum(math.exp(sum(logp[PIECES.index(p)] for p in path)) for path in paths))
        assert score == pytest.approx(want, rel=1e-12)
    # A word beyond the matrix size, by the same recursion in another form.
    line = [0.0] + [-math.inf] * 81
    text = b" " + words[-1]
    for end in range(1, 82):
        ways = [line[end - len(p)] + logp[i] for i, p in enumerate(PIECES) if len(p) <= end and text[:end].endswith(p)]
        line[end] = np.logaddexp.reduce(ways) if ways else -math.inf
    assert got[-1] == pytest.approx(line[-1], rel=1e-12)


def test_expected_counts(small):
    lattice, logp = small
    words, weights = [b"abc", b"ab", b"abab", b"ab" * 40], np.array([2.0, 1.0, 3.0, 0.0])
    want = np.zeros(len(PIECES))
    for word, weight in zip(words[:-1], weights, strict=False):
        paths = segmentations(b" " + word, PIECES)
        shares = np.exp([sum(logp[PIECES.index(p)] for p in path) for path in paths])
        for path, share in zip(paths, shares / shares.sum(), strict=True):
            for p in path:
                want[PIECES.index(p)] += weight * share
    assert lattice.expected(words, weights, logp) == pytest.approx(want)
    # A long word uses as many bytes in expectation as it has.
    counts = lattice.expected([b"ab" * 40], np.ones(1), logp)
    assert counts @ [len(p) for p in PIECES] == pytest.approx(81)


def test_several_sets_of_scores(small):
    lattice, logp = small
    both = lattice.score([b"ab", b"ab" * 40], np.stack([logp, logp - 1], axis=1))
    assert both[:, 0] == pytest.approx(lattice.score([b"ab", b"ab" * 40], logp))
    assert (both[:, 1] < both[:, 0]).all()


def test_learning_raises_the_likelihood():
    pieces = public_pieces(VOCABULARY)
    lattice, logp = Lattice(pieces), starting_scores(pieces)
    words = [w.encode() for w in frames.WORDS]
    before = lattice.score(words, logp).sum()
    for _ in range(3):
        logp = scores_of(lattice.expected(words, np.ones(len(words)), logp))
        after = lattice.score(words, logp).sum()
        assert after > before
        before = after


def corpus(n=300):
    rng = random.Random(8)
    return [(i, frames.sentence(rng, 20 + i % 30).replace("ba", "BA ") + (" rare%d" % i if i % 9 == 0 else ""), "en", "a") for i in range(n)]


def test_base_score_and_counts(spark):
    rows = [*corpus(), (1000, None, "en", "a"), (1001, "", None, None), (1001, "", None, None)]
    got = {}
    for r in likelihood(frames.documents(spark, rows), rounds=1, head_words=20).collect():
        got.setdefault(r.doc_id, []).append(r)
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 10 == 0}
    split = lambda t: (t or "").encode().lower().split()
    count = Counter(w for i, t, *_ in rows if i not in held for w in [*split(t), None])
    n, v = sum(count.values()), len(count)
    assert held and len(got[1001]) == 2
    for i, t, *_ in rows:
        words = [*split(t), None]
        r = got[i][0]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (i in held, len(words), n)
        assert r.n_known == sum(count[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))
        assert r.lattice_score < 0 and r.score < 0


def test_unseen_words_cost_more_the_less_they_look_like_the_corpus(spark):
    rows = [*corpus(), (5000, "bark cemu solxi", "en", "a"), (5001, "zqj中x vvkwq xjzqq", "en", "a")]
    got = {r.doc_id: r.score for r in likelihood(frames.documents(spark, rows)).collect()}
    assert got[5000] > got[5001] + 3


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = identify(docs, sample_docs=100).collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 100
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_texts_without_letters_and_a_sole_language(spark):
    rows = [(i, frames.sentence(random.Random(i), 10), "xx", "a") for i in range(20)]
    rows += [(100, None, "xx", "a"), (101, "12 34 !", "xx", "a"), (102, "", "xx", "a"), (103, "word", None, None)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(frames.documents(spark, rows), rounds=1).collect()}
    assert got[0] == ("xx", 1.0) and got[103] == ("xx", 1.0)
    assert got[100] == got[101] == got[102] == ("und", 0.0)


def test_nothing_to_learn_from(spark):
    rows = [(1, "some words", None, "a"), (2, "more words", None, "a")]
    assert [r.lang_pred for r in identify(frames.documents(spark, rows)).collect()] == ["und", "und"]
