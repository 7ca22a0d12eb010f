"""Divergence of sources against plain counting, with digests of every length."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import frames
from tidewarden.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def wanted(rows, least_docs=3, most_terms=200):
    """The report over (doc_id, text, lang, source)."""
    groups, spread = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = [t.translate(UPPER) for t in TERM.findall(text or "")]
        groups[lang or "", source or ""].update(found)
        spread[lang or ""].update(set(found))
    out = []
    for lang, docs in spread.items():
        kept = sorted(t for t, n in docs.items() if n >= least_docs)
        own = {s: c for (of, s), c in groups.items() if of == lang}
        every = sum(own.values(), Counter())

        def shares(c, kept=kept):
            whole = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // whole for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(every)
        for s in own:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in own if o != s]
            more = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", more, most_terms)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ordered)]
    return sorted(out, key=repr)


def some_rows():
    rng = random.Random(8)
    rows = []
    for i in range(90):
        words = [rng.choice(frames.WORDS[: 5 + i % 50]) for _ in range(rng.randrange(40))]
        text = " ".join(w.upper() if rng.random() < 0.2 else w for w in words)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "ä", "Z", None, "hot", "hot", "hot"])))
    return [*rows, (90, "Ärger ÄRGER 漢字,漢字 x2y _a[b]c`d{e 1", "de", "a"), (91, None, "xx", "only"), (92, "...", "de", "silent"), *frames.odd_rows()]


@pytest.mark.parametrize("bits", [64, 4, 1])
def test_report_equals_counting(spark, bits):
    rows = some_rows()
    got = dv.divergence(frames.documents(spark, rows).repartition(3), most_terms=9, bits=bits, terms_per_part=7)
    assert frames.rows_of(got) == wanted(rows, most_terms=9)


def test_all_terms_and_other_least_documents(spark):
    rows = some_rows()
    assert frames.rows_of(dv.divergence(frames.documents(spark, rows), least_docs=1)) == wanted(rows, least_docs=1)


def test_a_language_without_kept_terms_has_pairs_of_value_0(spark):
    rows = [(1, "one", "en", "a"), (2, "two", "en", "b"), (3, "", "en", "c")]
    got = frames.rows_of(dv.divergence(frames.documents(spark, rows)))
    assert got == wanted(rows) and len(got) == 6 and {r[4] for r in got} == {0}


def test_terms_of_a_column():
    texts = ["One two,ONE", "", "Éa3b", "z"]
    distinct, codes, bounds = dv.terms(pa.array(texts))
    said = distinct.to_pylist()
    assert [[said[c] for c in codes[i:j]] for i, j in zip(bounds, bounds[1:], strict=False)] == [["one", "two", "one"], [], ["Éa", "b"], ["z"]]


def test_shares_of_huge_counts(spark):
    n = np.array([0, 5, dv.MOST_COUNT - 1, dv.MOST_COUNT, 10**13])
    whole = np.array([7, 3, 10**10, 10**10, 10**13])
    exact = [1 + 10**9 * (int(a) + 1) // int(b) for a, b in zip(n, whole, strict=True)]
    assert dv._shares(n, whole).tolist() == exact
    rows = spark.createDataFrame([(int(a), int(b) - 2, 2) for a, b in zip(n, whole, strict=True)], "n long, t long, v long")
    assert [r.p for r in rows.select(dv._share(rows.n, rows.t, rows.v).alias("p")).collect()] == exact


def test_marks_hold_every_digest(spark):
    digests = np.random.default_rng(1).integers(-(2**63), 2**63, 500)
    marks = dv._marks(spark.createDataFrame([(int(d),) for d in digests], "digest long"), log_words=6)
    assert dv._marked(marks, digests).all() and not dv._marked(marks, digests + 1).all()
