"""Personal data: base spans against the plain patterns, and what the trees add."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tests.llm import frames
from tidewarden.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c_x@d.ee.ff x@y.zz.q@r.s @@ a@b a@b. .a@b.c",
    "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.0255 0000000000001.1.1.1 x1.2.3.4y 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111- 41111111111111112 1 2 3 4",
    "4111111111111111-4111111111111111 5500 0000 0000 0004. 0-0-0-0-0-0-0-0-0-0-0-0-0-0",
    "+1 (555) 123-4567.. +12345 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 ++49 30 1234567-",
    "é" * 50 + " a.b+c@x-y.z.co \U0001f600 4111111111111111\U0001f600 +49 30 1234567890",
    "a" * 60_000 + " " + "1" * 50_000 + " x@" + "b." * 10_000,
    "1." * 20_000,
    "+" * 3000 + "1" + " " * 3000 + "2",
    "",
    None,
]


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain_spans(text):
    return sorted((m.start(), i, m.end()) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if valid(k, m[0]))


def slow(text):
    """The plain patterns try a long run from each of its places."""
    return text is not None and len(text) > 50_000


@pytest.fixture(scope="module")
def texts(spark):
    return frames.documents(spark, [(i, t, "en", "a") for i, t in enumerate(TEXTS)])


def test_base_spans_equal_the_plain_patterns(spark, texts):
    got = {r.doc_id: r for r in pii.personal_data(texts).collect()}
    for i, text in enumerate(TEXTS):
        if not slow(text):
            want = plain_spans(text)
            joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
            assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), i
            assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == n for x in want) for n in range(4)]
            assert set(filter(None, joined.split(","))) <= set(got[i].spans.split(","))


def test_the_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.base_sha256 for r in pii.personal_data(docs).collect()}
    for r in docs.collect():
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in plain_spans(r.text))
        assert got[r.doc_id] == hashlib.sha256(joined.encode()).hexdigest()


def numbered(spark, texts):
    return frames.documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).withColumn("row", F.monotonically_increasing_id())


def test_trees_choose_what_looks_like_the_examples(spark):
    known = [f"please call +1 (5{i % 100:02d}) 555-{1000 + i} now. seen {i * 37 % 9000 + 1000} {i} items" for i in range(400)]
    chooser = pii.fit(pii.matches(numbered(spark, known)))
    assert set(chooser.thresholds) == {3}
    # The international prefix in place of the plus sign is nothing that the base pattern finds.
    other = pii.spans(pii.matches(numbered(spark, [f"please call 001 (53{i}) 555-800{i} now. seen 1234 567 items" for i in range(5)])))
    assert other.filter("not wide").count() == 0
    chosen = {r.match: r.p >= chooser.thresholds[3] for r in chooser.probabilities(other).collect()}
    assert chosen == {f"001 (53{i}) 555-800{i}": True for i in range(5)} | {"1234 567": False}


def test_thresholds_count_candidates_beyond_the_sample(spark):
    """Too few addresses in the sample for a threshold, but many in the corpus."""
    phone = lambda i: f"please call +1 (5{i % 100:02d}) 555-{1000 + i} now. seen {i * 37 % 9000 + 1000} {i} items"
    mail = lambda i: f"please mail name{i}@host{i % 9}.org now. seen {i * 37 % 9000 + 1000} {i} items"
    texts = [mail(i) if i % 7 == 0 else phone(i) for i in range(2000)]
    chooser = pii.fit(pii.matches(numbered(spark, texts)), sample_docs=200)
    assert set(chooser.thresholds) == {0, 3}


def test_added_spans_stay_off_base_spans(spark, texts):
    found = pii.find(texts.withColumn("row", F.monotonically_increasing_id())).collect()
    for r in found:
        assert not any(a.start < b.end and b.start < a.end for a in r.added_spans for b in r.base_spans)


def test_redaction(spark):
    docs = frames.documents(spark, [(1, "mail a@b.cc or 1.2.3.4!", "en", "a"), (2, None, None, None), (3, "plain", "en", "b")])
    got = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert got == {1: "mail <email> or <ip>!", 2: None, 3: "plain"}


def test_no_python_on_the_way(spark, texts):
    plan = pii.personal_data(texts)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
