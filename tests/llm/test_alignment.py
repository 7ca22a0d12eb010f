"""Alignment of two tokenizers against one document after the other, and its search against a plain one."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import frames
from tidewarden.llm import alignment as al

TEXTS = [
    None,
    "",
    " ",
    "plain words, and some more of them",
    "plain words, and some more of them",
    "  two blanks\n\nlines\ttabs  ",
    "<|endoftext|> and </s> are plain text here <0x41>",
    "Ünï 😀 cödé ́ 漢字 الكلمات 1234567890",
    "x" * 5000,
    "a▁b",
    "nul \x00 inside",
    "ﬁ ① Å",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(TEXTS)] + [(None, "no id", "en", "a"), *frames.odd_rows()[-6:]]
    return frames.documents(spark, rows)


def walked(text):
    """Tokens and groups of a text by walking both sequences, None where the bytes differ."""
    a, b = al._tokens(al.BYTE_LEVEL, al.PIECES).both
    if not text:
        return None
    a_ids, b_ids = a.encode([text])[0], b.encode([text])[0]
    whole = (" " + text).encode()
    if b"".join(a.spelt[i] for i in a_ids) != whole or b"".join(b.spelt[i] for i in b_ids) != whole:
        return None
    groups, left, right, at_a, at_b, j = [], [], [], 0, 0, 0
    for i in a_ids:
        left.append(i)
        at_a += len(a.spelt[i])
        while at_b < at_a:
            right.append(b_ids[j])
            at_b += len(b.spelt[b_ids[j]])
            j += 1
        if at_a == at_b:
            groups.append((left, right))
            left, right = [], []
    assert not left and not right
    return a_ids, b_ids, groups


def expected(texts):
    """The report of each text."""
    all_walked = [walked(t) for t in texts]
    count = Counter()
    for found in filter(None, all_walked):
        count.update({(x, y) for p, q in found[2] for x in p for y in q})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    for found in all_walked:
        if found is None:
            yield 0, 0, 0, 0, 0, 0, ""
            continue
        a_ids, b_ids, groups = found
        links = [(x, y) for p, q in groups for x in p for y in q]
        said = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        n_best = sum(count[x] == best[x[0]] for x in links)
        digest = hashlib.sha256(said.encode()).hexdigest()
        yield len(a_ids), len(b_ids), len(groups), len(links), n_best, sum(count[x] for x in links), digest


@pytest.mark.parametrize("sent_pairs", [1_000_000, 20])
def test_report_equals_walking_each_text(spark, docs, sent_pairs):
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, *x) for r, x in zip(rows, expected([r.text for r in rows]), strict=True)]
    assert frames.rows_of(al.alignment(docs, sent_pairs=sent_pairs)) == sorted(want, key=repr)
    # The table holds texts with tokens and texts whose bytes one of the tokenizers changes.
    assert sum(w[1] > 0 for w in want) > 5 and any(w[1] == 0 for w in want[3:])


def test_groups_cover_the_text(spark, docs):
    a, b = al._tokens(al.BYTE_LEVEL, al.PIECES).both
    texts = {r.doc_id: r.text for r in docs.filter("doc_id < 7").collect()}
    for r in al.aligned(docs.filter("doc_id < 7")).collect():
        whole = (" " + (texts[r.doc_id] or "")).encode() if r.a_ids else b""
        assert len(r.a_upto) == len(r.b_upto) == len(r.bytes_upto)
        if r.a_ids:
            assert (r.a_upto[-1], r.b_upto[-1], r.bytes_upto[-1]) == (len(r.a_ids), len(r.b_ids), len(whole))
        for i, j, k in zip(r.a_upto, r.b_upto, r.bytes_upto, strict=True):
            assert b"".join(a.spelt[x] for x in r.a_ids[:i]) == whole[:k] == b"".join(b.spelt[x] for x in r.b_ids[:j])


def test_ranks_stand_for_the_merges_of_the_file():
    """Merging by rank equals merging by the list if the list is in order and makes every entry of its own bytes."""
    tokens = al.ByteLevelTokens(al.BYTE_LEVEL)
    letters = al._byte_of_letter()
    with open(al.BYTE_LEVEL, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [tuple(bytes(letters[c] for c in x) for x in (m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    place = {m: i for i, m in enumerate(merges)}
    ids = {s: i for i, s in enumerate(tokens.spelt)}
    made = [ids[a + b] for a, b in merges]
    assert made == sorted(set(made)) and len(place) == len(merges)
    for spelt in tokens.spelt[:-1]:
        parts = [bytes([b]) for b in spelt]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: place.get((parts[i], parts[i + 1]), len(place)))
            assert (parts[best], parts[best + 1]) in place
            parts[best : best + 2] = [parts[best] + parts[best + 1]]


def test_tokens_are_those_of_the_file():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(al.BYTE_LEVEL)
    model.encode_special_tokens = True
    tokens = al.ByteLevelTokens(al.BYTE_LEVEL)
    rng = random.Random(6)
    marks = [" ", "  ", "\n", " \n", "\t", "\u00a0", "\u2028", "'s ", "\x1c", "▁", "\x00", ". ", "é ", "漢字 ", "<|endoftext|>", "12", "½"]
    texts = ["".join(rng.choice(frames.WORDS) + rng.choice(marks) for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += [t or "" for t in TEXTS] + ["x" * 30_000, "".join(chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x11000)])) for _ in range(3000))]
    for text in texts:
        assert tokens.encode([text])[0] == model.encode(" " + text, add_special_tokens=False).ids


def test_gallop_finds_what_bisection_finds():
    rng = np.random.default_rng(3)
    for _ in range(200):
        ends = np.unique(rng.integers(0, 60, rng.integers(0, 30)))
        wanted = rng.integers(-2, 64, rng.integers(0, 20))
        guess = rng.integers(-3, len(ends) + 3, len(wanted))
        assert al.gallop(ends, wanted, guess).tolist() == np.searchsorted(ends, wanted).tolist()


def test_common_ends_of_several_texts():
    rng = np.random.default_rng(4)
    for _ in range(100):
        cuts = np.sort(rng.choice(np.arange(1, 200), 5, replace=False))
        lists = [np.unique(np.concatenate([rng.choice(np.arange(1, cuts[-1] + 1), n), cuts])) for n in rng.integers(1, 80, 2)]
        bounds = [np.concatenate([[0], np.searchsorted(x, cuts, side="right")]) for x in lists]
        in_a, in_b = al.common_ends(*lists, *bounds)
        both = np.intersect1d(*lists)
        assert lists[0][in_a].tolist() == both.tolist() == lists[1][in_b].tolist()


def test_pairs_of_large_groups_in_blocks(spark):
    # A group of many tokens on both sides: its pairs are the same in blocks of any size.
    part = al.Groups(["some words here, and again some words here 漢字漢字漢字"], al.BYTE_LEVEL, al.PIECES)
    part.a_end, part.b_end = np.array([len(part.a)]), np.array([len(part.b)])
    part.n_a, part.n_b, part.text = part.a_end, part.b_end, np.array([0])
    part.links = part.n_a * part.n_b
    whole = [x.tolist() for x in part.pairs(32_000)]
    assert sum(whole[2]) == len(part.a) * len(part.b)
    for most in (1, 7, 60, len(part.a) * len(part.b)):
        assert [x.tolist() for x in part.pairs(32_000, most)] == whole


def test_bytes_of_the_byte_level_letters():
    letters = al._byte_of_letter()
    assert sorted(letters.values()) == list(range(256)) and len(letters) == 256
    assert letters["Ġ"] == ord(" ") and letters["Ċ"] == ord("\n") and letters["a"] == ord("a")
