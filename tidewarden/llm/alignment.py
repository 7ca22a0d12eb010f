"""Alignment of two tokenizers by a galloping intersection of their token ends.

Both tokenizers cut the same bytes. The byte offsets where a token of each ends are found by galloping: every end of
the shorter list is sought in the longer one, in steps that double until it is passed, then by halving what is left.
The common ends slice both token sequences into groups; a group's ranks in the two lists say which tokens share it.

How many documents hold a pair of ids linked is counted over all documents. The counts of the most frequent pairs, a
bounded number, are sent to the tasks that score the documents; pairs beyond these meet their counts in a join, where
none of them can be frequent.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.frames import stored
from tidewarden.llm.tokens import chunks

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Visible characters of Latin-1 stand for their own byte, the other bytes take the code points from 256 on in turn.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in visible}
    for n, b in enumerate(sorted(set(range(256)) - set(visible))):
        letters[chr(256 + n)] = b
    return letters


class ByteLevelTokens:
    """Byte-level BPE of a blank and the text; strings of special tokens are plain text.

    The entries of the vocabulary file are merged by rank. That is the same as merging by the file's list, since its merges
    are in the order of the ids they make, and every entry is what the merges make of its own bytes.
    """

    # Fixed value: the public pattern that cuts texts before byte-level merges.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["id"]: t["content"] for t in model["added_tokens"]}
        letters = _byte_of_letter()
        vocabulary = model["model"]["vocab"]
        ranks = {bytes(letters[c] for c in entry): i for entry, i in vocabulary.items() if i not in special}
        self.model = tiktoken.Encoding("byte-level", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        entries = {i: entry for entry, i in ranks.items()} | {i: s.encode() for i, s in special.items()}
        self.spelt = [entries.get(i, b"") for i in range(max(entries) + 1)]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return [self.model.encode_ordinary(" " + text) for text in texts]


class PieceTokens:
    """Pieces of a text, to which the model adds a leading blank."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.spelt = [
            bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self.model.encode(list(texts), num_threads=1)


class Tokens:
    """The tokens of texts by both tokenizers."""

    def __init__(self, first: str, second: str):
        self.both = ByteLevelTokens(first), PieceTokens(second)
        self.sizes = [np.array([len(s) for s in t.spelt]) for t in self.both]

    def encode(self, texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, bounds) by each tokenizer: text i has the tokens `ids[bounds[i]:bounds[i + 1]]`.

        An empty text has no tokens, nor has one whose bytes differ by either tokenizer from a blank and the text.
        """
        ids = [t.encode(texts) for t in self.both]
        for i, text in enumerate(texts):
            whole = (" " + text).encode()
            if not text or any(b"".join(map(t.spelt.__getitem__, x[i])) != whole for t, x in zip(self.both, ids, strict=True)):
                ids[0][i] = ids[1][i] = []
        out = []
        for each in ids:
            bounds = np.zeros(len(texts) + 1, dtype=np.int64)
            np.cumsum([len(x) for x in each], out=bounds[1:])
            out.append((np.fromiter(itertools.chain.from_iterable(each), dtype=np.int32, count=int(bounds[-1])), bounds))
        return out


@functools.cache
def _tokens(first: str, second: str) -> Tokens:
    """Read once in a worker."""
    return Tokens(first, second)


def _sizes(first: str, second: str) -> tuple[int, int]:
    """Numbers of ids of both vocabularies."""
    return tuple(len(t.spelt) for t in _tokens(first, second).both)


def gallop(ends: np.ndarray, wanted: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """Place of the first of the ascending `ends` that is not below each wanted value, `len(ends)` if there is none.

    Every value starts at its own guess and strides away from it in steps of 1, 2, 4, ... until the value lies between
    two probes; the gap is then halved. All values take each step together.
    """
    n = len(ends)
    if not n or not len(wanted):
        return np.zeros(len(wanted), dtype=np.int64)
    guess = np.clip(guess, 0, n - 1)
    forward = ends[guess] < wanted
    low, high = np.where(forward, guess + 1, 0), np.where(forward, n, guess)
    going, step = np.arange(len(wanted)), 1
    while len(going):
        probe = guess[going] + np.where(forward[going], step, -step)
        inside = (probe >= 0) & (probe < n)
        going, probe = going[inside], probe[inside]
        below = ends[probe] < wanted[going]
        low[going[below]] = probe[below] + 1
        high[going[~below]] = probe[~below]
        going = going[below == forward[going]]
        step *= 2
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) // 2
        below = ends[middle] < wanted[going]
        low[going[below]] = middle[below] + 1
        high[going[~below]] = middle[~below]
        going = going[low[going] < high[going]]
    return low


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the ends that they have in common.

    The lists hold the ends of several texts one after the other, ascending throughout; text i has the places
    `a_bounds[i]:a_bounds[i + 1]` and `b_bounds[i]:b_bounds[i + 1]`. In each text the shorter list is sought in the longer.
    """
    n_a, n_b = np.diff(a_bounds), np.diff(b_bounds)
    in_a, in_b = np.zeros(len(a_ends), dtype=bool), np.zeros(len(b_ends), dtype=bool)
    for short, long, short_bounds, long_bounds, chosen, in_short, in_long in (
        (a_ends, b_ends, a_bounds, b_bounds, n_a <= n_b, in_a, in_b),
        (b_ends, a_ends, b_bounds, a_bounds, n_a > n_b, in_b, in_a),
    ):
        n_short, n_long = np.diff(short_bounds), np.diff(long_bounds)
        places = np.flatnonzero(np.repeat(chosen, n_short))
        text = np.repeat(np.arange(len(n_short)), n_short)[places]
        rank = places - short_bounds[text]
        guess = long_bounds[text] + rank * n_long[text] // np.maximum(1, n_short[text])
        found = gallop(long, short[places], guess)
        hit = found < len(long)
        hit[hit] = long[found[hit]] == short[places[hit]]
        in_short[places[hit]] = True
        in_long[found[hit]] = True
    return np.flatnonzero(in_a), np.flatnonzero(in_b)


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


class Groups:
    """The tokens of some texts and the groups into which their common ends cut them, as flat arrays.

    Text i has the tokens `a_bounds[i]:a_bounds[i + 1]` of A, the same of B, and the groups `bounds[i]:bounds[i + 1]`; group
    g ends before the tokens `a_end[g]` and `b_end[g]`. A text without tokens has no groups.
    """

    def __init__(self, texts: Sequence[str], first: str, second: str):
        tokens = _tokens(first, second)
        (self.a, self.a_bounds), (self.b, self.b_bounds) = tokens.encode(texts)
        # Both cut the same bytes of each text, so the running ends of all texts can be compared as they are.
        self.ends = np.cumsum(tokens.sizes[0][self.a])
        in_a, in_b = common_ends(self.ends, np.cumsum(tokens.sizes[1][self.b]), self.a_bounds, self.b_bounds)
        self.a_end, self.b_end = in_a + 1, in_b + 1
        self.n_a, self.n_b = np.diff(self.a_end, prepend=0), np.diff(self.b_end, prepend=0)
        self.links = self.n_a * self.n_b
        self.text = np.searchsorted(self.a_bounds, in_a, side="right") - 1
        self.bounds = np.searchsorted(self.text, np.arange(len(texts) + 1))

    def bytes_upto(self) -> np.ndarray:
        """Where each group ends in its text."""
        began = np.concatenate([[0], self.ends])[self.a_bounds[self.text]]
        return self.ends[self.a_end - 1] - began

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum over the groups of each text."""
        upto = np.concatenate([[0], np.cumsum(values)])
        return upto[self.bounds[1:]] - upto[self.bounds[:-1]]

    def pairs(self, b_size: int, most: int = 1 << 18) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links): each text's linked pairs of ids, ascending; a pair is a_id * b_size + b_id.

        Groups are gone through in blocks of about `most` links; of a larger group only the distinct ids are paired.
        """
        a_ids, b_ids = self.a.astype(np.int64), self.b.astype(np.int64)
        span = (int(a_ids.max()) + 1 if len(a_ids) else 1) * b_size
        keys, weights = [], []
        big = self.links > most
        for g in np.flatnonzero(big):
            a, n_a = np.unique(a_ids[self.a_end[g] - self.n_a[g] : self.a_end[g]], return_counts=True)
            b, n_b = np.unique(b_ids[self.b_end[g] - self.n_b[g] : self.b_end[g]], return_counts=True)
            rows = max(1, most // len(b))
            for i in range(0, len(a), rows):
                keys.append((self.text[g] * span + a[i : i + rows, None] * b_size + b).ravel())
                weights.append((n_a[i : i + rows, None] * n_b).ravel())
        small = np.flatnonzero(~big)
        upto = np.cumsum(self.links[small])
        edges = np.searchsorted(upto, np.arange(0, upto[-1] if len(upto) else 0, most), side="right")
        for low, high in itertools.pairwise([*edges, len(small)]):
            g = small[low:high]
            links = self.links[g]
            at = np.repeat(g, links)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(links) - links, links)
            a = a_ids[self.a_end[at] - self.n_a[at] + nth // self.n_b[at]]
            b = b_ids[self.b_end[at] - self.n_b[at] + nth % self.n_b[at]]
            distinct, n = np.unique(self.text[at] * span + a * b_size + b, return_counts=True)
            keys.append(distinct)
            weights.append(n)
        if not keys:
            empty = np.zeros(0, dtype=np.int64)
            return empty, empty, empty
        key, weight = keys[0], weights[0]
        if len(keys) > 1:
            key, weight = np.concatenate(keys), np.concatenate(weights)
            order = np.argsort(key, kind="stable")
            key, weight = key[order], weight[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            key, weight = key[first], np.add.reduceat(weight, first)
        return key // span, key % span, weight

    def spelt(self, names: Sequence[str], n_a: int, n_b: int) -> list[str]:
        """Each text's groups as `a1,a2|b1;a3|b2,b3`; '' without tokens. `names` are those of `_names`."""
        last_a, last_b = np.zeros(len(self.a), dtype=bool), np.zeros(len(self.b), dtype=bool)
        last_a[self.a_end - 1] = last_b[self.b_end - 1] = True
        order = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        # Before a token of A stand the groups before its own with their tokens of B; of B the other way round.
        group_a, group_b = np.repeat(np.arange(len(self.n_a)), self.n_a), np.repeat(np.arange(len(self.n_b)), self.n_b)
        order[np.arange(len(self.a)) + (self.b_end - self.n_b)[group_a]] = self.a + last_a * n_a
        order[np.arange(len(self.b)) + self.a_end[group_b]] = self.b + last_b * n_b + 2 * n_a
        said = list(map(names.__getitem__, order.tolist()))
        ends = self.a_bounds + self.b_bounds
        return ["".join(said[i:j])[:-1] for i, j in zip(ends[:-1], ends[1:], strict=True)]


def _names(n_a: int, n_b: int) -> list[str]:
    """The ids of A inside a group and at its end, then the same of B."""
    return [f"{i}{end}" for n, end in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";")) for i in range(n)]


def _grouped(texts: pa.Array, first: str, second: str) -> Iterator[tuple[int, int, Groups]]:
    """Ranges of rows with their groups."""
    for low, high in chunks(texts, 1 << 19):
        yield low, high, Groups([t or "" for t in texts.slice(low, high - low).to_pylist()], first, second)


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


ALIGNED = ("a_ids", "b_ids", "a_upto", "b_upto", "bytes_upto")


def aligned(docs: DataFrame, first: str = BYTE_LEVEL, second: str = PIECES) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_upto, b_upto, bytes_upto) for each row: the tokens and where their groups end.

    Group g has the tokens `a_upto[g - 1]:a_upto[g]` of `a_ids` and `b_upto[g - 1]:b_upto[g]` of `b_ids` and ends at the
    byte `bytes_upto[g]` of a blank and the text. All arrays are empty where the text is null or empty, or where either
    tokenizer's bytes differ from a blank and the text. Repeated rows are treated alike, a null id is kept, an empty
    table gives an empty result. Other columns are not read.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, part in _grouped(batch.column(1), first, second):
                lists = (
                    (part.a, part.a_bounds),
                    (part.b, part.b_bounds),
                    (part.a_end - part.a_bounds[part.text], part.bounds),
                    (part.b_end - part.b_bounds[part.text], part.bounds),
                    (part.bytes_upto(), part.bounds),
                )
                columns = [_lists(*x, pa.int32()) for x in lists]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *columns], names=["doc_id", *ALIGNED])

    return _slim(docs).mapInArrow(align, ", ".join(["doc_id long", *(f"{c} array<int>" for c in ALIGNED)]))


def _measured(docs: DataFrame, first: str, second: str) -> DataFrame:
    """(row, doc_id, the figures of one text, pairs, links): the linked pairs of each text and their links."""
    n_a, n_b = _sizes(first, second)
    kind, arrow_kind = ("int", pa.int32()) if n_a * n_b < 1 << 31 else ("long", pa.int64())
    columns = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _names(n_a, n_b)
        for batch in batches:
            for low, high, part in _grouped(batch.column(2), first, second):
                text, pair, links = part.pairs(n_b)
                bounds = np.searchsorted(text, np.arange(high - low + 1))
                digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in part.spelt(names, n_a, n_b)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(1).slice(low, high - low),
                        *map(pa.array, (np.diff(part.a_bounds), np.diff(part.b_bounds), np.diff(part.bounds), part.per_text(part.links))),
                        pa.array(digests),
                        _lists(pair, bounds, arrow_kind),
                        _lists(links, bounds, pa.int64()),
                    ],
                    names=[*columns, "pairs", "links"],
                )

    kinds = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in columns)
    rows = _slim(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(measure, f"{kinds}, pairs array<{kind}>, links array<long>")


def pair_counts(measured: DataFrame, b_size: int) -> DataFrame:
    """(pair, docs, best): in how many documents each pair is linked; best: no other pair of its first id is in more."""
    pairs = measured.select(F.explode("pairs").alias("pair"))
    counts = stored(pairs.groupBy("pair").agg(F.count("*").alias("docs")), "align-pairs")
    a_id = F.floor(F.col("pair") / F.lit(b_size))
    # One row for each id of the first vocabulary.
    most = counts.groupBy(a_id.alias("a_id")).agg(F.max("docs").alias("most"))
    best = counts.withColumn("a_id", a_id).join(F.broadcast(most), "a_id")
    return best.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, first: str = BYTE_LEVEL, second: str = PIECES, sent_pairs: int = 1_000_000) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row, see `aligned`.

    A link is an occurrence of a token of each tokenizer in one group; a pair's count is the number of documents that
    hold it linked. `n_best` counts the links whose pair has the highest count of its first id, ties included,
    `count_sum` sums the counts over the links. `groups_sha256` is the digest of the ids as `a1,a2|b1;a3|b2,b3`, '' without
    tokens. Repeated rows count as documents of their own. About `sent_pairs` counts at most are sent to the tasks
    whatever the size of the corpus; rarer pairs are joined.
    """
    n_b = _sizes(first, second)[1]
    measured = stored(_measured(docs, first, second), "align-measured")
    counts = stored(pair_counts(measured, n_b), "align-counts")
    total = counts.count()
    frequent = counts
    if total > sent_pairs:
        share = 1 - 0.9 * sent_pairs / total
        frequent = counts.filter(F.col("docs") > counts.agg(F.percentile_approx("docs", share, 100_000)).first()[0])
    head = frequent.toArrow().sort_by("pair")
    sent = docs.sparkSession.sparkContext.broadcast([head.column(c).to_numpy() for c in ("pair", "docs", "best")])
    report = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs_of, is_best = sent.value
        for batch in batches:
            row, pairs, links = batch.columns
            edges = pairs.offsets.to_numpy().astype(np.int64)
            edges -= edges[0]
            pair, links = pairs.flatten().to_numpy(), links.flatten().to_numpy()
            if len(known):
                place = np.minimum(np.searchsorted(known, pair), len(known) - 1)
                there = known[place] == pair
                found = np.where(there, docs_of[place], 0), there & is_best[place]
            else:
                there = np.zeros(len(pair), dtype=bool)
                found = there, there
            upto = [np.concatenate([[0], np.cumsum(links * value)]) for value in found]
            rare = np.concatenate([[0], np.cumsum(~there)])[edges]
            yield pa.RecordBatch.from_arrays(
                [
                    row,
                    *(pa.array(u[edges[1:]] - u[edges[:-1]]) for u in upto),
                    _lists(pair[~there], rare, pa.int64()),
                    _lists(links[~there], rare, pa.int64()),
                ],
                names=["row", "count_sum", "n_best", "rare", "rare_links"],
            )

    # The figures of a text go through the tasks with its pairs.
    figures = F.struct(*[c for c in measured.columns if c in report]).alias("row")
    if total == len(head):
        kind = measured.select(figures).schema["row"].dataType.simpleString()
        out = measured.select(figures, "pairs", "links").mapInArrow(score, f"row {kind}, count_sum long, n_best long, rare array<long>, rare_links array<long>")
        return out.select("row.*", "count_sum", "n_best").select(report)
    out = measured.select("row", "pairs", "links").mapInArrow(score, "row long, count_sum long, n_best long, rare array<long>, rare_links array<long>")
    out = stored(out, "align-scored")
    rare = out.select("row", F.explode(F.arrays_zip(F.col("rare").alias("pair"), F.col("rare_links").alias("links"))).alias("x"))
    met = rare.select("row", "x.pair", "x.links").join(counts, "pair")
    more = met.select("row", (F.col("links") * F.col("docs")).alias("count_sum"), F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best"))
    sums = out.select("row", "count_sum", "n_best").unionByName(more).groupBy("row").agg(
        F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best")
    )
    return measured.join(sums, "row").select(report)
