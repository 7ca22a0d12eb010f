"""Document probabilities from subword lattices: every segmentation into pieces of a fixed vocabulary counts.

Pieces do not cross white space, so a document's lattice falls apart into those of its words, and its probability is
the product of theirs. That makes the distinct words the unit of work: words are counted over the corpus, the piece
probabilities are learnt from the training counts by expectation and maximisation over the lattices of all training
words, each distinct word gets its probability once, and documents look their words up. Words seen in training are
arcs of their own lattice as well, with their discounted relative frequency; the discount is what the piece
segmentations share. `lattice_score` is the probability by pieces alone.

The most frequent words, a fixed number, are sent to the tasks that read the documents; the others are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.frames import crc_of_id, stored, whole_text
from tidewarden.llm.lattice import Lattice, public_pieces, scores_of, starting_scores

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
_LATTICES: dict[int, Lattice] = {}


def lattice_of(pieces: list[bytes]) -> Lattice:
    """The trie, built once in each Python process."""
    key = hash(tuple(pieces))
    if key not in _LATTICES:
        _LATTICES.clear()
        _LATTICES[key] = Lattice(pieces)
    return _LATTICES[key]


def tokens(text: str | None) -> list[bytes]:
    """Words between white space, A to Z in lower case; white space is ASCII's."""
    return (text or "").encode("utf-8", "replace").lower().split()


def _counted(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words of (text, learn) with their training count and their count, summed within a task as far as memory goes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt, held = Counter(), Counter()

        def rows() -> pa.RecordBatch:
            seen = list(learnt.keys() | held.keys())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(seen, pa.binary()),
                    pa.array([learnt[w] for w in seen], pa.int64()),
                    pa.array([learnt[w] + held[w] for w in seen], pa.int64()),
                ],
                names=["word", "c", "uses"],
            )

        for batch in batches:
            for text, learn in zip(batch.column(0), batch.column(1), strict=True):
                (learnt if learn.as_py() else held).update(tokens(text.as_py()))
                if len(learnt) + len(held) > most:
                    yield rows()
                    learnt.clear()
                    held.clear()
        yield rows()

    return count


def word_counts(docs: DataFrame, most_in_task: int = 300_000) -> DataFrame:
    """(word, c, uses) from (text, learn): uses in training documents and in all."""
    counted = docs.select("text", "learn").mapInArrow(_counted(most_in_task), "word binary, c long, uses long")
    return counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("uses").alias("uses"))


def piece_scores(counts: DataFrame, pieces: list[bytes], ends: int, rounds: int) -> np.ndarray:
    """Natural logs of the piece probabilities, by `rounds` of expectation and maximisation over all training words.

    What comes back to the driver is one number for each piece of the fixed vocabulary.
    """
    logp = starting_scores(pieces)
    known = counts.filter("c > 0").select("word", "c")
    for _ in range(rounds):

        def expectation(batches: Iterator[pa.RecordBatch], logp: np.ndarray = logp) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(pieces))
            for batch in batches:
                weights = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
                total += lattice_of(pieces).expected(batch.column(0).to_pylist(), weights, logp)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["piece", "n"])

        sums = known.mapInArrow(expectation, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        expected = np.zeros(len(pieces))
        for row in sums.collect():
            expected[row.piece] = row.n
        if expected.sum():
            logp = scores_of(expected, ends)
    return logp


def likelihood(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    rounds: int = 3,
    modulus: int = 10,
    head_words: int = 150_000,
    smoothing: float = 0.1,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score) for each row.

    Scores are log10 probabilities of the whole text, its end included. Training documents are those whose
    crc32(doc_id) modulo `modulus` is not 0; a row without an id is scored but neither learnt nor held out. A null or
    empty text is its end alone. Repeated rows each count and each get a row. Without any training document the pieces
    keep the shares of their rank, and an unseen word costs the same as any other in the base score. An empty table
    gives an empty result. Other columns are not read.
    """
    remainder = crc_of_id(F.col("doc_id"), modulus)
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        whole_text(F.col("text")).alias("text"),
        F.coalesce(remainder == 0, F.lit(False)).alias("held_out"),
        F.coalesce(remainder != 0, F.lit(False)).alias("learn"),
    )
    pieces = public_pieces(vocabulary)
    counts = stored(word_counts(slim), "lm-words")
    ends = slim.filter("learn").count()
    facts = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count_if(F.col("c") > 0).alias("v"),
        F.count_if(F.col("c") == 1).alias("once"),
        F.count_if(F.col("c") == 2).alias("twice"),
    ).first()
    n, v = facts.n + ends, facts.v + (ends > 0)
    # The share of an absolute discount that the counts of counts suggest.
    discount = facts.once / (facts.once + 2 * facts.twice) if facts.once and facts.twice else 0.5
    left = discount * facts.v / n if facts.v else 1.0
    logp = piece_scores(counts, pieces, ends, rounds)
    starts = float(np.exp(logp[[p[:1] == b" " for p in pieces]]).sum())
    end = (ends or 1) / ((np.exp(logp).sum() or 1.0) * (n or 1))
    # A word ends where the next piece begins a word or the text ends.
    stop = np.log((starts + end) / starts)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            pieces_only = lattice_of(pieces).score(batch.column(0).to_pylist(), logp)
            share = np.log(left) + pieces_only + stop
            own = np.log(np.maximum(c - discount, 1e-300) / n) if n else np.full(len(c), -np.inf)
            whole = np.where(c > 0, np.logaddexp(share, own), share)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array((c > 0).astype(np.int64)),
                    pa.array(np.log10((c + smoothing) / (n + smoothing * (v + 1)))),
                    pa.array(whole / np.log(10)),
                    pa.array(pieces_only / np.log(10)),
                ],
                names=["word", "uses", "known", "base", "model", "lattice"],
            )

    shape = "word binary, uses long, known long, base double, model double, lattice double"
    words = stored(counts.select("word", "c", "uses").mapInArrow(scored, shape), "lm-scores")
    # The least frequency class, in steps of a few percent, above which at most `head_words` words lie.
    grade = F.floor(F.log2(F.col("uses")) * 16).cast("int")
    room, cut = head_words, 1 << 30
    for row in sorted(words.groupBy(grade.alias("grade")).count().collect(), key=lambda r: -r.grade):
        room -= row["count"]
        if room < 0:
            break
        cut = row.grade
    top = words.filter(grade >= cut).select("word", "known", "base", "model", "lattice").collect()
    values = np.array([[r.known, r.base, r.model, r.lattice] for r in top]).reshape(-1, 4)
    sent = docs.sparkSession.sparkContext.broadcast(({bytes(r.word): i for i, r in enumerate(top)}, values))
    del top

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, values = sent.value
        for batch in batches:
            sizes, sums, rest, times, bounds = [], [], [], [], [0]
            for text in batch.column(2):
                used = Counter(tokens(text.as_py()))
                sizes.append(sum(used.values()) + 1)
                at, often = [], []
                for word, often_here in used.items():
                    i = place.get(word)
                    if i is None:
                        rest.append(word)
                        times.append(often_here)
                    else:
                        at.append(i)
                        often.append(often_here)
                sums.append(np.array(often, dtype=float) @ values[at] if at else np.zeros(4))
                bounds.append(len(rest))
            sums = np.array(sums).reshape(-1, 4)
            bounds = pa.array(bounds, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(k) for k in (0, 1, 3)],
                    pa.array(sizes, pa.int64()),
                    pa.array(sums[:, 0].astype(np.int64)),
                    *[pa.array(sums[:, k]) for k in (1, 2, 3)],
                    pa.ListArray.from_arrays(bounds, pa.array(rest, pa.binary())),
                    pa.ListArray.from_arrays(bounds, pa.array(times, pa.int64())),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "model", "lattice", "rest", "times"],
            )

    numbered = slim.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "held_out")
    shape = (
        "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, "
        "lattice double, rest array<binary>, times array<long>"
    )
    read = stored(numbered.mapInArrow(looked_up, shape), "lm-documents")
    own = ["known", "base", "model", "lattice"]
    rest = read.select("row", F.inline(F.arrays_zip("rest", "times"))).withColumnRenamed("rest", "word")
    joined = rest.join(words, "word").select("row", *[(F.col(c) * F.col("times")).alias(c) for c in own])
    nothing = [F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out")]
    parts = read.select("row", "doc_id", "held_out", "n_tokens", *own).unionByName(
        joined.select("row", *nothing, F.lit(0).cast("long").alias("n_tokens"), *own)
    )
    summed = parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.sum("n_tokens").alias("n_tokens"),
        *[F.sum(c).alias(c) for c in own],
    )
    base_end = float(np.log10((ends + smoothing) / (n + smoothing * (v + 1))))
    model_end = float(np.log10(max(ends, 1) / max(n, 1)))
    return summed.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + base_end).alias("base_score"),
        (F.col("model") + model_end).alias("score"),
        (F.col("lattice") + float(np.log10(end))).alias("lattice_score"),
    )
