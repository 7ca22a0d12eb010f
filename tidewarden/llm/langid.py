"""Language identification by unigram pieces, summed over all segmentations.

Each language has its own probabilities for the pieces of one fixed public vocabulary. A text's probability in a
language is that of its words, and a word's is the sum over all its segmentations, by a forward algorithm over its
bytes. With the languages' shares as prior, the most probable language is predicted; the score is its posterior.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.frames import crc_of_id, whole_text
from tidewarden.llm.lattice import public_pieces, scores_of, starting_scores
from tidewarden.llm.likelihood import VOCABULARY, lattice_of
from tidewarden.llm.tokens import chunks, words


def _distinct_words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """For ranges of rows: first and last row, word bounds, place of each word among the distinct ones, these."""
    for low, high in chunks(column):
        hashes, bounds, starts, ends, data = words(column.slice(low, high - low))
        distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        raw = data.tobytes()
        yield low, high, bounds, place, distinct, [raw[starts[i] : ends[i]] for i in first]


def fit(labelled: DataFrame, pieces: list[bytes], rounds: int) -> tuple[list[str], np.ndarray]:
    """(languages, piece scores: pieces x languages) from a bounded sample of (lang, text)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0)
            for low, high, bounds, place, _, distinct in _distinct_words(batch.column(1)):
                for i in range(high - low):
                    used, n = np.unique(place[bounds[i] : bounds[i + 1]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang[low + i].as_py()] * len(used), pa.string()),
                            pa.array([distinct[k] for k in used], pa.binary()),
                            pa.array(n, pa.int64()),
                        ],
                        names=["lang", "word", "n"],
                    )

    def learn(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
        logp = starting_scores(pieces)
        for _ in range(rounds):
            logp = scores_of(lattice_of(pieces).expected(list(counts["word"]), counts["n"].to_numpy(float), logp))
        return pd.DataFrame({"lang": [key[0]], "scores": [logp]})

    counts = labelled.select("lang", "text").mapInArrow(counted, "lang string, word binary, n long")
    counts = counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("lang").applyInPandas(learn, "lang string, scores array<double>").orderBy("lang").collect()
    scores = np.array([r.scores for r in rows]).T if rows else np.zeros((len(pieces), 0))
    return [r.lang for r in rows], scores


def identify(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    modulus: int = 5,
    sample_docs: int = 1500,
    rounds: int = 3,
    cached_words: int = 300_000,
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row.

    Learnt from rows with a language whose crc32(doc_id) modulo `modulus` is not 0: the languages' shares from all
    of them, the piece probabilities from a sample of about `sample_docs` rows a language, taken by a digest of the
    id. `und` with score 0 is predicted where the text is null or has no letter, and everywhere if nothing could be
    learnt. Words are those of `tokens.words`. Of equally probable languages the first by code point
    is taken. A row without an id is not learnt from and not held out; repeated rows get equal results; an empty
    table gives an empty result. Other columns are not read.
    """
    remainder = crc_of_id(F.col("doc_id"), modulus)
    labelled = docs.filter((remainder != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    shares = {r.lang: r["count"] for r in labelled.groupBy(F.col("lang").cast("string").alias("lang")).count().collect()}
    pieces = public_pieces(vocabulary)
    if shares:
        rate = F.create_map(*[x for lang, n in shares.items() for x in (F.lit(lang), F.lit(min(1.0, sample_docs / n)))])
        # An even spread of the ids over [0, 1).
        spread = F.pmod(F.xxhash64(F.lit("langid"), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
        languages, scores = fit(labelled.filter(spread < F.element_at(rate, F.col("lang"))), pieces, rounds)
    else:
        languages, scores = [], np.zeros((len(pieces), 0))
    prior = np.log(np.array([shares[x] for x in languages], dtype=float) / max(1, sum(shares.values())))
    sent = docs.sparkSession.sparkContext.broadcast(scores)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = sent.value
        known: dict[int, int] = {}
        values = np.zeros((cached_words, len(languages)))
        for batch in batches:
            lettered = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            best, share = [], []
            for low, high, bounds, place, distinct, spelt in _distinct_words(batch.column(1)):
                if len(known) + len(distinct) > cached_words:
                    known.clear()
                hashes = distinct.tolist()
                missing = [i for i, h in enumerate(hashes) if h not in known]
                if len(missing) > cached_words:
                    found = lattice_of(pieces).score(spelt, scores)
                else:
                    new = lattice_of(pieces).score([spelt[i] for i in missing], scores)
                    values[len(known) : len(known) + len(missing)] = new
                    known.update({hashes[i]: k for k, i in enumerate(missing, len(known))})
                    found = values[[known[h] for h in hashes]]
                upto = np.zeros((len(place) + 1, len(languages)))
                np.cumsum(found[place], axis=0, out=upto[1:])
                total = prior + upto[bounds[1:]] - upto[bounds[:-1]]
                if languages:
                    top = total.argmax(axis=1)
                    best += top.tolist()
                    share += (1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)).tolist()
            sure = lettered if languages else np.zeros(len(lettered), dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([languages[b] if s else "und" for b, s in zip(best or [0] * len(sure), sure, strict=True)]),
                    pa.array([float(p) if s else 0.0 for p, s in zip(share or [0.0] * len(sure), sure, strict=True)]),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        whole_text(F.col("text")).alias("text"),
        F.coalesce(remainder == 0, F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    return slim.mapInArrow(predicted, "doc_id long, held_out boolean, lang_pred string, score double")
