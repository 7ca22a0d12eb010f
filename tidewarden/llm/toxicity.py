"""Toxicity by a convolutional text classifier over hashed words, trained here in numpy.

A word's vector is the sum of hashed embeddings of the word, of its first six and of its first three bytes, so forms
not met in training share what their stems have. Filters of several widths run over the whole text, each keeps its
maximum, and a logistic layer turns the maxima into a probability. The fit takes a bounded sample; thresholds are
calibrated by language on all other training rows, from counts by bins of the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.frames import crc_of_id, free_name, stored, whole_text
from tidewarden.llm.tokens import BYTE_VALUE, STEP, chunks, mixed, words


@dataclass
class Shape:
    buckets: int = 1 << 16
    width: int = 12
    filters: int = 8
    spans: tuple[int, ...] = (1, 2, 3)
    epochs: int = 8
    batch: int = 32
    rate: float = 0.01
    decay: float = 1e-5
    seed: int = 5


def _prefix(starts: np.ndarray, ends: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the first n bytes of each word."""
    padded = np.concatenate([data, np.zeros(n, dtype=np.uint8)])
    out = np.full(len(starts), n, dtype=np.uint64)
    for k in range(n):
        value = np.where(starts + k < ends, BYTE_VALUE[padded[starts + k]], np.uint64(0))
        out = mixed(out + value + np.uint64(k + 1))
    return out


def hashed_words(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features: distinct words x 3 buckets, place of each word among them, bounds of the texts)."""
    hashes, bounds, starts, ends, data = words(column)
    _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    starts, ends = starts[first], ends[first]
    kinds = [mixed(hashes[first] + STEP), _prefix(starts, ends, data, 6), _prefix(starts, ends, data, 3)]
    return np.stack([k % np.uint64(buckets) for k in kinds], axis=1).astype(np.int64), place, bounds


class Network:
    """The weights and both directions of the classifier."""

    def __init__(self, shape: Shape):
        rng = np.random.Generator(np.random.PCG64(shape.seed))
        self.shape = shape
        self.embedding = rng.normal(0, 0.1, (shape.buckets, shape.width)).astype(np.float32)
        self.kernels = [rng.normal(0, 0.3, (s, shape.width, shape.filters)).astype(np.float32) for s in shape.spans]
        self.offsets = [np.zeros(shape.filters, dtype=np.float32) for _ in shape.spans]
        n = shape.filters * len(shape.spans)
        self.out = rng.normal(0, 0.3, n).astype(np.float32)
        self.bias = np.zeros(1, dtype=np.float32)

    def maxima(
        self, features: np.ndarray, place: np.ndarray, bounds: np.ndarray, located: bool
    ) -> tuple[np.ndarray, np.ndarray | None]:
        """(texts x filters: maxima, not below zero; if `located` the word where each stands, -1 where none is above)."""
        vectors = self.embedding[features].sum(axis=1)
        filled = np.flatnonzero(np.diff(bounds))
        tops, wheres = [], []
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        for span, kernel, offset in zip(self.shape.spans, self.kernels, self.offsets, strict=True):
            top = np.zeros((len(bounds) - 1, self.shape.filters), dtype=vectors.dtype)
            where = np.full(top.shape, -1, dtype=np.int64)
            if len(place):
                value = (vectors @ kernel[0])[place]
                for k in range(1, span):
                    # A filter that reaches beyond the text meets nothing there.
                    inside = owner[:-k] == owner[k:]
                    value[:-k] += (vectors @ kernel[k])[place[k:]] * inside[:, None]
                value += offset
                found = np.maximum.reduceat(value, bounds[filled], axis=0)
                top[filled] = np.maximum(found, 0)
                if located:
                    # The first word that has the maximum.
                    hit_word, hit_filter = np.nonzero((value == top[owner]) & (value > 0))
                    where[owner[hit_word][::-1], hit_filter[::-1]] = hit_word[::-1]
            tops.append(top)
            wheres.append(where)
        return np.concatenate(tops, axis=1), np.concatenate(wheres, axis=1) if located else None

    def probability(self, features: np.ndarray, place: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        top, _ = self.maxima(features, place, bounds, located=False)
        return 1 / (1 + np.exp(-np.clip(top @ self.out + self.bias, -30, 30).astype(float)))

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.kernels, *self.offsets, self.out, self.bias]

    def gradients(self, features: np.ndarray, place: np.ndarray, bounds: np.ndarray, target: np.ndarray, weight: np.ndarray):
        """(rows of the embedding that changed, gradients in the order of `parameters`)."""
        top, where = self.maxima(features, place, bounds, located=True)
        p = 1 / (1 + np.exp(-np.clip(top @ self.out + self.bias, -30, 30)))
        error = ((p - target) * weight / len(target)).astype(np.float32)
        back = error[:, None] * self.out
        vectors = self.embedding[features].sum(axis=1)
        kernels, offsets, rows, changes = [], [], [], []
        for i, span in enumerate(self.shape.spans):
            part = slice(i * self.shape.filters, (i + 1) * self.shape.filters)
            text, unit = np.nonzero(where[:, part] >= 0)
            at, amount = where[text, unit + part.start], back[text, unit + part.start]
            kernel = np.zeros_like(self.kernels[i])
            for k in range(span):
                inside = at + k < bounds[text + 1]
                word, u, a = place[at[inside] + k], unit[inside], amount[inside]
                np.add.at(kernel[k].T, u, vectors[word] * a[:, None])
                change = self.kernels[i][k].T[u] * a[:, None]
                for kind in range(features.shape[1]):
                    rows.append(features[word, kind])
                    changes.append(change)
            kernels.append(kernel)
            offsets.append(np.bincount(unit, amount, minlength=self.shape.filters).astype(np.float32))
        rows = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
        used, inverse = np.unique(rows, return_inverse=True)
        embedding = np.zeros((len(used), self.shape.width), dtype=np.float32)
        if len(rows):
            np.add.at(embedding, inverse, np.concatenate(changes))
        return used, [embedding, *kernels, *offsets, top.T @ error, error.sum(keepdims=True)]


def train(texts: pa.Array, target: np.ndarray, shape: Shape, weight: np.ndarray) -> Network:
    """Fit by Adam on mini-batches; only the rows of the embedding that a batch uses are changed."""
    network = Network(shape)
    rng = np.random.Generator(np.random.PCG64(shape.seed))
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    steps = 0
    parts = [hashed_words(texts.slice(low, high - low), shape.buckets) for low, high in chunks(texts)]
    offsets = np.cumsum([0] + [len(f) for f, _, _ in parts])
    features = np.concatenate([f for f, _, _ in parts])
    place = np.concatenate([p + o for (_, p, _), o in zip(parts, offsets, strict=False)])
    bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b) for _, _, b in parts]))])
    del parts
    for _ in range(shape.epochs):
        order = rng.permutation(len(target))
        for low in range(0, len(order), shape.batch):
            chosen = order[low : low + shape.batch]
            parts = [place[bounds[i] : bounds[i + 1]] for i in chosen]
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            own, inverse = np.unique(np.concatenate(parts), return_inverse=True)
            used, grads = network.gradients(features[own], inverse, ends, target[chosen], weight[chosen])
            steps += 1
            for i, (parameter, grad, (m, v)) in enumerate(zip(network.parameters(), grads, moments, strict=True)):
                at = used if i == 0 else slice(None)
                grad = grad + shape.decay * parameter[at]
                m[at] = 0.9 * m[at] + 0.1 * grad
                v[at] = 0.999 * v[at] + 0.001 * grad**2
                parameter[at] -= shape.rate * (m[at] / (1 - 0.9**steps)) / (np.sqrt(v[at] / (1 - 0.999**steps)) + 1e-8)
    return network


def _cut(low: np.ndarray, high: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The cut with the best F1 between groups of scores, highest first: least and greatest score, rows of each label."""
    f1 = 2 * np.cumsum(toxic) / (np.cumsum(toxic + clean) + toxic.sum())
    best = int(np.argmax(f1))
    after = high[best + 1] if best + 1 < len(high) else 0.0
    return float((low[best] + after) / 2)


def best_threshold(score: np.ndarray, target: np.ndarray) -> float:
    """The cut with the best F1, halfway between the scores around it."""
    # Only between different scores can a cut be made.
    value, place = np.unique(-score, return_inverse=True)
    return _cut(-value, -value, np.bincount(place, target), np.bincount(place, 1 - target))


@dataclass
class Model:
    """A trained network, or none where nothing could be learnt, and the thresholds by language."""

    network: Network | None
    share: float
    thresholds: dict[str, float]
    threshold: float


def _known(labels: DataFrame) -> DataFrame:
    return labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def _sampled(counts: dict[int, int], most_rows: int) -> Column:
    """Whether a row of (doc_id, toxic) is in a spread sample: at most about `most_rows` of each label."""
    spread = F.pmod(F.xxhash64(F.lit("toxic"), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    keep = F.lit(False)
    for label, n in counts.items():
        keep = keep | ((F.col("toxic") == label) & (spread < min(1.0, most_rows / n)))
    return keep


def fit(
    docs: DataFrame, labels: DataFrame, modulus: int = 5, most_rows: int = 4000, shape: Shape | None = None
) -> tuple[Model, Column]:
    """The classifier of rows whose crc32(doc_id) modulo `modulus` is not 0, and which (doc_id, toxic) it has seen.

    The fit takes a sample of about `most_rows` rows of each label, drawn by a digest of the id, but for a tenth of it.
    The share of toxic rows is that of all training rows. The thresholds are left to `calibrate`; if the fit would
    leave it no row of one label, the fit takes the tenth as well and the thresholds all rows.
    """
    shape = shape or Shape()
    known = _known(labels)
    training = docs.filter(crc_of_id(F.col("doc_id"), modulus) != 0).select("doc_id", whole_text(F.col("text")).alias("text"))
    counts = {r.toxic: r["count"] for r in training.select("doc_id").join(known, "doc_id").groupBy("toxic").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    if not counts.get(1) or not counts.get(0):
        return Model(None, share, {}, 0.5), F.lit(False)
    sampled, held_back = _sampled(counts, most_rows), F.pmod(F.xxhash64(F.lit("held"), F.col("doc_id")), F.lit(10)) == 0
    chosen = known.filter(sampled).withColumn("held", held_back)
    rows = training.join(F.broadcast(chosen), "doc_id").toArrow().sort_by("doc_id")
    target = rows.column("toxic").to_numpy().astype(np.float64)
    text = pa.concat_arrays(rows.column("text").cast(pa.large_string()).chunks)
    held = np.array(rows.column("held").to_pylist(), dtype=bool)
    used = [int((target[~held] == label).sum()) for label in (0, 1)]
    seen = sampled & ~held_back
    if 0 in used or any(counts[label] == used[label] for label in (0, 1)):
        held[:] = False
        seen = F.lit(False)
    fitted = np.flatnonzero(~held)
    # As many toxic rows' worth of weight as of others, whatever the sample holds.
    toxic = target[fitted].mean()
    weight = np.where(target == 1, 0.5 / toxic, 0.5 / (1 - toxic))
    network = train(text.take(pa.array(fitted)), target[fitted], shape, weight[fitted])
    return Model(network, share, {}, 0.5), seen


def calibrate(model: Model, judged: DataFrame, labels: DataFrame, seen: Column, bins: int = 64) -> None:
    """Set the thresholds from (doc_id, lang, score) of all training rows, but for those that the fit has `seen`.

    The rows are counted by language, label and bin of the score, `bins` to a unit of its logarithmic odds. The counts
    of a label stand for all its rows, seen ones too, so that a cut has its F1 at the rows' own share of toxic ones. A
    language with at least ten counted rows of each label gets its own threshold.
    """
    if model.network is None:
        return
    bounded = F.greatest(F.least(F.col("score"), F.lit(1 - 1e-15)), F.lit(1e-300))
    new = ~seen
    counted = (
        judged.join(_known(labels), "doc_id")
        .withColumn("bin", F.floor(F.log(bounded / (1 - bounded)) * bins))
        .groupBy(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "toxic", "bin")
        .agg(
            F.count("*").alias("n_all"), F.count_if(new).alias("n"),
            F.min(F.when(new, F.col("score"))).alias("low"), F.max(F.when(new, F.col("score"))).alias("high"),
        )
        .toArrow()
    )
    of = {name: counted.column(name).to_numpy() for name in ("toxic", "bin", "n_all", "n", "low", "high")}
    lang = np.array(counted.column("lang").to_pylist(), dtype=object)

    def threshold(rows: np.ndarray, least: int) -> float | None:
        label = {k: rows & (of["toxic"] == k) for k in (0, 1)}
        n = {k: of["n"][at].sum() for k, at in label.items()}
        if min(n.values()) < least:
            return None
        value, place = np.unique(-of["bin"][rows & (of["n"] > 0)], return_inverse=True)
        filled = {name: column[rows & (of["n"] > 0)] for name, column in of.items()}
        low, high = np.full(len(value), np.inf), np.full(len(value), -np.inf)
        np.minimum.at(low, place, filled["low"])
        np.maximum.at(high, place, filled["high"])
        toxic, clean = (
            np.bincount(place, filled["n"] * (filled["toxic"] == k)) * (of["n_all"][label[k]].sum() / n[k]) for k in (1, 0)
        )
        return _cut(low, high, toxic, clean)

    model.threshold = threshold(np.ones(len(lang), dtype=bool), 1)
    for name in sorted(set(lang)):
        own = threshold(lang == name, 10)
        if own is not None:
            model.thresholds[name] = own


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    """Probabilities that texts are toxic. The network is trained as if half of all texts were; scaled to the share."""
    out = np.full(len(texts), model.share)
    if model.network is None:
        return out
    for low, high in chunks(texts):
        p = model.network.probability(*hashed_words(texts.slice(low, high - low), model.network.shape.buckets))
        odds = p / (1 - p) * model.share / (1 - model.share)
        out[low:high] = odds / (1 + odds)
    return out


def scored(docs: DataFrame, model: Model, text: Column, name: str) -> DataFrame:
    """The columns of `docs` and the score of a text, under `name`."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores(sent.value, texts))], names=batch.schema.names)

    shape = docs.select("*", F.lit(0.0).alias(name)).schema
    return docs.select("*", whole_text(text).alias(name)).mapInArrow(score, shape)


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, most_rows: int = 4000) -> DataFrame:
    """(doc_id, held_out, score, predicted, threshold, rejected) for each row.

    `score` is the probability of being toxic, from the whole text alone; `predicted` is 1 from a score of 0.5;
    `threshold` is the one calibrated for the row's language (for all languages together where it has none) and
    `rejected` says whether the score reaches it. A null text counts as empty. Rows without an id are scored, but not
    learnt from and not held out; of several labels of a document the highest counts; repeated rows get equal scores.
    If there are not labels of both kinds, every score is the share of toxic ones, and nothing is rejected unless that
    share reaches 0.5. Empty tables give an empty result. Other columns are not read.
    """
    model, seen = fit(docs, labels, modulus, most_rows)
    slim = docs.select(
        "doc_id",
        F.coalesce(crc_of_id(F.col("doc_id"), modulus) == 0, F.lit(False)).alias("held_out"),
        "lang",
        whole_text(F.col("text")).alias("text"),
    )
    judged = stored(scored(slim, model, F.col("text"), "score").drop("text"), "toxicity-scores")
    calibrate(model, judged.filter("doc_id is not null and not held_out"), labels, seen)
    return judged.withColumn("threshold", threshold_of(model, F.col("lang"))).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "held_out",
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "threshold",
        (F.col("score") >= F.col("threshold")).alias("rejected"),
    )


def threshold_of(model: Model, lang: Column) -> Column:
    """The threshold for a row's language."""
    out = F.lit(model.threshold)
    for name, value in sorted(model.thresholds.items()):
        out = F.when(F.coalesce(lang.cast("string"), F.lit("")) == name, F.lit(value)).otherwise(out)
    return out


def without_toxic(docs: DataFrame, labels: DataFrame, modulus: int = 5, most_rows: int = 4000) -> DataFrame:
    """The rows and columns of `docs` that are not rejected."""
    model, seen = fit(docs, labels, modulus, most_rows)
    training = docs.filter(crc_of_id(F.col("doc_id"), modulus) != 0).select("doc_id", "lang", "text")
    calibrate(model, scored(training, model, F.col("text"), "score").drop("text"), labels, seen)
    name = free_name(docs, "toxicity")
    found = scored(docs, model, F.col("text"), name)
    return found.filter(F.col(name) < threshold_of(model, F.col("lang"))).select(*docs.columns)
