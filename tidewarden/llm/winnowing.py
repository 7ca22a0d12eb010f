"""Document fingerprints by winnowing.

Every run of `k` code points has a rolling hash. Of each window of `window` neighbouring hashes the smallest is kept, the
rightmost of equal ones, with its position. Two texts that share a passage of `k + window - 1` code points or more share
a kept hash from inside it; what they share below `k` code points never counts.

A document is also compared with the one after it. The rows are dealt to bins of a range of ids each, sorted, and gone
through in order; the first row of a bin is sent to the bin before it as well, so no bin needs more than its own rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.frames import whole_text
from tidewarden.llm.tokens import POWERS, chunks

HEX = np.array([f"{b:02x}" for b in range(256)], dtype="S2")


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """The hash of every `k` consecutive code points: the sum of (point + 1) * STEP ** place modulo 2 ** 64.

    It rolls: running sums over the text give the hash at any place by a difference and a shift of the powers.
    """
    up, down = POWERS.upto(len(points))
    upto = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], dtype=np.uint64, out=upto[1:])
    return (upto[k:] - upto[:-k]) * down[: len(points) - k + 1]


def minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash of each window, the rightmost of equal ones, every place once and ascending."""
    low, place, span = hashes, np.arange(len(hashes)), 1
    while span < window:
        # Two windows of `span` that overlap or touch make one of `span + step`.
        step = min(span, window - span)
        right = low[step:] <= low[:-step]
        low = np.where(right, low[step:], low[:-step])
        place = np.where(right, place[step:], place[:-step])
        span += step
    return place[np.diff(place, prepend=-1) > 0]


@dataclass(frozen=True)
class Winnower:
    k: int = 12
    window: int = 16
    block: int = 1 << 18

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, positions) kept of a text.

        A text of fewer than `k` code points has one hash, of the whole; one with fewer hashes than a window is one
        window; an empty one has none. Long texts are taken in blocks of windows.
        """
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if not len(points):
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        k = min(self.k, len(points))
        window = min(self.window, len(points) - k + 1)
        windows = len(points) - k - window + 2
        hashes, places = [], []
        for start in range(0, windows, self.block):
            stop = min(windows, start + self.block)
            part = gram_hashes(points[start : stop + window + k - 2], k)
            at = minima(part, window)
            hashes.append(part[at])
            places.append(start + at)
        # The first window of a block may keep what the last one before it has kept.
        kept = np.concatenate(places)
        once = np.diff(kept, prepend=-1) > 0
        return np.concatenate(hashes)[once], kept[once]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes over all hashes of two fingerprints, repeated ones counted; two empty ones are alike."""
    if not (len(a) or len(b)):
        return 1.0
    (a, n_a), (b, n_b) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = int(np.minimum(n_a[at_a], n_b[at_b]).sum())
    return both / (int(n_a.sum()) + int(n_b.sum()) - both)


def spelt(prints: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """Fingerprints as text: `hash:position` with the hash in hexadecimal, by position, comma-joined."""
    bounds = np.zeros(len(prints) + 1, dtype=np.int32)
    np.cumsum([len(h) for h, _ in prints], out=bounds[1:])
    hashes, places = (np.concatenate([p[i] for p in prints]) if prints else np.zeros(0, dtype=np.int64) for i in (0, 1))
    letters = HEX[hashes.astype(">u8").view(np.uint8)]
    ends = pa.array(np.arange(0, 16 * len(hashes) + 1, 16), pa.int64())
    words = pa.LargeStringArray.from_buffers(len(hashes), ends.buffers()[1], pa.py_buffer(letters.tobytes()))
    said = pc.binary_join_element_wise(words.cast(pa.string()), pa.array(places).cast(pa.string()), ":")
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), said), ",")


def fingerprints(docs: DataFrame, winnower: Winnower | None = None) -> DataFrame:
    """(doc_id, n_chars, hashes, positions) for each row; hashes as signed 64-bit numbers, in the order of the positions.

    Equal texts have equal fingerprints. A null or empty text has none; a null id is kept; repeated rows are treated
    alike; an empty table gives an empty result. Other columns are not read.
    """
    winnow = winnower or Winnower()

    def fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in chunks(batch.column(1)):
                texts = batch.column(1).slice(low, high - low).to_pylist()
                prints = [winnow(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([h.view(np.int64) for h, _ in prints], pa.list_(pa.int64())),
                        pa.array([p for _, p in prints], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_chars", "hashes", "positions"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    return slim.mapInArrow(fingerprinted, "doc_id long, n_chars long, hashes array<long>, positions array<long>")


def _ordered(docs: DataFrame) -> DataFrame:
    """(doc_id, text, key, tie): by key and tie the rows are in descending order of ids, null last, then by text."""
    digest = F.shiftrightunsigned(F.xxhash64("text"), 1)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text")).select(
        "doc_id",
        "text",
        F.coalesce(F.bitwise_not("doc_id"), F.lit(2**63 - 1)).alias("key"),
        # Negative with an id: the smallest id has the key of a null one.
        F.when(F.col("doc_id").isNull(), digest).otherwise(digest.bitwiseOR(F.lit(-(2**63)))).alias("tie"),
    )


def _bin_of(bounds: list[tuple[int, int]]) -> Column:
    """The number of bounds at or before (key, tie)."""
    keys = [k for k, _ in bounds]

    @F.pandas_udf("int")
    def bin_of(key: pd.Series, tie: pd.Series) -> pd.Series:
        key, tie = key.to_numpy(), tie.to_numpy()
        place = np.searchsorted(keys, key, side="right") if keys else np.zeros(len(key), dtype=np.int64)
        # Where bounds have the key of the row, the tie decides among these.
        for i in np.flatnonzero(np.searchsorted(keys, key, side="left") < place) if keys else ():
            place[i] = bisect_right(bounds, (int(key[i]), int(tie[i])), bisect_left(keys, int(key[i])), int(place[i]))
        return pd.Series(place.astype(np.int32))

    return bin_of("key", "tie")


def with_next(docs: DataFrame, chars_per_bin: int = 16_000_000, rows_per_bin: int = 500, most_bins: int = 50_000) -> DataFrame:
    """(bin, last, key, tie, doc_id, text, copies): each bin in one partition, in order, closed by a row with `last`.

    `last` marks a copy of the first row of the next bin, after the last one of the first; it may come several times.
    The bounds of the bins come from a sample of some twenty keys a bin. A row that repeats so often that
    it would fill bins of its own is counted first and stands as one, `copies` says for how many.
    """
    spark = docs.sparkSession
    rows = _ordered(docs)
    whole = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    by_rows = min(-(-whole.n // rows_per_bin), int(spark.conf.get("spark.sql.shuffle.partitions")))
    bins = min(most_bins, max(1, by_rows, -(-whole.chars // chars_per_bin)))
    sample = rows.select("key", "tie").filter(F.rand(7) < 20 * bins / max(1, whole.n)).toArrow() if bins > 1 else None
    seen = sorted(zip(*(sample.column(c).to_pylist() for c in ("key", "tie")), strict=True)) if sample else []
    bounds = [seen[len(seen) * i // bins] for i in range(1, bins)] if seen else []
    hot = sorted({b for b, after in zip(bounds, bounds[1:], strict=False) if b == after})
    bounds = sorted(set(bounds))
    rows = rows.withColumn("copies", F.lit(1).cast("long"))
    if hot:
        often = F.broadcast(spark.createDataFrame(hot, "key long, tie long"))
        counted = rows.join(often, ["key", "tie"], "left_semi").groupBy("key", "tie", "doc_id", "text").agg(F.sum("copies").alias("copies"))
        rows = rows.join(often, ["key", "tie"], "left_anti").unionByName(counted)
    dealt = rows.withColumn("bin", _bin_of(bounds))
    heads = sorted((r.bin, *r.head) for r in dealt.groupBy("bin").agg(F.min(F.struct("key", "tie")).alias("head")).collect())
    before = [(b, key, tie, heads[i - 1][0]) for i, (b, key, tie) in enumerate(heads)]
    first = F.broadcast(spark.createDataFrame(before, "bin int, head_key long, head_tie long, before int"))
    is_head = (F.col("key") == F.col("head_key")) & (F.col("tie") == F.col("head_tie"))
    own = F.struct(F.col("bin"), F.lit(False).alias("last"))
    ahead = F.struct(F.col("before").alias("bin"), F.lit(True).alias("last"))
    places = F.when(is_head, F.array(own, ahead)).otherwise(F.array(own))
    sent = dealt.join(first, "bin").select(F.inline(places), "key", "tie", "doc_id", "text", "copies")
    return sent.repartitionById(len(bounds) + 1, F.col("bin")).sortWithinPartitions("bin", "last", "key", "tie", "text")


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compared(docs: DataFrame, winnower: Winnower | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row.

    The next document is the one of the next smaller id, after the smallest that of the greatest; null ids come last,
    documents of one id by their texts, and a repeated row is followed by its copies. The edited text ends with the
    first code points of the next document, as many as a third of its own, or all of that. A null text is an empty one.
    Two empty fingerprints are alike. A single row is its own next one; an empty table gives an empty result. Other
    columns are not read.
    """
    winnow = winnower or Winnower()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size, pending = 0, None
        for batch in batches:
            for place, last, doc_id, text, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if pending is None and last:
                    continue
                same = pending is not None and pending[2] == text
                own = (place, doc_id, text, pending[3] if same else winnow(text), copies)
                if pending is not None:
                    if pending[4] > 1:
                        out.append(_pair(winnow, pending, pending, pending[4] - 1))
                    out.append(_pair(winnow, pending, own, 1))
                    size += len(pending[2]) + 100
                pending = None if last else own
                if size > 1 << 20:
                    yield _report(out)
                    out, size = [], 0
        if out:
            yield _report(out)

    rows = with_next(docs).select("bin", "last", "doc_id", "text", "copies")
    pairs = rows.mapInArrow(walk, f"{COMPARED}, rows long")
    return pairs.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).drop("rows", "col")


def _pair(winnow: Winnower, own: tuple, after: tuple, rows: int) -> tuple:
    _, doc_id, text, (hashes, places), _ = own
    third = len(text) // 3
    edited = text[: len(text) - third] + after[2][:third]
    changed = (hashes, places) if edited == text else winnow(edited)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    near = likeness(hashes, changed[0]), likeness(hashes, after[3][0])
    return doc_id, len(text), digest, (hashes, places), changed, *near, rows


def _report(pairs: list[tuple]) -> pa.RecordBatch:
    doc_id, n_chars, digest, own, changed, near_edited, near_next, rows = zip(*pairs, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc_id, pa.int64()),
            pa.array(n_chars, pa.int64()),
            pa.array(digest, pa.string()),
            spelt(own),
            spelt(changed),
            pa.array(near_edited, pa.float64()),
            pa.array(near_next, pa.float64()),
            pa.array(rows, pa.int64()),
        ],
        names=[*(c.split()[0] for c in COMPARED.split(", ")), "rows"],
    )
