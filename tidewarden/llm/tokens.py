"""Words of Arrow string columns as 64-bit hashes, computed on the column's bytes without a loop over words."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Odd 64-bit multipliers; products and sums wrap around.
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


# Characters of scripts that put no blanks between words: each is a word of its own. Unicode blocks.
UNSPACED = (
    (0x0E00, 0x0EFF),  # Thai, Lao
    (0x1000, 0x109F),  # Myanmar
    (0x1780, 0x17FF),  # Khmer
    (0x2E80, 0x2FDF),  # radicals
    (0x3005, 0x3007),
    (0x3021, 0x3029),
    (0x3040, 0x30FF),  # Hiragana, Katakana
    (0x31F0, 0x31FF),
    (0x3400, 0x4DBF),  # Han
    (0x4E00, 0x9FFF),
    (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F),
    (0x20000, 0x3FFFF),
)
SEPARATOR, IN_WORD, OWN_WORD = 0, 1, 2


@functools.cache
def _kinds() -> np.ndarray:
    """The kind of every code point: letters, numbers and marks stand in words."""
    kinds = np.array([unicodedata.category(chr(c))[0] in "LNM" for c in range(0x110000)], dtype=np.uint8)
    for low, high in UNSPACED:
        kinds[low : high + 1] *= OWN_WORD
    return kinds


def _in_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each byte of UTF-8 text belongs to a word, and the places where a word ends though the next byte is in one."""
    inside = _kinds()[:128][np.minimum(data, 127)] > 0
    high = np.flatnonzero(data >= 0xC0)
    inside[data >= 0x80] = False
    if not len(high):
        return inside, high
    lead = data[high].astype(np.int64)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead & (0xFF >> (size + 1))
    for k in (1, 2, 3):
        more = size > k
        point[more] = point[more] << 6 | data[high[more] + k] & 0x3F
    kind = _kinds()[point]
    word = kind > 0
    inside[np.repeat(high[word] - np.cumsum(size[word]) + size[word], size[word]) + np.arange(size[word].sum())] = True
    own = kind == OWN_WORD
    return inside, np.concatenate([high[own], high[own] + size[own]])


BYTE_VALUE = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


class _Powers:
    """STEP and its inverse to the powers 0, 1, 2, ..., as far as needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.full(n, STEP, dtype=np.uint64)
            back = np.full(n, np.uint64(_inverse(int(STEP))), dtype=np.uint64)
            steps[0] = back[0] = 1
            self.up, self.down = np.cumprod(steps, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
        return self.up, self.down


POWERS = _Powers()


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the offsets of its values in them."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, most_bytes: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most_bytes` in all; a longer value is a range of its own."""
    if len(column) == 0:
        return
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, before + most_bytes, side="right")))
        yield start, end
        start = end


def runs(inside: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place, this one exclusive, of the runs of marked bytes; no run reaches over a cut."""
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    begins[cuts] |= inside[cuts]
    ends[cuts - 1] |= inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def run_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each start to its stop, from running sums over all bytes."""
    up, down = POWERS.upto(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return mixed((sums[stops] - sums[starts]) * down[starts])


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, bounds, starts, ends, data): the words of all values, one after the other.

    `bounds[i]:bounds[i + 1]` are the words of value i, `data[starts[k]:ends[k]]` the bytes of word k. A word
    is a run of letters, numbers and marks of any script, in lower case; a character of a script that puts no blanks
    between words is a word of its own. A null value has none.
    """
    lowered = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    data, offsets = string_bytes(lowered)
    if not len(data):
        empty = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), np.zeros(len(column) + 1, dtype=np.int64), empty, empty, data
    inside, cuts = _in_words(data)
    # Two neighbouring values without a separator between them are two words.
    starts, stops = runs(inside, np.concatenate([offsets[1:-1], cuts]))
    hashes = run_hashes(data, starts, stops)
    return hashes, np.searchsorted(starts, offsets), starts, stops, data


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every `size` consecutive words and their bounds; a shorter text with words is one shingle."""
    counts = np.diff(bounds)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_bounds = np.zeros(len(bounds), dtype=np.int64)
    np.cumsum(n, out=out_bounds[1:])
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    if not len(hashes):
        return total[:0], out_bounds
    # Position of each shingle's first word.
    first = np.arange(out_bounds[-1], dtype=np.int64) + np.repeat(bounds[:-1] - out_bounds[:-1], n)
    padded = np.concatenate([hashes, np.zeros(size, dtype=np.uint64)])
    short = np.repeat((counts < size) * counts, n)
    made = np.zeros(len(first), dtype=np.uint64)
    factor = int(STEP)
    for k in range(size):
        value = padded[first + k]
        if short.any():
            value = np.where((short > 0) & (k >= short), np.uint64(0), value)
        made += value * np.uint64(factor)
        factor = (factor * int(STEP) | 1) % (1 << 64)
    return mixed(made), out_bounds
