"""Texts of Arrow batches as flat numpy arrays: blocks, code points, hashed words.

Everything works on blocks of a bounded number of bytes (a single longer text is a block of its
own), so memory does not depend on how many rows a batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PRIME = np.uint64((1 << 61) - 1)
#: A fixed number drawn at random.
_BASE = 1_743_018_276_593_820_411
_PART = 1 << 14
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: The bytes 0x20 and 0x09 to 0x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: The ASCII bytes that are neither letters nor digits.
NOT_WORD = np.zeros(256, bool)
NOT_WORD[[b for b in range(128) if not chr(b).isalnum()]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string column with 64-bit offsets; nulls are empty texts."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_string()).fill_null("")


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets of the texts in them."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of at most so many bytes, or one longer row."""
    data, offsets = flat(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and the offsets of the texts in them."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return points, before[offsets]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit values over all bits, in another way for every salt."""
    h = h ^ np.uint64((salt * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _fold(x: np.ndarray) -> np.ndarray:
    """Numbers below 2^64 to equal ones below 2^61 + 8, modulo 2^61 - 1."""
    return (x & _PRIME) + (x >> np.uint64(61))


def _reduced(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    x -= _PRIME * (x >= _PRIME)
    return x


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2^61 - 1 of numbers below it; in parts that stay in the cache."""
    low, half, tail = np.uint64(0xFFFFFFFF), np.uint64(32), np.uint64((1 << 29) - 1)
    out = np.empty(len(a), np.uint64)
    small = a.dtype.itemsize <= 4
    for k in range(0, len(a), _PART):
        x, y = a[k : k + _PART].astype(np.uint64, copy=False), b[k : k + _PART]
        y1, y0 = y >> half, y & low
        if small:  # below 2^32
            middle, top = x * y1, _fold(x * y0)
        else:
            x1, x0 = x >> half, x & low
            middle, top = x1 * y0 + x0 * y1, _fold(x0 * y0) + ((x1 * y1) << np.uint64(3))
        out[k : k + _PART] = _reduced(top + (middle >> np.uint64(29)) + ((middle & tail) << half))
    return out


def _power_table(n: int) -> list[np.ndarray]:
    """Powers 0 to n - 1 of a fixed number, and of its inverse, modulo 2^61 - 1."""
    while len(_powers[0]) < n:
        size = len(_powers[0])
        for k, base in enumerate((_BASE, pow(_BASE, -1, int(_PRIME)))):
            step = np.full(size, pow(base, size, int(_PRIME)), np.uint64)
            _powers[k] = np.concatenate((_powers[k], times(_powers[k], step)))
    return _powers


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for every span; equal spans have equal hashes.

    A polynomial modulo the prime 2^61 - 1: two spans of at most n values, chosen without regard to the
    base, meet with a probability of n / 2^61.  (Modulo a power of two there are short texts that meet for every
    base.)  Where more depends on it than that, see distinct_spans.
    """
    power, inverse = _power_table(len(values) + 1)
    # no value counts as nothing
    if values.dtype.itemsize < 8:
        v = values.astype(np.uint32) + np.uint32(1)
    else:
        v = _reduced(_reduced(values.view(np.uint64)) + np.uint64(1))
    terms = times(v, power[: len(v)])
    sums = np.zeros((2, len(v) + 1), np.uint64)  # of the lower 30 and the upper 31 bits
    np.cumsum(terms & np.uint64((1 << 30) - 1), out=sums[0, 1:])
    np.cumsum(terms >> np.uint64(30), out=sums[1, 1:])
    low, high = sums[0, ends] - sums[0, starts], _reduced(sums[1, ends] - sums[1, starts])
    high = ((high << np.uint64(30)) & _PRIME) + (high >> np.uint64(31))
    h = times(_reduced(low + high), inverse[starts])
    return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def distinct_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct spans in order, a span of each, and every span's place in them.

    Every span is compared with the one that stands for it; those that differ in spite of equal hashes
    come after the others, each text once, with a hash that says nothing.
    """
    distinct, chosen, which = np.unique(span_hashes(values, starts, ends), return_index=True, return_inverse=True)
    wrong = differing(values, starts, ends, values, starts[chosen[which]], ends[chosen[which]])
    if wrong.any():
        seen: dict[bytes, int] = {}
        more = []
        for i in np.flatnonzero(wrong).tolist():
            text = values[starts[i] : ends[i]].tobytes()
            if text not in seen:
                seen[text] = len(distinct) + len(more)
                more.append(i)
            which[i] = seen[text]
        distinct = np.concatenate((distinct, distinct[:1].repeat(len(more))))
        chosen = np.concatenate((chosen, more))
    return distinct, chosen, which


def differing(a: np.ndarray, a_starts: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Which spans of a are not equal to the spans of b beside them."""
    sizes = a_ends - a_starts
    out = sizes != b_ends - b_starts
    sizes = np.where(out, 0, sizes)
    at = np.concatenate(([0], np.cumsum(sizes)))
    place = np.arange(at[-1])
    unequal = np.flatnonzero(a[place + np.repeat(a_starts - at[:-1], sizes)] != b[place + np.repeat(b_starts - at[:-1], sizes)])
    out[np.searchsorted(at, unequal, "right") - 1] = True
    return out


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the n + 1 offsets of the texts in the words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separator[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, A-Z lower-cased, and the offsets of the texts in them."""
    starts, ends, at = words(data, offsets, separator)
    return span_hashes(LOWER[data], starts, ends), at


def run_hashes(h: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n values within a text; a shorter text, but not an empty one, is a
    run.  Also the offsets of the texts in the runs."""
    sizes = np.diff(offsets)
    runs = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    at = np.concatenate(([0], np.cumsum(runs)))
    starts = np.arange(at[-1]) + np.repeat(offsets[:-1] - at[:-1], runs)
    ends = np.minimum(starts + n, np.repeat(offsets[1:], runs))
    out = np.zeros(len(starts), np.uint64)
    for k in range(n):  # a word counts by its place in the run
        place = np.minimum(starts + k, max(len(h) - 1, 0))
        out = np.where(starts + k < ends, mix(out * _STEP + h[place], k), out) if len(h) else out
    return out, at


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
