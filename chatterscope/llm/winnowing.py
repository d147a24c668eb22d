"""Document fingerprints by winnowing.

A rolling polynomial hash is taken of every K characters (code points).  Of every WINDOW consecutive hashes
the smallest is chosen, the rightmost one of equal ones; a hash chosen by several windows counts once, with
its position.  Two texts that share any WINDOW + K - 1 characters in a row so share a chosen hash, and none
is shared by chance of passages shorter than K.  A text of fewer than WINDOW hashes is one
window; one of fewer than K characters has the hash of all of it.

Defined results: null and empty texts have an empty fingerprint; two empty fingerprints are alike by 1, an
empty and another one by 0.  Equal texts have equal fingerprints.  All columns of the input stay; columns
that are added replace others of their names.

`compare_with_next` compares every document with the one that follows in descending order of (doc_id, text);
after the last comes the first, so a single document follows itself; nulls come last.  Documents are dealt to ranges of ids and
each range is sorted.  The first document of a range is also sent, marked, to the range before it, so that no
range waits for another and texts move once.  The ranges' limits are quantiles of the ids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterscope.llm import arrays
from chatterscope.session import cut_lineage

K = 8
WINDOW = 8
RANGE_ROWS = 2_000
MOST_RANGES = 20_000
_BASE = 0x9E3779B97F4A7C15


def _doubled(values: np.ndarray, size: int, join) -> np.ndarray:
    """join over every run of `size` values, by runs of doubling size; as long as values, with no meaning
    in the last size - 1 places."""
    have, out = 1, values
    while have < size:
        step = min(have, size - have)
        shifted = np.concatenate((out[step:], np.repeat(out[-1:], step)))
        out, have = join(out, shifted, have, step), have + step
    return out


def gram_hashes(points: np.ndarray, k: int = K) -> np.ndarray:
    """Rolling hashes of every k characters."""
    power = [pow(_BASE, n, 1 << 64) for n in range(k + 1)]
    # hash(i, n) = sum of point[i + j] * base^j; runs of n and m join as hash(i, n) + base^n * hash(i + n, m)
    out, have = arrays.mix(points.astype(np.uint64)), 1
    while have < k:
        if 2 * have <= k:
            shifted = np.concatenate((out[have:], np.zeros(have, np.uint64)))
            out, have = out + np.uint64(power[have]) * shifted, 2 * have
        else:  # the last characters one by one
            single = arrays.mix(points.astype(np.uint64))
            for j in range(have, k):
                out = out + np.uint64(power[j]) * np.concatenate((single[j:], np.zeros(j, np.uint64)))
            have = k
    return arrays.mix(out)


def winnow(points: np.ndarray, at: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chosen hashes (32 bits) and their positions in the text, and the texts' offsets in them."""
    n = np.diff(at)
    grams = np.where(n >= k, n - k + 1, 0)
    if not len(points):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    h = gram_hashes(points, k) >> np.uint64(32)
    place = np.arange(len(points))
    # rightmost of equal ones: the smallest of (hash, distance from the end)
    key = h << np.uint64(32) | (np.uint64(0xFFFFFFFF) - place.astype(np.uint64))
    least = _doubled(key, window, lambda a, b, *_: np.minimum(a, b))
    windows = np.where(grams >= window, grams - window + 1, 0)
    ends = np.concatenate(([0], np.cumsum(windows)))
    first = np.arange(ends[-1]) + np.repeat(at[:-1] - ends[:-1], windows)
    chosen = np.unique(least[first] & np.uint64(0xFFFFFFFF))[::-1]
    positions = 0xFFFFFFFF - chosen.astype(np.int64)
    # texts of a single window or of fewer than k characters
    few = np.flatnonzero((n > 0) & (grams < window))
    values = h[positions].astype(np.uint32)
    if len(few):
        extra_place, extra_hash = [], []
        for i in few.tolist():
            if grams[i]:
                best = int(np.min(key[at[i] : at[i] + grams[i]]))
                extra_place.append(0xFFFFFFFF - (best & 0xFFFFFFFF))
                extra_hash.append(best >> 32)
            else:
                whole = arrays.span_hashes(points[at[i] : at[i + 1]], np.zeros(1, np.int64), n[i : i + 1])
                extra_place.append(int(at[i]))
                extra_hash.append(int(whole[0] >> np.uint64(32)))
        positions = np.concatenate((positions, np.array(extra_place, np.int64)))
        values = np.concatenate((values, np.array(extra_hash, np.uint32)))
        order = np.argsort(positions, kind="stable")
        positions, values = positions[order], values[order]
    offsets = np.searchsorted(positions, at)
    return values, positions - np.repeat(at[:-1], np.diff(offsets)), offsets


def likeness(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the sets of hashes, text by text."""
    rows = len(a_at) - 1

    def distinct(values, at):
        return np.unique(np.repeat(np.arange(rows), np.diff(at)) << 32 | values.astype(np.int64))

    x, y = distinct(a, a_at), distinct(b, b_at)
    both = np.bincount(np.intersect1d(x, y, assume_unique=True) >> 32, minlength=rows)
    every = np.bincount(x >> 32, minlength=rows) + np.bincount(y >> 32, minlength=rows) - both
    return np.where(every > 0, both / np.maximum(every, 1), 1.0)


def as_text(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """The hashes in order, eight hexadecimal digits each."""
    digits = np.frombuffer(values.astype(">u4").tobytes().hex().encode(), np.uint8)
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at * 8), pa.py_buffer(digits.tobytes())).cast(pa.string())


def fingerprint(docs: DataFrame, text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """The rows with `hashes` and `positions` (arrays of long and int) of their texts."""
    kept = [f for f in docs.schema.fields if f.name not in ("hashes", "positions")]
    schema = T.StructType([*kept, T.StructField("hashes", T.ArrayType(T.LongType())), T.StructField("positions", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.select([f.name for f in kept])
            for row, data, offsets in arrays.blocks(arrays.column(batch, text)):
                values, places, at = winnow(*arrays.code_points(data, offsets), k, window)
                part = rest.slice(row, len(offsets) - 1)
                made = [arrays.list_array(values.astype(np.int64), at, pa.int64()), arrays.list_array(places, at, pa.int32())]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=schema.names)

    return docs.mapInArrow(run, schema)


def _range_of(number, limits: list[int]):
    """The number of limits (sorted) that are not above the value, by binary search."""
    if not limits:
        return F.lit(0)
    size = 1 << len(limits).bit_length()
    padded = F.lit([*limits, *[2**63 - 1] * (size - len(limits))])
    steps = F.lit([size >> k for k in range(1, size.bit_length())])
    return F.aggregate(steps, F.lit(0), lambda r, step: F.when(number >= F.get(padded, r + step - 1), r + step).otherwise(r))


def dealt(docs: DataFrame, text: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """(part, lent, doc_id, text): ranges of rows in descending order of (doc_id, text), each in one task and
    followed by the rows, marked as lent, with the largest doc_id of the next range."""
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    ids = cut_lineage(docs.select(number.alias("n")))
    ranges = max(1, min(MOST_RANGES, ids.count() // range_rows))
    limits = ids.approxQuantile("n", [k / ranges for k in range(1, ranges)], 0.2 / ranges) if ranges > 1 else []
    limits = sorted({int(x) for x in limits})
    tops = {r.r: r.top for r in ids.groupBy(_range_of(F.col("n"), limits).alias("r")).agg(F.max("n").alias("top")).collect()}
    present = sorted(tops, reverse=True)
    place = {r: k for k, r in enumerate(present)}
    part = F.get(F.lit([place.get(r, 0) for r in range(len(limits) + 1)]), F.col("r"))
    top = F.get(F.lit([tops[r] for r in present] or [0]), F.col("part"))
    rows = docs.select("doc_id", F.col(text).alias("text"), number.alias("n"), _range_of(number, limits).alias("r"))
    rows = rows.withColumn("part", part)
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("lent"))
    before = F.struct(((F.col("part") + max(0, len(present) - 1)) % max(1, len(present))).cast("int").alias("part"), F.lit(True).alias("lent"))
    both = F.when(F.col("n") == top, F.array(own, before)).otherwise(F.array(own))
    sent = rows.select("doc_id", "text", "n", F.explode(both).alias("to")).select("to.part", "to.lent", "n", "doc_id", "text")
    order = ["part", "lent", F.desc("n"), F.desc_nulls_last("text")]
    return sent.repartition("part").sortWithinPartitions(*order).drop("n")


def compare_with_next(docs: DataFrame, text: str = "text", k: int = K, window: int = WINDOW, range_rows: int = RANGE_ROWS) -> DataFrame:
    """For every row (doc_id, text): its text with the last half replaced by the first characters of the next
    document, both fingerprints, and how alike the edited text and the next document are."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def compared(ids: pa.Array, texts: list[str], lent: list[bool]) -> pa.RecordBatch:
        """All rows but the last, and but those lent."""
        edited = []
        for own, after in zip(texts, texts[1:]):
            half = len(own) // 2
            edited.append(own[: len(own) - half] + after[:half])
        prints = winnow(*arrays.code_points(*arrays.flat(pa.array(texts, pa.large_string()))), k, window)
        others = winnow(*arrays.code_points(*arrays.flat(pa.array(edited, pa.large_string()))), k, window)
        n = len(edited)
        values, at = prints[0], prints[2]
        hexed = [hashlib.sha256(x.encode()).hexdigest() for x in edited]
        made = pa.RecordBatch.from_arrays(
            [
                ids.slice(0, n),
                pa.array([len(x) for x in texts[:n]], pa.int64()),
                pa.array(hexed, pa.string()),
                as_text(values[: at[n]], at[: n + 1]),
                as_text(others[0], others[2]),
                pa.array(likeness(values[: at[n]], at[: n + 1], others[0], others[2])),
                pa.array(likeness(values[: at[n]], at[: n + 1], values[at[1] :], at[1:] - at[1])),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )
        return made.filter(pa.array([not x for x in lent[:n]], pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row so far
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            texts, lent = batch.column("text").fill_null("").to_pylist(), batch.column("lent").to_pylist()
            a = 0
            while a < len(texts) - 1:
                b, size = a, 0
                while b < len(texts) - 1 and (b == a or size < arrays.BLOCK_BYTES // 4):
                    size += len(texts[b])
                    b += 1
                yield compared(batch.column("doc_id").slice(a), texts[a : b + 1], lent[a : b + 1])
                a = b
            held = batch.slice(len(texts) - 1)

    return dealt(docs, text, range_rows).select("doc_id", "text", "lent").mapInArrow(run, schema)
