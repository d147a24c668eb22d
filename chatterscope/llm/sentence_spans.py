"""Substring deduplication over runs of consecutive sentences and passages inside of them.

A sentence ends after a word that ends in one of . ! ? or stands before a line end; a sentence of more
than LONGEST words goes on as another one after each LONGEST words.  Compared are lists of
words, A-Z lower-cased, so white space does not matter.  Hashed are
 - from every sentence on and up to every sentence, the shortest runs of at least RUN sentences and
   MIN_WORDS words;
 - wherever sentences begin, PASSAGE words from places chosen by content: of every NEAR consecutive places the
   one whose PASSAGE words have the smallest hash, the rightmost one of equal ones.  Two texts that share any
   PASSAGE + NEAR - 1 words in a row share such spans, and these leave out less than NEAR words at
   either end of what is shared.
Of all spans with one hash the first in order of (doc_id, row, place) stays; the words of every other one
are removed, with the white space that follows them.  All else stays as it was.

Spans meet by hash in one shuffle, ranked by place there.  The first places of hashes that a sample of the
documents shows to be frequent are aggregated in part by each task, at most FREQUENT rows, and broadcast; their
spans are dealt by document.  The sample decides on the way only, not on the result.

Defined results: null and empty texts stay as they are, as do texts of fewer than RUN sentences and
PASSAGE words.  Rows equal in doc_id and text are one document and get the same result; of documents with
equal doc_id those with the smaller hash of the text come first, and a null doc_id comes first of all.  All
columns of the input stay; `n_sentences` and `n_removed` (sentences that lose words) replace columns of
these names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterscope.llm import arrays
from chatterscope.session import cut_lineage

RUN = 3
MIN_WORDS = 15
LONGEST = 20
PASSAGE, NEAR = 32, 8
FREQUENT = 1_000
SAMPLE = 32  # a document of so many shows which hashes are frequent
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True
_LINE = np.zeros(256, bool)
_LINE[[0x0A, 0x0D]] = True


def sentences(data: np.ndarray, offsets: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word of every sentence, the texts' offsets in the sentences, starts of all words, and
    hashes of all words."""
    starts, ends, at = arrays.words(data, offsets, arrays.WHITE)
    hashes = arrays.span_hashes(arrays.LOWER[data], starts, ends)
    if not len(starts):
        return starts, np.zeros(len(offsets), np.int64), starts, hashes
    lines = np.concatenate(([0], np.cumsum(_LINE[data])))
    last = _END[data[ends - 1]]
    last[:-1] |= lines[starts[1:]] > lines[ends[:-1]]
    new = np.concatenate(([True], last[:-1]))
    new[at[:-1][at[:-1] < len(starts)]] = True
    begin = np.maximum.accumulate(np.where(new, np.arange(len(starts)), 0))
    first = np.flatnonzero((np.arange(len(starts)) - begin) % longest == 0)
    return first, np.searchsorted(first, at), starts, hashes


def runs(first: np.ndarray, at: np.ndarray, hashes: np.ndarray, run: int = RUN, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last sentence and hash of the runs, numbered over all texts."""
    n = len(first)
    words = np.append(first, len(hashes))
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    here = np.arange(n)
    end = np.maximum(here + run, np.searchsorted(words, words[:-1] + min_words, "left"))
    begin = np.minimum(here + 1 - run, np.searchsorted(words, words[1:] - min_words, "right") - 1)
    forward = end <= at[1:][text]
    backward = begin >= at[:-1][text]
    pairs = np.unique(
        np.concatenate((here[forward] << 32 | end[forward], begin[backward] << 32 | here[backward] + 1))
    )
    a, b = pairs >> 32, pairs & 0xFFFFFFFF
    return a, b, arrays.span_hashes(hashes, words[a], words[b])


def passages(at: np.ndarray, hashes: np.ndarray, size: int = PASSAGE, near: int = NEAR) -> np.ndarray:
    """First words of the spans of `size` words at places chosen by content; at: the texts' offsets in the words."""

    def firsts(at, n):  # of all runs of n within a text
        runs = np.maximum(np.diff(at) - n + 1, 0)
        ends = np.concatenate(([0], np.cumsum(runs)))
        return np.arange(ends[-1]) + np.repeat(at[:-1] - ends[:-1], runs), ends

    starts, ends = firsts(at, size)
    windows, _ = firsts(ends, near)
    if not len(windows):
        return windows
    upper = arrays.span_hashes(hashes, starts, starts + size) & np.uint64(0xFFFFFFFF00000000)
    key = upper | (np.uint64(0xFFFFFFFF) - np.arange(len(starts), dtype=np.uint64))
    least = np.lib.stride_tricks.sliding_window_view(key, near).min(axis=1)[windows]
    return starts[0xFFFFFFFF - np.unique(least & np.uint64(0xFFFFFFFF)).astype(np.int64)]


def _key():
    return F.xxhash64("doc_id", "text")


def spans(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS, longest: int = LONGEST) -> DataFrame:
    """(hash, doc_id, key, a, b): the spans of words a to b - 1 of all documents."""
    schema = T.StructType(
        [
            T.StructField("hash", T.LongType()),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("key", T.LongType()),
            T.StructField("a", T.IntegerType()),
            T.StructField("b", T.IntegerType()),
        ]
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in arrays.blocks(arrays.column(batch, "text")):
                first, at, _, words = sentences(data, offsets, longest)
                a, b, _ = runs(first, at, words, run, min_words)
                word = np.append(first, len(words))
                begin = passages(word[at], words)
                pairs = np.unique(np.concatenate((word[a] << 32 | word[b], begin << 32 | begin + PASSAGE)))
                a, b = pairs >> 32, pairs & 0xFFFFFFFF
                text = np.searchsorted(word[at], a, "right") - 1
                rows = pa.array(row + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(arrays.span_hashes(words, a, b).view(np.int64)),
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(a - word[at][text], pa.int32()),
                        pa.array(b - word[at][text], pa.int32()),
                    ],
                    names=schema.names,
                )

    return docs.select("doc_id", _key().alias("key"), "text").mapInArrow(hashed, schema)


def repeated(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS, longest: int = LONGEST) -> DataFrame:
    """(key, a, b): the spans that stand in an earlier place."""
    found = spans(docs, run, min_words, longest)
    sampled = spans(docs.filter(F.pmod(_key(), F.lit(SAMPLE)) == 0), run, min_words, longest)
    counts = sampled.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 2")
    frequent = cut_lineage(counts.orderBy(F.desc("n"), "hash").limit(FREQUENT).select("hash", F.lit(True).alias("often")))
    place = F.struct("doc_id", "key", "a")
    # the group without a hash takes all others, and meets none of them
    first = cut_lineage(
        found.join(F.broadcast(frequent), "hash", "left").groupBy(F.when(F.col("often"), F.col("hash")).alias("hash")).agg(F.min(place).alias("first"))
    )
    placed = found.join(F.broadcast(first), "hash", "left")
    # a rank, so that rows of one document given twice are both first; a frequent hash needs none and is dealt by document
    own = Window.partitionBy("hash", F.when(F.col("first").isNotNull(), F.col("key"))).orderBy("doc_id", "key", "a")
    ranked = placed.withColumn("rank", F.rank().over(own))
    return ranked.filter(F.coalesce(place > F.col("first"), F.col("rank") > 1)).select("key", "a", "b")


def dedup_spans(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS, longest: int = LONGEST) -> DataFrame:
    """The documents without the words of repeated spans, with `n_sentences` and `n_removed`."""
    covered = repeated(docs, run, min_words, longest).groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    kept = [f for f in docs.schema.fields if f.name not in ("n_sentences", "n_removed")]
    inputs = docs.select([F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(kept)] + [_key().alias("key")])
    joined = inputs.join(covered, "key", "left").drop("key")
    text_at = [f.name for f in kept].index("text")
    schema = T.StructType([*kept, T.StructField("n_sentences", T.IntegerType()), T.StructField("n_removed", T.IntegerType())])

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at)
            lists = batch.column(len(kept))
            for row, data, offsets in arrays.blocks(texts.cast(pa.large_string()).fill_null("")):
                n = len(offsets) - 1
                first, at, starts, _ = sentences(data, offsets, longest)
                word = np.append(first, len(starts))[at]
                depth = np.zeros(len(starts) + 1, np.int64)
                own = lists.slice(row, n)
                flat = own.flatten()
                base = np.repeat(word[:-1], own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                np.add.at(depth, flat.field("a").to_numpy() + base, 1)
                np.add.at(depth, flat.field("b").to_numpy() + base, -1)
                gone = np.cumsum(depth)[:-1] > 0
                hit = np.concatenate(([0], np.cumsum(np.logical_or.reduceat(gone, first)))) if len(first) else np.zeros(1, np.int64)
                removed = hit[at[1:]] - hit[at[:-1]]
                ends = np.append(starts[1:], len(data))
                full = np.diff(word) > 0
                ends[word[1:][full] - 1] = offsets[1:][full]
                out = texts.slice(row, n).to_pylist()
                for i in np.flatnonzero(removed).tolist():
                    stay = np.ones(offsets[i + 1] - offsets[i], bool)
                    for s in np.flatnonzero(gone[word[i] : word[i + 1]]) + word[i]:
                        stay[starts[s] - offsets[i] : ends[s] - offsets[i]] = False
                    out[i] = data[offsets[i] : offsets[i + 1]][stay].tobytes().decode()
                columns = [c.slice(row, n) for c in batch.columns[: len(kept)]]
                columns[text_at] = pa.array(out, texts.type)
                columns += [pa.array(np.diff(at), pa.int32()), pa.array(removed, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(cleaned, schema)
