"""A bigram language model with interpolated modified Kneser-Ney smoothing.

Tokens are the words between white space, A-Z lower-cased, and one end per text; the first token follows a
beginning that is no token.  Counting is two shuffles.  Words are counted and get ids by the order
of their hashes.  Bigrams (id, id) are counted in each task, and the distinct ones go to parts by ranges
of their first word; the bigrams of words that alone would make up a large piece of a part (a bounded
number of words) are spread over all parts.  Each part adds up its bigrams, writes them as a sorted array,
and sends on how many kinds of bigrams each word begins and ends, which the word parts add up.

The model is a folder of flat sorted arrays in the shared folder: hashes and counts of words, bigrams and
their counts, numbers of kinds.  Workers map these files into memory and look the distinct tokens and
bigrams of a block of texts up by binary search in sorted order.  The shared folder has to be mounted
on all machines; that is what mapping files asks for.

The probability of a word is (c - D(c)) / c(previous) + gamma(previous) * p1(word); p1 is the same over
numbers of kinds, and at its end a uniform share for each of the V known words and one unknown word, so all
probabilities after any word sum to 1.  After an unknown word it is p1.

Defined results: null and empty texts are one end token.  Rows count as often as they are repeated.  Files
are written under a new name and moved, so a repeated task changes nothing.  Without training rows the
one unknown word has probability 1.  All columns of the input stay; the columns added replace others of
their names.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterscope.llm import arrays
from chatterscope.session import cut_lineage, fresh_path

END = np.uint64(0x6B3C0F7E51A2D984)
FLUSH = 4_000_000  # bigrams that a task holds
PART_TOKENS = 1_000_000  # training tokens to a part of the bigrams
WORDS_IN_PART = 500_000
ADDED = (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double"))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens, ends included, and the texts' offsets in them."""
    words, at = arrays.word_hashes(data, offsets)
    n = len(at) - 1
    out = np.full(len(words) + n, END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(at))] = words
    return out, at + np.arange(n + 1)


def local(path: str) -> str:
    """The mounted folder of a path."""
    scheme, _, rest = path.partition(":")
    if scheme == "file" and rest:
        return "/" + rest.lstrip("/")
    if "://" in path:
        raise ValueError(f"the model's files are mapped into memory: {path} has to be a mounted folder")
    return path


def _save(folder: str, name: str, values: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    fresh = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    values.tofile(fresh)
    os.replace(fresh, os.path.join(folder, name))


def _map(folder: str, name: str, kind: type) -> np.ndarray:
    path = os.path.join(folder, name)
    return np.memmap(path, kind, "r") if os.path.exists(path) and os.path.getsize(path) else np.zeros(0, kind)


class Model:
    """The mapped arrays of a folder."""

    def __init__(self, folder: str, with_bigrams: bool = True):
        with open(os.path.join(folder, "model.json")) as file:
            self.__dict__.update(json.load(file))
        self.folder = folder
        self.shift = np.uint64(64 - self.word_bits)
        self.begin = np.array(self.begin, np.int64)
        self.words = [_map(folder, f"words-{k}", np.uint64) for k in range(1 << self.word_bits)]
        self.counts = [_map(folder, f"counts-{k}", np.uint64) for k in range(1 << self.word_bits)]
        self.hot = np.array(self.hot, np.int64)
        if with_bigrams:
            self.kinds = [_map(folder, f"kinds-{k}", np.uint32).reshape(4, -1) for k in range(1 << self.word_bits)]
            self.begun = np.array(self.begun, np.int64)
            self.bigrams = [_map(folder, f"bigrams-{k}", np.uint64) for k in range(self.parts)]
            self.bigram_counts = [_map(folder, f"times-{k}", np.uint32) for k in range(self.parts)]

    def part(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The part that holds each bigram."""
        out = first * self.parts // (self.size + 1)
        hot = np.isin(first, self.hot)
        spread = arrays.mix(first[hot].astype(np.uint64) << np.uint64(32) | second[hot].astype(np.uint64))
        out[hot] = (spread % np.uint64(self.parts)).astype(np.int64)
        return out

    def ids(self, h: np.ndarray) -> np.ndarray:
        """The ids of distinct sorted hashes, -1 for unknown words."""
        out = np.full(len(h), -1, np.int64)
        group = (h >> self.shift).astype(np.int64) if self.word_bits else np.zeros(len(h), np.int64)
        edges = np.searchsorted(group, np.arange((1 << self.word_bits) + 1))
        for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            known = self.words[k]
            if a < b and len(known):
                place = np.minimum(np.searchsorted(known, h[a:b]), len(known) - 1)
                out[a:b] = np.where(known[place] == h[a:b], place + self.begin[k], -1)
        return out

    def of_words(self, tables: list, ids: np.ndarray) -> np.ndarray:
        """Rows of per-word tables; ids are sorted and known."""
        edges = np.searchsorted(ids, self.begin)
        parts = [tables[k][..., ids[edges[k] : edges[k + 1]] - self.begin[k]] for k in range(len(tables))]
        return np.concatenate(parts, axis=-1)

    def discount(self, n: np.ndarray, of: list[float]) -> np.ndarray:
        return np.array([0.0, *of])[np.minimum(n, 3).astype(np.int64)]

    def score(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The columns ADDED of all texts."""
        h, at = tokens(data, offsets)
        distinct, which = np.unique(h, return_inverse=True)
        ids = self.ids(distinct)
        known = ids >= 0
        count = np.zeros(len(ids))
        kinds = np.zeros((4, len(ids)))
        count[known] = self.of_words(self.counts, ids[known])
        kinds[:, known] = self.of_words(self.kinds, ids[known])
        base = np.log10((count + 0.1) / (self.tokens + 0.1 * (self.size + 1)))
        ended = kinds[3]
        p1 = self.uniform + (ended - self.discount(ended, self.word_discounts)) / max(1, self.all_kinds)
        gamma = np.where(count > 0, np.array(self.discounts) @ kinds[:3] / np.maximum(count, 1), 1.0)
        # one more row: the beginning of a text
        gamma = np.append(gamma, np.array(self.discounts) @ self.begun / self.texts if self.texts else 1.0)
        count, ids = np.append(count, self.texts), np.append(ids, self.size if self.texts else -1)
        before = np.empty_like(which)
        before[1:] = which[:-1]
        before[at[:-1]] = len(ids) - 1
        pairs, place = np.unique(before << 32 | which, return_inverse=True)
        first, second = pairs >> 32, pairs & 0xFFFFFFFF
        times = self.times(ids[first], ids[second])
        p = gamma[first] * p1[second] + (times - self.discount(times, self.discounts)) / np.maximum(count[first], 1)
        sums = lambda v: np.add.reduceat(v, at[:-1]) if len(at) > 1 else v[:0]
        return [np.diff(at), sums(known[which].astype(np.int64)), sums(base[which]), sums(np.log10(p)[place])]

    def times(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of distinct bigrams, 0 for unknown ones."""
        out = np.zeros(len(first), np.int64)
        rows = np.flatnonzero((first >= 0) & (second >= 0))
        key = first[rows].astype(np.uint64) << np.uint64(32) | second[rows].astype(np.uint64)
        part = self.part(first[rows], second[rows])
        order = np.lexsort((key, part))
        edges = np.searchsorted(part[order], np.arange(self.parts + 1))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            own = order[edges[k] : edges[k + 1]]
            have = self.bigrams[k]
            if len(have):
                place = np.minimum(np.searchsorted(have, key[own]), len(have) - 1)
                out[rows[own]] = np.where(have[place] == key[own], self.bigram_counts[k][place], 0)
        return out


@lru_cache(maxsize=2)
def load(folder: str, with_bigrams: bool = True) -> Model:
    return Model(folder, with_bigrams)


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(hash, n): how often each token occurs."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held):
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["hash", "n"])

        held, size = [], 0
        for batch in batches:
            for _, data, offsets in arrays.blocks(arrays.column(batch, text)):
                held.append(tokens(data, offsets)[0])
                size += len(held[-1])
                if size > FLUSH:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    return docs.select(text).mapInArrow(counted, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))


def _discounts(n: list[int]) -> list[float]:
    """Modified discounts of counts 1, 2 and more, from the numbers of things counted 1 to 4 times;
    fixed ones where too few things were counted for that."""
    if min(n) <= 0:
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return [float(min(max(d, 0.05), 0.95 * (k + 1))) for k, d in enumerate(found)]


def train(docs: DataFrame, text: str = "text") -> str:
    """Count the texts; the model's folder below the shared folder."""
    spark = docs.sparkSession
    folder = local(fresh_path(spark, "bigrams"))
    os.makedirs(folder, exist_ok=True)
    words = cut_lineage(count_words(docs, text))
    size, n_tokens = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = max(0, (size // WORDS_IN_PART).bit_length())

    def write_words(key, rows):
        k = key[0].as_py()
        h = rows.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(h)
        _save(folder, f"words-{k}", h[order])
        _save(folder, f"counts-{k}", rows.column("n").to_numpy()[order].astype(np.uint64))
        return pa.table({"part": pa.array([k], pa.int32()), "size": pa.array([len(h)], pa.int64())})

    part = F.shiftrightunsigned("hash", 64 - bits).cast("int") if bits else F.lit(0)
    sizes = np.zeros(1 << bits, np.int64)
    for row in words.withColumn("part", part).groupBy("part").applyInArrow(write_words, "part int, size bigint").collect():
        sizes[row.part] = row.size
    begin = np.concatenate(([0], np.cumsum(sizes)))
    parts = max(1, -(-n_tokens // PART_TOKENS))
    texts = docs.count()
    about = {"word_bits": bits, "size": size, "tokens": n_tokens, "texts": texts, "parts": parts, "begin": begin.tolist(), "hot": []}

    def describe(**more):
        about.update(more)
        fresh = os.path.join(folder, f".model-{uuid.uuid4().hex}")
        with open(fresh, "w") as file:
            json.dump(about, file)
        os.replace(fresh, os.path.join(folder, "model.json"))

    describe()
    # at most 4 * parts words can be so frequent
    frequent = words.filter(F.col("n") > n_tokens / (4 * parts)).select("hash").collect()
    hot = Model(folder, False).ids(np.sort(np.array([r.hash for r in frequent], np.int64).view(np.uint64)))
    describe(hot=[*hot.tolist(), size])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(folder, False)

        def rows(held):
            key, n = np.unique(np.concatenate(held), return_counts=True)
            part = model.part((key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64))
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(model.parts + 1))
            used = np.flatnonzero(np.diff(edges))
            own = [order[edges[k] : edges[k + 1]] for k in used.tolist()]
            once = [key[o[n[o] == 1]].tobytes() for o in own]
            more = [np.concatenate((key[o[n[o] > 1]], n[o[n[o] > 1]].astype(np.uint64))).tobytes() for o in own]
            return pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())], names=["part", "once", "more"]
            )

        held, size = [], 0
        for batch in batches:
            for _, data, offsets in arrays.blocks(arrays.column(batch, text)):
                h, at = tokens(data, offsets)
                distinct, which = np.unique(h, return_inverse=True)
                ids = model.ids(distinct)[which].astype(np.uint64)
                before = np.empty_like(ids)
                before[1:] = ids[:-1]
                before[at[:-1]] = model.size
                held.append(before << np.uint64(32) | ids)
                size += len(ids)
                if size > FLUSH:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    schema = "part int, ids binary, kinds binary, n array<bigint>"

    def message(part, ids, kinds, n):
        return pa.table(
            {
                "part": pa.array(part, pa.int32()),
                "ids": pa.array(ids, pa.binary()),
                "kinds": pa.array(kinds, pa.binary()),
                "n": pa.array(n, pa.list_(pa.int64())),
            }
        )

    def add_up(key, rows):
        """Write the part's bigrams; send on the kinds that words begin (1, 2, more) and end."""
        once = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("once")]
        more = [np.frombuffer(x.as_buffer(), np.uint64).reshape(2, -1) for x in rows.column("more")]
        every = np.concatenate([*once, *(m[0] for m in more)])
        times = np.concatenate([*(np.ones(len(o), np.uint64) for o in once), *(m[1] for m in more)])
        order = np.argsort(every, kind="stable")
        every, times = every[order], times[order]
        start = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        bigram, n = every[start], np.add.reduceat(times, start).astype(np.int64)
        k = key[0].as_py()
        _save(folder, f"bigrams-{k}", bigram)
        _save(folder, f"times-{k}", np.minimum(n, 2**32 - 1).astype(np.uint32))
        kind = np.minimum(n, 3) - 1
        first, second = (bigram >> np.uint64(32)).astype(np.int64), (bigram & np.uint64(0xFFFFFFFF)).astype(np.int64)
        event = np.concatenate((first << 2 | kind, second << 2 | 3))
        event, seen = np.unique(event, return_counts=True)
        where = np.searchsorted(begin, event >> 2, "right") - 1
        where[event >> 2 == size] = -2  # the beginning of texts
        edges = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1]))) if len(where) else np.zeros(0, np.int64)
        ends = np.append(edges[1:], len(where))
        counts = [[int((n == c).sum()) for c in (1, 2, 3, 4)]]
        return message(
            [*where[edges].tolist(), -1],
            [*(event[a:b].astype(np.int64).tobytes() for a, b in zip(edges, ends)), b""],
            [*(seen[a:b].astype(np.uint32).tobytes() for a, b in zip(edges, ends)), b""],
            [*([[]] * len(edges)), *counts],
        )

    def write_kinds(key, rows):
        k = key[0].as_py()
        if k == -1:
            total = np.sum([x.as_py() for x in rows.column("n")], axis=0)
            return message([k], [b""], [b""], [total.tolist()])
        width = 1 if k == -2 else int(sizes[k])
        base = size if k == -2 else int(begin[k])
        table = np.zeros((4, width), np.uint32)
        for ids, kinds in zip(rows.column("ids"), rows.column("kinds")):
            event = np.frombuffer(ids.as_buffer(), np.int64)
            np.add.at(table, (event & 3, (event >> 2) - base), np.frombuffer(kinds.as_buffer(), np.uint32))
        if k == -2:
            return message([k], [b""], [b""], [table[:3, 0].tolist()])
        _save(folder, f"kinds-{k}", table)
        ended = table[3]
        counts = [int((ended == c).sum()) for c in (1, 2, 3, 4)]
        return message([k], [b""], [b""], [[*counts, int((ended > 2).sum()), int(ended.astype(np.int64).sum())]])

    counted = docs.select(text).mapInArrow(pairs, "part int, once binary, more binary").groupBy("part").applyInArrow(add_up, schema)
    numbers = counted.groupBy("part").applyInArrow(write_kinds, schema).select("part", "n").collect()
    zero = [0, 0, 0, 0]
    bigram_n = next((r.n for r in numbers if r.part == -1), zero)
    begun = next((r.n for r in numbers if r.part == -2), zero[:3])
    ended = np.sum([r.n for r in numbers if r.part >= 0] or [[0] * 6], axis=0).tolist()
    word_discounts = _discounts(ended[:4])
    total = ended[5]
    left = sum(d * n for d, n in zip(word_discounts, [ended[0], ended[1], ended[4]])) / total if total else 1.0
    describe(
        begun=begun,
        discounts=_discounts(bigram_n),
        word_discounts=word_discounts,
        all_kinds=total,
        uniform=left / (size + 1),
    )
    return folder


def score(docs: DataFrame, folder: str, text: str = "text") -> DataFrame:
    """The rows with the columns ADDED and `train_tokens`."""
    names = {name for name, _ in ADDED} | {"train_tokens"}
    kept = [f for f in docs.schema.fields if f.name not in names]
    kinds = {"long": T.LongType(), "double": T.DoubleType()}
    schema = T.StructType([*kept, *(T.StructField(n, kinds[t]) for n, t in ADDED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(folder)
        for batch in batches:
            rest = batch.select([f.name for f in kept])
            for row, data, offsets in arrays.blocks(arrays.column(batch, text)):
                part = rest.slice(row, len(offsets) - 1)
                made = [pa.array(x) for x in model.score(data, offsets)]
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=schema.names)

    with open(os.path.join(folder, "model.json")) as file:
        n = json.load(file)["tokens"]
    return docs.mapInArrow(run, schema).withColumn("train_tokens", F.lit(n).cast("long"))


def perplexity(scored: DataFrame) -> DataFrame:
    """The rows of `score` with `perplexity`, the inverse geometric mean of a token's probability."""
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
