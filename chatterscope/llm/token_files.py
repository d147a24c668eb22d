"""Token ids in compressed files with a shared zstandard dictionary.

Format: a folder with two Parquet tables.  `dictionary` has one row: the dictionary, its SHA-256, the width of
an id in bytes (2 or 4) and the end id.  `shards` has a row for each block of documents, in ascending order of
(doc_id, text): shard, block, doc_ids, starts (ids before each document in its shard), n_ids, offsets (of each
document's frame in `frames`, one more at the end), frames (one zstandard frame for each document, its ids as
little-endian integers), and dictionary_hash.  A short document is read by unpacking its own frame;
statistics on first_doc and last_doc let Parquet skip blocks.

The dictionary is trained on the ids of at most SAMPLE_DOCS documents, chosen by a hash; it decides on sizes,
never on results.  A reader refuses blocks whose hash is not that of the dictionary it has.

Encoding: texts are cut before runs of ASCII white space that follow other characters.  No token of this
kind of tokenizer goes across such a place, so each distinct stretch is encoded once by the tokenizers
library.  Texts with other white space or where the library would see it differently are encoded whole.

Defined results: null and empty texts are the end id alone.  Rows of equal doc_id are ordered by text and all
kept; a null doc_id comes first.  Files are written by Spark's committer, so repeated tasks change nothing.
Only doc_id and text are used of the input.
"""

from __future__ import annotations

import hashlib
import itertools
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm import arrays
from chatterscope.llm.piece_bpe import gather
from chatterscope.session import cut_lineage, fresh_path

SAMPLE_DOCS = 2_000
DICTIONARY_BYTES = 65_536
LEVEL = 3
#: Distinct stretches in one call of the library.
JOINED = 200
#: Distinct stretches that a worker remembers.
MOST_SEEN = 1_500_000
BLOCK_DOCS = 1_000
BLOCK_BYTES = 2 << 20
#: First bytes of UTF-8 characters among which are white space beyond ASCII, and their second bytes.
_WIDE_SPACE = {0xC2: (0x85, 0xA0), 0xE1: (0x9A,), 0xE2: (0x80, 0x81), 0xE3: (0x80,)}


@cache
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def id_bytes(path: str) -> np.ndarray:
    """The number of bytes of every id's text: its characters, each of which stands for a byte."""
    vocabulary = load(path).get_vocab()
    out = np.zeros(max(vocabulary.values()) + 1, np.int64)
    out[list(vocabulary.values())] = [len(x) for x in vocabulary]
    return out


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the stretches that are encoded on their own, and marks of the bytes for which
    texts are left whole."""
    white = arrays.WHITE[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = white[1:] & ~white[:-1]
    odd = np.zeros(len(data), bool)
    for lead, seconds in _WIDE_SPACE.items():
        at = np.flatnonzero(data[:-1] == lead)
        odd[at[np.isin(data[at + 1], seconds)]] = True
    odd |= (data >= 0x1C) & (data <= 0x1F)
    if odd.any():
        for i in np.unique(np.searchsorted(offsets, np.flatnonzero(odd), "right") - 1).tolist():
            cut[offsets[i] : offsets[i + 1]] = False
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(cut), odd


def _library_ids(tokenizer, texts: list[str]) -> np.ndarray:
    encoded = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    return np.fromiter(itertools.chain.from_iterable(encoded), np.uint32)


class Seen:
    """Distinct stretches by hash, with their bytes and ids; emptied when there are MOST_SEEN, or many ids."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.first, self.last = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.bytes = np.zeros(0, np.uint32), np.zeros(0, np.uint8)

    def find(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of stretches, -1 for those not there; a stretch with the hash of another is not there."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        there = np.flatnonzero(self.hashes[at] == h)
        own = at[there]
        differ = arrays.differing(data, starts[there], ends[there], self.bytes, self.first[own], self.last[own])
        out = np.full(len(h), -1)
        out[there[~differ]] = own[~differ]
        return out

    def add(self, h: np.ndarray, ids: np.ndarray, edges: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        sizes = ends - starts
        at = np.concatenate(([0], np.cumsum(sizes)))
        hashes = np.concatenate((self.hashes, h))
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.starts = np.concatenate((self.starts, edges[:-1] + len(self.ids)))[order]
        self.sizes = np.concatenate((self.sizes, np.diff(edges)))[order]
        self.first = np.concatenate((self.first, at[:-1] + len(self.bytes)))[order]
        self.last = np.concatenate((self.last, at[1:] + len(self.bytes)))[order]
        self.ids = np.concatenate((self.ids, ids))
        self.bytes = np.concatenate((self.bytes, data[np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes)]))


@cache
def seen_of(path: str) -> Seen:
    return Seen()


def encode(path: str, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each with the end id, and the texts' offsets in them."""
    tokenizer, lengths, seen = load(path), id_bytes(path), seen_of(path)
    first, odd = cuts(data, offsets)
    ends = np.append(first[1:], len(data))
    distinct, chosen, which = arrays.distinct_spans(data, first, ends)
    if len(seen.hashes) + len(distinct) > MOST_SEEN or len(seen.ids) > 6 * MOST_SEEN or len(seen.bytes) > 20 * MOST_SEEN:
        seen.__init__()
    held = seen.find(distinct, data, first[chosen], ends[chosen])
    new = held < 0
    a, b = first[chosen[new]], ends[chosen[new]]
    # stretches from white space to another character can follow each other in one call: none of their
    # places is lost, so they are told apart by the bytes of the ids
    odds = np.concatenate(([0], np.cumsum(odd)))
    joins = arrays.WHITE[data[a]] & ~arrays.WHITE[data[b - 1]] & (odds[a] == odds[b])
    order = np.argsort(~joins, kind="stable")
    a, b, n = a[order], b[order], int(joins.sum())
    raw = data.tobytes()
    pieces = [raw[x:y] for x, y in zip(a.tolist(), b.tolist())]
    texts = [b"".join(pieces[k : min(k + JOINED, n)]).decode() for k in range(0, n, JOINED)]
    flat = _library_ids(tokenizer, texts + [x.decode() for x in pieces[n:]])
    reached = np.concatenate(([0], np.cumsum(lengths[flat])))
    edges = np.searchsorted(reached, np.concatenate(([0], np.cumsum(b - a))))
    if reached[-1] != (b - a).sum() or (reached[edges] != np.concatenate(([0], np.cumsum(b - a)))).any():
        raise ValueError("ids do not end where their texts do")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    made, edges = gather(flat, edges, back)
    # ids of the distinct stretches: those remembered, then the new ones
    pool = np.concatenate((seen.ids, made))
    starts, sizes = np.empty(len(chosen), np.int64), np.empty(len(chosen), np.int64)
    starts[~new], sizes[~new] = seen.starts[held[~new]], seen.sizes[held[~new]]
    starts[new], sizes[new] = edges[:-1] + len(seen.ids), np.diff(edges)
    seen.add(distinct[new], made, edges, data, first[chosen[new]], ends[chosen[new]])
    starts, sizes = starts[which], sizes[which]
    at = np.concatenate(([0], np.cumsum(sizes)))
    ids = pool[np.arange(at[-1]) + np.repeat(starts - at[:-1], sizes)]
    at = at[np.searchsorted(first, offsets)]
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(at))] = ids
    return out, at + np.arange(n + 1)


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int, width: int, most: int = SAMPLE_DOCS) -> bytes:
    """A dictionary trained on the ids of at most so many documents; empty if they are too few."""
    key = F.xxhash64("doc_id", "text")
    keys = docs.select(key.alias("key")).distinct().orderBy("key").limit(most)
    chosen = docs.withColumn("key", key).join(cut_lineage(keys), "key").select("text")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in arrays.blocks(arrays.column(batch, "text")):
                ids, at = encode(tokenizer_path, data, offsets, end_id)
                ids = ids.astype(f"<u{width}")
                # a dictionary holds no more of one document
                rows = [ids[a:b].tobytes()[:DICTIONARY_BYTES] for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    samples = sorted(bytes(r.ids) for r in chosen.mapInArrow(packed, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(raw: bytes):
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Write the ids of all documents (doc_id, text) to a new folder."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    vocabulary = load(tokenizer_path).get_vocab_size()
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    raw = train_dictionary(docs, tokenizer_path, end_id, width)
    digest = hashlib.sha256(raw).hexdigest()
    about = spark.createDataFrame([(digest, bytearray(raw), width, end_id)], "dictionary_hash string, dictionary binary, width int, end_id int")
    about.coalesce(1).write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(raw)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"shard int, block int, first_doc {id_type}, last_doc {id_type}, doc_ids array<{id_type}>, starts array<bigint>, "
        "n_ids array<bigint>, offsets array<bigint>, frames binary, dictionary_hash string"
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value), write_content_size=True)
        doc_ids, sizes, frames, start, block = [], [], [], 0, 0

        def row():
            ends = np.cumsum([0, *sizes]) + start
            known = [i for i in doc_ids if i is not None] or [None]
            lengths = np.cumsum([0, *map(len, frames)])
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "shard": shard,
                        "block": block,
                        "first_doc": known[0],
                        "last_doc": known[-1],
                        "doc_ids": doc_ids,
                        "starts": ends[:-1].tolist(),
                        "n_ids": sizes,
                        "offsets": lengths.tolist(),
                        "frames": b"".join(frames),
                        "dictionary_hash": digest,
                    }
                ],
                schema=pa.schema(
                    [
                        ("shard", pa.int32()),
                        ("block", pa.int32()),
                        ("first_doc", batch.column(0).type),
                        ("last_doc", batch.column(0).type),
                        ("doc_ids", pa.list_(batch.column(0).type)),
                        ("starts", pa.list_(pa.int64())),
                        ("n_ids", pa.list_(pa.int64())),
                        ("offsets", pa.list_(pa.int64())),
                        ("frames", pa.binary()),
                        ("dictionary_hash", pa.string()),
                    ]
                ),
            )

        held = 0
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for first, data, offsets in arrays.blocks(arrays.column(batch, "text")):
                ids, at = encode(tokenizer_path, data, offsets, end_id)
                ids = ids.astype(f"<u{width}")
                for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                    doc_ids.append(keys[first + i])
                    sizes.append(b - a)
                    frames.append(pack.compress(ids[a:b].tobytes()))
                    held += len(frames[-1])
                    if len(frames) >= BLOCK_DOCS or held >= BLOCK_BYTES:
                        yield row()
                        start, block = start + sum(sizes), block + 1
                        doc_ids, sizes, frames, held = [], [], [], 0
        if frames:
            yield row()

    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(packed, schema).write.parquet(f"{folder}/shards")


def read(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_ids, ids): the documents of a folder, or those of some ids; start is the number of ids
    before the document, ids are little-endian unsigned 32-bit integers."""
    about = spark.read.parquet(f"{folder}/dictionary").first()
    raw, width = bytes(about.dictionary), about.width
    if hashlib.sha256(raw).hexdigest() != about.dictionary_hash:
        raise ValueError("the dictionary is damaged")
    shards = spark.read.parquet(f"{folder}/shards")
    ends = shards.select("shard", (F.element_at("starts", -1) + F.element_at("n_ids", -1)).alias("end"))
    totals = {r.shard: r.end for r in ends.groupBy("shard").agg(F.max("end").alias("end")).collect()}
    before = np.zeros(max(totals, default=0) + 2, np.int64)
    for shard, n in totals.items():
        before[shard + 1] = n
    before = np.cumsum(before)
    if doc_ids is not None:
        wanted = F.lit([int(i) for i in doc_ids])
        shards = shards.filter((F.col("first_doc") <= max(doc_ids)) & (F.col("last_doc") >= min(doc_ids)))
        shards = shards.filter(F.arrays_overlap("doc_ids", wanted))
    shared = spark.sparkContext.broadcast((raw, about.dictionary_hash, before, set(doc_ids) if doc_ids is not None else None))
    id_type = shards.schema["first_doc"].dataType.simpleString()

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, digest, before, only = shared.value
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
        for batch in batches:
            kind = batch.column("first_doc").type
            for k in range(batch.num_rows):
                get = lambda name: batch.column(name)[k]  # noqa: B023, E731
                if get("dictionary_hash").as_py() != digest:
                    raise ValueError("a block was written with another dictionary")
                frames = get("frames").as_buffer()
                keys, starts, sizes, at = (get(c).as_py() for c in ("doc_ids", "starts", "n_ids", "offsets"))
                shift = int(before[get("shard").as_py()])
                chosen = [i for i, d in enumerate(keys) if only is None or d in only]
                for a in range(0, len(chosen), 100):
                    some = chosen[a : a + 100]
                    ids = [
                        np.frombuffer(unpack.decompress(frames[at[i] : at[i + 1]]), f"<u{width}").astype("<u4").tobytes() for i in some
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([keys[i] for i in some], kind),
                            pa.array([starts[i] + shift for i in some], pa.int64()),
                            pa.array([sizes[i] for i in some], pa.int64()),
                            pa.array(ids, pa.binary()),
                        ],
                        names=["doc_id", "start", "n_ids", "ids"],
                    )

    columns = ("shard", "first_doc", "doc_ids", "starts", "n_ids", "offsets", "frames", "dictionary_hash")
    return shards.select(*columns).mapInArrow(unpacked, f"doc_id {id_type}, start bigint, n_ids bigint, ids binary")


def written(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> str:
    """Write to a new folder below the shared folder; its path."""
    folder = fresh_path(docs.sparkSession, "token-files")
    write(docs, folder, tokenizer_path, end_id)
    return folder
