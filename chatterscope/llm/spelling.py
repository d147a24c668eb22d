"""Groups of spelling variants: words of a vocabulary that one edit (a letter more, less or other) sets apart.

1. Words are counted over all texts: maximal runs of letters, added up in the tasks and then by word.
2. Near words are found block by block.  One edit of a word of m letters leaves the first or the last half of
   it as it is, so near words (of m and of m or m + 1 letters) meet in a block of equal m and equal half.
   A block of more than BLOCK words is split again in the same way: the part that may differ is
   halved, and words meet in a block of equal m, equal rest and one equal quarter; and so on, until blocks are
   small or a single letter may differ (then the alphabet bounds them).  So no link is lost and no block
   grows with the vocabulary, however many words share a beginning or an end.
3. Within a block the sorted words are scanned once with the rows of the edit matrix, cut to the three
   diagonals that one edit can reach, of all words of the block against the prefix at hand.  The next
   word goes on from the row of the longest prefix it shares with the word before, and each row keeps
   only the words that are still within one edit.  If only the prefix's own word is left, the words that
   share the prefix are skipped.
4. A word's form is its most frequent near word, if that is RATIO times as frequent as the word itself.  Roots
   are found by pointer jumping along forms; as frequency grows at each step, there are no circles.

Defined results: null and empty texts have no words.  A null doc_id counts as an empty one when letters are deleted.
Ties between near words go to the smaller in code-point order.  Rows that repeat count as often as they
stand there.  An empty table has no words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope.llm import arrays
from chatterscope.session import cut_lineage

LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
SLIP = 199
BLOCK = 2_000
#: Distinct words that a task holds before it passes their counts on.
HELD = 400_000
_FAR = 2
_LONG = 64


def _table() -> np.ndarray:
    """The 256 steps of the CRC by bytes."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = (steps >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (steps & np.uint32(1)))
    return steps


_STEPS = _table()


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to the letters A-Z, a-z and U+00C0 to U+00FF."""
    low = data | 0x20
    two = data == 0xC3  # leads exactly U+00C0 to U+00FF
    found = ((low >= 97) & (low <= 122) & (data < 128)) | two
    found[1:] |= two[:-1]
    return found


def crcs(prefixes: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of prefix + data[start:start + size], given the CRC of every prefix."""
    out = prefixes ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes, state = starts[order], sizes[order], out[order]
    short = int(np.searchsorted(-sizes, -_LONG))
    for i in range(short):  # long runs one by one
        whole = zlib.crc32(data[starts[i] : starts[i] + sizes[i]].tobytes(), int(state[i] ^ np.uint32(0xFFFFFFFF)))
        state[i] = np.uint32(whole) ^ np.uint32(0xFFFFFFFF)
    for k in range(int(sizes[short]) if short < len(sizes) else 0):
        end = int(np.searchsorted(-sizes, -k, "left"))
        part = state[short:end]
        state[short:end] = _STEPS[(part ^ data[starts[short:end] + k]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _block_words(ids: list[str], data: np.ndarray, offsets: np.ndarray, slip: int) -> pa.Array:
    """All words of LEAST_LETTERS letters or more, as counted."""
    mask = letters(data)
    # a run ends with its text
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begin = mask.copy()
    begin[1:] &= ~mask[:-1] | first[1:-1]
    end = mask.copy()
    end[:-1] &= ~mask[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    lowered = arrays.LOWER[data]
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    long_ = points[ends] - points[starts] >= LEAST_LETTERS
    starts, ends = starts[long_], ends[long_]
    sizes = ends - starts
    slipped: list[str] = []
    if slip and len(starts):
        prefixes = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
        text = np.searchsorted(offsets, starts, "right") - 1
        h = crcs(prefixes[text], lowered, starts, sizes)
        hit = np.flatnonzero(h % np.uint32(slip) == 0)
        for i in hit.tolist():
            word = lowered[starts[i] : ends[i]].tobytes().decode()
            at = int(h[i]) % len(word)
            if len(word) > LEAST_LETTERS:
                slipped.append(word[:at] + word[at + 1 :])
        kept = np.ones(len(starts), bool)
        kept[hit] = False
        starts, ends, sizes = starts[kept], ends[kept], sizes[kept]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    taken = np.zeros(len(data) + 1, np.int8)
    np.add.at(taken, starts, 1)
    np.add.at(taken, ends, -1)
    joined = lowered[np.cumsum(taken[:-1]) > 0]
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(joined)])
    return pa.concat_arrays([words, pa.array(slipped, pa.large_string())])


def count_words(docs: DataFrame, slip: int = 0, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words in texts (doc_id, text) that occur at least so often.

    With `slip`, a run loses a letter where the CRC-32 of "doc_id:run" is a multiple of it, a stand-in for
    misprints: the letter whose place is the CRC modulo the run's length.
    """

    def summed(parts: list[pa.Table]) -> pa.Table:
        both = pa.concat_tables(parts).combine_chunks()
        return both.group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        for batch in batches:
            for row, data, offsets in arrays.blocks(arrays.column(batch, "text")):
                ids = batch.column("id").slice(row, len(offsets) - 1).to_pylist()
                found = _block_words(ids, data, offsets, slip).value_counts()
                parts.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
                if sum(map(len, parts)) > HELD:
                    parts = [summed(parts)]
                    if len(parts[0]) > HELD / 2:
                        yield from out(parts.pop())
        if parts:
            yield from out(summed(parts))

    def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from table.cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(max_chunksize=10_000)

    own = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counts = own.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least)


def near_in_block(words: list[str]) -> list[tuple[int, int]]:
    """All pairs (i, j), in both orders, of distinct sorted words that one edit sets apart."""
    sizes = np.array([len(w) for w in words])
    # code points, with one place before and two after that equal no letter
    points = np.full((len(words), int(sizes.max()) + 3), -1, np.int32)
    for i, w in enumerate(words):
        points[i, 1 : 1 + len(w)] = np.frombuffer(w.encode("utf-32-le"), np.uint32)
    # for every length of the prefix: the words within one edit of it, and their row on three diagonals,
    # where the word's prefix is one shorter, as long, and one longer
    rows = [(np.arange(len(words), dtype=np.int32), np.tile(np.array([_FAR, 0, 1], np.int8), (len(words), 1)))]
    pairs: list[tuple[int, int]] = []
    last, i = "", 0
    while i < len(words):
        w = words[i]
        shared, most = 0, min(len(w), len(last), len(rows) - 1)
        while shared < most and w[shared] == last[shared]:
            shared += 1
        del rows[shared + 1 :]
        for depth in range(shared + 1, len(w) + 1):
            alive, old = rows[-1]
            row = old + (points[alive, depth - 1 : depth + 2] != ord(w[depth - 1]))
            row[:, :2] = np.minimum(row[:, :2], old[:, 1:] + 1)
            row[:, 1] = np.minimum(row[:, 1], row[:, 0] + 1)
            row[:, 2] = np.minimum(row[:, 2], row[:, 1] + 1)
            near = row.min(axis=1) < _FAR
            rows.append((alive[near], np.minimum(row[near], _FAR)))
            if len(rows[-1][0]) == 1:  # the word itself
                break
        last = w
        alive, row = rows[-1]
        if len(alive) == 1:
            prefix, i = w[: len(rows) - 1], i + 1
            while i < len(words) and words[i].startswith(prefix):
                i += 1
            continue
        gap = sizes[alive] - len(w)
        for k in np.flatnonzero(np.abs(gap) <= 1).tolist():
            if alive[k] != i and row[k, gap[k] + 1] < _FAR:
                pairs.append((i, int(alive[k])))
        i += 1
    return pairs


def _split(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, a, b) with the part [a, b) of m letters that may differ halved, and the block they
    meet in: the same m, part, and letters before and after it."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    halves = F.explode(F.array(F.struct("a", middle.alias("b")), F.struct(middle.alias("a"), "b"))).alias("w")
    halved = rows.select("word", "n", "m", halves).select("word", "n", "m", "w.*")
    rest = F.left("word", F.col("a")), F.right("word", F.col("m") - F.col("b"))
    return halved.withColumn("block", F.xxhash64("m", "a", "b", *rest))


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n) of all near words of a vocabulary (word, n), each once."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, str, int]] = []
            ends = batch.column("ends").to_pylist()
            for k, members in enumerate(batch.column("members")):
                n = dict(zip(members.values.field("word").to_pylist(), members.values.field("n").to_pylist(), strict=True))
                # letters that all share come first
                turned = {w[::-1]: w for w in n} if ends[k] else {w: w for w in n}
                words = sorted(turned)
                for i, j in near_in_block(words):
                    near = turned[words[j]]
                    out.append((turned[words[i]], near, n[near]))
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["word", "near", "near_n"])

    size = F.length("word")
    lengths = F.when(size > 1, F.array(size - 1, size)).otherwise(F.array(size))
    rows = vocabulary.select("word", "n", F.explode(lengths).alias("m"))
    rows = rows.select("word", "n", "m", F.lit(0).alias("a"), F.col("m").alias("b"))
    found = []
    while True:
        rows = cut_lineage(_split(rows))
        sizes = rows.groupBy("block", "a", "b").agg(F.count("*").alias("words"))
        large = cut_lineage(sizes.filter((F.col("words") > block) & (F.col("b") - F.col("a") > 1)).select("block"))
        gathered = rows.join(large, "block", "left_anti").groupBy("block").agg(
            F.collect_list(F.struct("word", "n")).alias("members"), F.min(F.col("a") == 0).alias("ends")
        )
        gathered = gathered.filter(F.size("members") > 1).select("members", "ends")
        found.append(cut_lineage(gathered.mapInArrow(scanned, "word string, near string, near_n bigint")))
        if not large.limit(1).count():
            break
        rows = rows.join(large, "block", "left_semi").drop("block")
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    return every.groupBy("word", "near").agg(F.first("near_n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms (word, form) from every word."""
    ways = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = cut_lineage(ways.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not ways.filter("moved").limit(1).count():
            return ways.select("word", "root")
        ways = ways.drop("moved")


def variants(docs: DataFrame, slip: int = 0, least: int = LEAST_COUNT, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of all words of texts (doc_id, text)."""
    vocabulary = cut_lineage(count_words(docs, slip, least))
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best")
    near = near_words(vocabulary, block).groupBy("word").agg(F.count("*").alias("n_near"), best)
    frequent = -F.col("best.rank") >= ratio * F.col("n")
    found = vocabulary.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.rank")).alias("form_n"),
    )
    found = cut_lineage(found)
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
