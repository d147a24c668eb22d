"""Near-duplicate classes by consistent weighted sampling over TF-IDF shingles.

1. Documents with the same list of words (A-Z lower-cased) are copies: the first of them, by (doc_id, row),
   stands for all in what follows.
2. Shingles are runs of five words (a shorter text is one shingle).  A shingle weighs its number of
   occurrences in the text times its inverse document frequency, scaled to lie between IDF_FLOOR for a
   shingle that all documents hold and 1 for a rare one.  Frequencies are counted over all documents
   into 2^SLOT_BITS slots by hash.  The slots' number is fixed, so sharing a slot blurs a frequency by a
   fixed share of the documents, whatever their number.
3. Improved consistent weighted sampling draws BANDS * ROWS samples (shingle, quantized weight) of each
   text; two texts draw the same sample with a probability equal to their weighted Jaccard similarity.
   ROWS samples make the key of a band.
4. Texts with equal keys are candidates.  First, in each band and key, all texts are compared with one of
   them (STARS times, with another one each time), which joins most near copies at a comparison per text.
   Then the texts of a key that still lie in different classes are dealt to blocks, and each two blocks
   are compared in one task: pairs whose samples agree in less than LEAST_AGREEMENT of the places (a
   pair of similarity 0.8 does with a probability of 10^-7) are left out, pairs that links found there
   already join are skipped, and the others are compared exactly.  What leaves the task are links that
   join something, fewer than texts in the two blocks, so a group of texts that are similar but not
   similar enough is no more rows than others.  No link that would join two classes is lost.
5. A pair is a link if its exact weighted Jaccard similarity is SIMILARITY or more.  Classes are the
   connected components, labelled in joins with pointer jumping over the links between classes found so
   far; the class id is the smallest doc_id.

Defined results: a text without words (null, empty) is a class of its own.  Rows equal in doc_id and text
are copies of one document.  Of rows with equal doc_id the smaller hash of the text is first; a null
doc_id comes first of all and then names the class.  All columns of the input are kept apart; the
result has a row for every row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope.llm import arrays
from chatterscope.session import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 14, 4
SLOT_BITS = 20
IDF_FLOOR = 0.75
STARS = 1
LEAST_AGREEMENT = 0.5
#: Texts, and bytes of text, of a block; a longer text is a block of its own.
BLOCK, BLOCK_BYTES = 128, 1 << 20
_SLOTS = 1 << SLOT_BITS
_PART = 1 << 12  # slots in a row of the table of frequencies
_DRAWS = 1 << 16


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text in order of hash, their numbers, and the texts' offsets."""
    words, at = arrays.word_hashes(data, offsets)
    runs, at = arrays.run_hashes(words, at, SHINGLE)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((runs, text))
    runs = runs[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return runs[first], np.diff(np.append(first, len(runs))), np.searchsorted(first, at)


def slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(part, counts): the number of documents of each slot's shingles, _PART slots in a row."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SLOTS, np.int32)
        for batch in batches:
            for _, data, offsets in arrays.blocks(arrays.column(batch, text)):
                total += np.bincount(slot(shingles(data, offsets)[0]), minlength=_SLOTS).astype(np.int32)
        used = total.reshape(-1, _PART).any(axis=1).nonzero()[0]
        rows = [total[p * _PART : (p + 1) * _PART].tobytes() for p in used.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(rows, pa.binary())], names=["part", "counts"])

    def summed(key, rows):
        total = np.zeros(_PART, np.int64)
        for counts in rows.column("counts"):
            total += np.frombuffer(counts.as_buffer(), np.int32)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "counts": [total.tobytes()]})

    parts = docs.select(text).mapInArrow(counted, "part int, counts binary")
    return parts.groupBy("part").applyInArrow(summed, "part int, counts binary")


def idf(docs: DataFrame) -> np.ndarray:
    """The weight of every slot's shingles: at most _SLOTS numbers, whatever the input."""
    counts = np.zeros(_SLOTS, np.int64)
    for row in document_frequencies(docs).toLocalIterator():
        counts[row.part * _PART : (row.part + 1) * _PART] = np.frombuffer(row.counts, np.int64)
    usual = max(1.0, counts.mean())  # what chance puts into a slot
    most = max(docs.count(), 2 * usual)
    share = np.log(np.clip(counts, usual, most) / usual) / np.log(most / usual)
    return (1 - (1 - IDF_FLOOR) * share).astype(np.float32)


def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fixed draws that a hash chooses from: r and ln c of Gamma(2, 1), beta of uniform numbers."""
    rng = np.random.default_rng(20170)
    u = (np.arange(_DRAWS) + 0.5) / _DRAWS
    grid = np.linspace(0, 40, 400_001)
    gamma = np.interp(u, 1 - (1 + grid) * np.exp(-grid), grid)
    return gamma[rng.permutation(_DRAWS)].astype(np.float32), np.log(gamma).astype(np.float32), u.astype(np.float32)


def samples(h: np.ndarray, weights: np.ndarray, at: np.ndarray, n: int, draws) -> np.ndarray:
    """n samples (64-bit hashes) of every text that has shingles, by consistent weighted sampling."""
    gamma, log_gamma, uniform = draws
    out = np.zeros((len(at) - 1, n), np.uint64)
    full = np.flatnonzero(np.diff(at) > 0)
    if not len(full):
        return out
    logs = np.log(weights)
    begin = at[:-1][full]
    piece = np.cumsum(np.bincount(begin, minlength=len(h))) - 1
    for k in range(n):
        seed = arrays.mix(h, k + 1)
        r = gamma[seed & np.uint64(0xFFFF)]
        beta = uniform[(seed >> np.uint64(16)) & np.uint64(0xFFFF)]
        t = np.floor(logs / r + beta)
        a = log_gamma[(seed >> np.uint64(32)) & np.uint64(0xFFFF)] - r * (t - beta + 1)
        # ties of a go by the upper bits of the seed
        least = np.minimum.reduceat(a, begin)
        hit = np.flatnonzero(a == least[piece])
        drawn = arrays.mix(seed[hit] ^ t[hit].astype(np.int64).view(np.uint64), 77)
        out[full, k] = np.minimum.reduceat(drawn, np.searchsorted(hit, begin))
    return out


def signatures(docs: DataFrame, idf_of, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, key, h1, h2, sample, bands) of rows (doc_id, key, text): two hashes of the list of words
    (a text without words has its key instead, and no bands), 16 bits of all samples, and the hash of
    each band's samples."""

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight_of, draws = idf_of.value, _draws()
        for batch in batches:
            for row, data, offsets in arrays.blocks(arrays.column(batch, "text"), 1 << 20):
                n = len(offsets) - 1
                part = batch.slice(row, n)
                words, at = arrays.word_hashes(data, offsets)
                full = np.diff(at) > 0
                own = part.column("key").to_numpy()
                same = [arrays.span_hashes(w, at[:-1], at[1:]) for w in (words, arrays.mix(words, 5))]
                h, count, at = shingles(data, offsets)
                s = samples(h, count.astype(np.float32) * weight_of[slot(h)], at, bands * rows, draws)
                keys = np.zeros((n, bands), np.uint64)
                for k in range(rows):
                    keys = arrays.mix(keys * np.uint64(31) + s[:, k::rows], k)
                ends = np.concatenate(([0], np.cumsum(full * bands)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("key"),
                        *(pa.array(np.where(full, x.view(np.int64), own)) for x in same),
                        pa.array([x.tobytes() for x in (s >> np.uint64(48)).astype(np.uint16)], pa.binary()),
                        arrays.list_array(keys[full].view(np.int64).ravel(), ends, pa.int64()),
                    ],
                    names=["doc_id", "key", "h1", "h2", "sample", "bands"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "key", "text").mapInArrow(
        drawn, f"doc_id {id_type}, key bigint, h1 bigint, h2 bigint, sample binary, bands array<bigint>"
    )


def _agreement(a: list, b: list) -> np.ndarray:
    """The share of samples in which every row of a agrees with every row of b."""
    x, y = (np.frombuffer(b"".join(part), np.uint16).reshape(len(part), -1) for part in (a, b))
    same = np.zeros((len(x), len(y)), np.int32)
    for k in range(x.shape[1]):
        same += x[:, k, None] == y[None, :, k]
    return same / x.shape[1]


def agreeing(pairs: DataFrame, least: float = LEAST_AGREEMENT) -> DataFrame:
    """Pairs (a, b, sample_a, sample_b) that agree in at least such a share of their samples."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                    for c in ("sample_a", "sample_b")
                )
                yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    return pairs.select("a", "b", "sample_a", "sample_b").mapInArrow(compared, "a bigint, b bigint")


def _weighed(texts: pa.Array, weight_of: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shingles in order and their weights, of every text."""
    out = []
    for _, data, offsets in arrays.blocks(texts):
        h, count, at = shingles(data, offsets)
        w = count * weight_of[slot(h)].astype(np.float64)
        out += [(h[a:b], w[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return out


def _similar(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], similarity: float) -> bool:
    """Whether the weighted Jaccard similarity of two texts is enough."""
    (hx, wx), (hy, wy) = x, y
    both = wx.sum() + wy.sum()
    if not len(hx) or not len(hy) or (1 + similarity) * min(wx.sum(), wy.sum()) < (similarity - 1e-9) * both:
        return False
    at = np.minimum(np.searchsorted(hx, hy), len(hx) - 1)
    hit = hx[at] == hy
    common = np.minimum(wx[at[hit]], wy[hit]).sum()
    return bool(common >= (similarity - 1e-9) * (both - common))


def across(members: DataFrame, idf_of, similarity: float = SIMILARITY, least: float = LEAST_AGREEMENT) -> DataFrame:
    """Links (a, b) between members (band, hash, key, label, sample, bands, text) of one band and key that have
    different labels: of each two blocks of members as many as join all that is similar there."""
    size = F.greatest(F.count("*") / BLOCK, F.sum(F.octet_length("text")) / BLOCK_BYTES)
    sizes = members.groupBy("band", "hash").agg(F.greatest(F.ceil(size), F.lit(1)).cast("int").alias("n_blocks"))
    dealt = members.join(sizes, ["band", "hash"]).withColumn("block", F.pmod(F.xxhash64("key"), "n_blocks").cast("int"))
    blocks = dealt.groupBy("band", "hash", "n_blocks", "block").agg(
        F.collect_list(F.struct("key", "label", "sample", "bands", "text")).alias("rows")
    )
    # each row goes to the pairs of its block with itself and with later and earlier ones
    sides = blocks.select(
        "band", "hash", "block", "rows", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    ).select("band", "hash", "rows", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    left = sides.filter("block = low").select("band", "hash", "low", "high", F.col("rows").alias("x"))
    right = sides.filter("block = high").select("band", "hash", "low", "high", F.col("rows").alias("y"))

    def linked(band: int, x: pa.Array, y: pa.Array, weight_of: np.ndarray) -> pa.RecordBatch:
        agreement = _agreement(x.field("sample").to_pylist(), y.field("sample").to_pylist())
        i, j = np.nonzero(agreement >= least)
        keys = [side.field("key").to_numpy() for side in (x, y)]
        labels = [side.field("label").to_numpy() for side in (x, y)]
        hashes = [side.field("bands").flatten().to_numpy().reshape(len(side), -1) for side in (x, y)]
        # each pair in its first common band
        first = (hashes[0][i] == hashes[1][j]).argmax(axis=1) == band
        take = first & (labels[0][i] != labels[1][j])
        i, j = i[take], j[take]
        order = np.argsort(-agreement[i, j], kind="stable")
        used = np.unique(i), np.unique(j)
        weighed = [
            dict(zip(at.tolist(), _weighed(side.field("text").take(pa.array(at)).cast(pa.large_string()), weight_of), strict=True))
            for at, side in zip(used, (x, y), strict=True)
        ]
        parent: dict[int, int] = {}

        def root(label: int) -> int:
            while (up := parent.get(label, label)) != label:
                parent[label] = parent.get(up, up)
                label = up
            return label

        links = []
        for p, q in zip(i[order].tolist(), j[order].tolist(), strict=True):
            a, b = root(int(labels[0][p])), root(int(labels[1][q]))
            if a != b and _similar(weighed[0][p], weighed[1][q], similarity):
                parent[max(a, b)] = min(a, b)
                links.append((int(keys[0][p]), int(keys[1][q])))
        columns = zip(*links, strict=True) if links else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column("band").to_pylist()
            for k, band in enumerate(bands):
                yield linked(band, batch.column("x")[k].values, batch.column("y")[k].values, idf_of.value)

    joined = left.join(right, ["band", "hash", "low", "high"])
    return joined.select("band", "x", "y").mapInArrow(compared, "a bigint, b bigint")


def verified(pairs: DataFrame, texts: DataFrame, idf_of, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) of texts (key, text) whose exact weighted Jaccard similarity is enough."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight_of = idf_of.value
        for batch in batches:
            n = batch.num_rows
            both = pa.chunked_array([arrays.column(batch, "text_a"), arrays.column(batch, "text_b")]).combine_chunks()
            parts = _weighed(both, weight_of)
            keep = [_similar(parts[i], parts[n + i], similarity) for i in range(n)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda c: texts.select(F.col("key").alias(c), F.col("text").alias(f"text_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(compared, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(key, label): the smallest key of the connected component, for every key in links (a, b)."""
    edges = links.select(F.col("a").alias("key"), F.col("b").alias("other"))
    edges = cut_lineage(edges.union(edges.select("other", "key")).distinct())
    labels = cut_lineage(edges.groupBy("key").agg(F.least("key", F.min("other")).alias("label")))
    while True:
        far = labels.select(F.col("key").alias("other"), F.col("label").alias("theirs"))
        near = edges.join(far, "other").groupBy("key").agg(F.min("theirs").alias("theirs"))
        new = labels.join(near, "key").select("key", "label", F.least("label", "theirs").alias("next"))
        # the label's own label
        jump = labels.select(F.col("key").alias("next"), F.col("label").alias("root"))
        new = new.join(jump, "next", "left").select("key", "label", F.least("next", F.coalesce("root", "next")).alias("next"))
        new = cut_lineage(new)
        moved = new.filter("label <> next").limit(1).count()
        labels = new.select("key", F.col("next").alias("label"))
        if not moved:
            return labels


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(key, label) after more links; only links between different labels are followed."""
    if labels is None:
        return cut_lineage(components(links))
    for end in ("a", "b"):
        own = labels.select(F.col("key").alias(end), F.col("label").alias(f"{end}_label"))
        links = links.join(own, end, "left").withColumn(end, F.coalesce(f"{end}_label", end)).drop(f"{end}_label")
    more = cut_lineage(components(cut_lineage(links.filter("a <> b").distinct())))
    onward = more.select(F.col("key").alias("label"), F.col("label").alias("next"))
    old = labels.join(onward, "label", "left").select("key", F.coalesce("next", "label").alias("label"))
    new = more.join(labels.select("key"), "key", "left_anti").select("key", "label")
    return cut_lineage(old.unionByName(new))


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, stars: int = STARS) -> DataFrame:
    """(doc_id, key, class_id, class_key, n_copies): the class of every row, and the number of rows with the same
    words.

    key is the hash of doc_id and text, class_key that of the first row of the class.
    """
    spark = docs.sparkSession
    key = F.xxhash64("doc_id", "text").alias("key")
    idf_of = spark.sparkContext.broadcast(idf(docs.select("text")))
    named = docs.select("doc_id", key, "text")
    content = cut_lineage(signatures(named, idf_of, bands, rows))
    firsts = cut_lineage(
        content.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "key")).alias("first"), F.count("*").alias("n_copies"))
        .select("h1", "h2", F.col("first.doc_id").alias("doc_id"), F.col("first.key").alias("key"), "n_copies")
    )
    leaders = content.join(firsts.select("key"), "key", "left_semi").dropDuplicates(["key"])
    signed = cut_lineage(leaders.select("key", "sample", "bands"))
    banded = signed.select("key", F.posexplode("bands").alias("band", "hash"))
    crowded = banded.groupBy("band", "hash").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    members = cut_lineage(banded.join(crowded, ["band", "hash"]).select("band", "hash", "key"))
    texts = named.join(members.select("key").distinct(), "key", "left_semi")
    texts = cut_lineage(texts.dropDuplicates(["key"]).select("key", "text"))
    samples_of = lambda c: signed.select(F.col("key").alias(c), F.col("sample").alias(f"sample_{c}"))

    labels = None
    for turn in range(stars + 1):
        own = members if labels is None else members.join(labels, "key", "left")
        own = own.withColumn("label", F.col("key") if labels is None else F.coalesce("label", "key"))
        own = own if labels is None else cut_lineage(own)
        groups = own.groupBy("band", "hash").agg(
            F.min_by(F.struct("key", "label"), F.xxhash64("key", F.lit(turn))).alias("centre"),
            (F.min("label") < F.max("label")).alias("open"),
        )
        groups = groups.filter("open").drop("open")
        if turn < stars:
            pairs = own.join(groups, ["band", "hash"]).filter("label <> centre.label")
            pairs = pairs.select(F.least("key", "centre.key").alias("a"), F.greatest("key", "centre.key").alias("b"))
            pairs = pairs.distinct().join(samples_of("a"), "a").join(samples_of("b"), "b")
            found = cut_lineage(verified(cut_lineage(agreeing(pairs)), texts, idf_of, similarity))
        else:
            open_ = own.join(groups, ["band", "hash"], "left_semi")
            found = cut_lineage(across(open_.join(signed, "key").join(texts, "key"), idf_of, similarity))
        if found.limit(1).count():
            labels = merged(labels, found)
    if labels is None:
        found = firsts.select("h1", "h2", F.col("doc_id").alias("class_id"), F.col("key").alias("class_key"), "n_copies")
    else:
        labelled = firsts.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
        names = labelled.groupBy("label").agg(F.min(F.struct("doc_id", "key")).alias("name"))
        found = labelled.join(names, "label").select(
            "h1", "h2", F.col("name.doc_id").alias("class_id"), F.col("name.key").alias("class_key"), "n_copies"
        )
    return content.select("doc_id", "key", "h1", "h2").join(found, ["h1", "h2"]).drop("h1", "h2")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of docs, with all its columns, for every class: the first by (doc_id, row)."""
    first = classes(docs, **options).select(F.col("class_key").alias("__key")).distinct()
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    return keyed.join(first, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
