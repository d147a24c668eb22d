"""A convolutional text classifier for toxicity, trained in numpy.

A word (ASCII letters and digits and all other characters, A-Z lower-cased) is looked up by two hashes in
two tables of embeddings, so that two words are taken for each other only if both hashes meet.  Filters
over one, two and three words, the largest value of each over the whole text, and a logistic unit give
a score; a calibration on rows not used for fitting turns it into a probability.  Embeddings start
from the log-odds of their words and are trained with the filters.

The classifier is fitted on all labelled rows, in parts of SHARD_ROWS or so, each in one task.  In each of the
EPOCHS rounds every part trains a copy of the classifier on its rows, and the changes are averaged by Spark, by
slot over the parts that changed it.  Only sums by slot, of fixed number, reach the driver.  Changes are summed as
whole numbers, so that the order of tasks does not matter.  Every fifth row by a hash of doc_id serves for
calibration only: of the score, and of one threshold for each language with enough rows of both labels
there (the others share one); its logits are counted in steps of 1 / STEPS.  Language, source, id and labels are
no inputs of a score.  Scoring maps over all texts, without a shuffle.

Defined results: null and empty texts get the score of a text without any word.  Several labels of one doc_id
count as toxic if one is.  Rows without doc_id are scored, never learned from.  Without labels of
both kinds every score is the share of toxic rows (0 without labels).  All columns of the input
stay; `score` (and `rejected`) replace columns of these names.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterscope.llm import arrays
from chatterscope.operators import ngrams
from chatterscope.session import cut_lineage

#: Labelled rows that one task trains on, and the steps of a change and of a logit that are told apart.
SHARD_ROWS, UNITS, STEPS = 16_000, 1 << 24, 1000
CALIBRATION = 5
BITS, DIMS, FILTERS, WIDTHS = 18, 4, 8, (1, 2, 3)
EPOCHS, BATCH, RATE = 4, 64, 0.05
THRESHOLD = 0.7
#: Rows of each label that a language needs in the calibration part for a threshold of its own.
LEAST_ROWS = 15
#: Rows without value after the words of a text: a window begins at a word, or at the first of these.
_PAD = max(WIDTHS)


def fold(doc_id: Column, n: int) -> Column:
    """The remainder of the CRC of the id as text."""
    return F.crc32(doc_id.cast("string")) % n


def slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two table rows for every word, and the texts' offsets in the words."""
    h, at = arrays.word_hashes(data, offsets, arrays.NOT_WORD)
    return np.stack([h >> np.uint64(64 - BITS), (h >> np.uint64(8)) & np.uint64((1 << BITS) - 1)]).astype(np.int32), at


@dataclass
class Classifier:
    tables: np.ndarray  # 2 x slots x DIMS
    filters: list[np.ndarray]  # width x 2 DIMS x FILTERS
    bias: np.ndarray  # widths x FILTERS
    out: np.ndarray  # widths x FILTERS
    base: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = THRESHOLD
    thresholds: dict[str, float] = field(default_factory=dict)

    def forward(self, index: np.ndarray, at: np.ndarray):
        """Logits of the texts; also embeddings, pooled values and their places, for training."""
        sizes = np.diff(at)
        n = len(sizes)
        # words of a text, then padding of no value
        room = sizes + _PAD
        begin = np.concatenate(([0], np.cumsum(room)))
        place = np.arange(at[-1]) + np.repeat(begin[:-1] - at[:-1], sizes)
        x = np.zeros((begin[-1] + _PAD, 2 * DIMS), np.float32)
        x[place, :DIMS] = self.tables[0][index[0]]
        x[place, DIMS:] = self.tables[1][index[1]]
        pooled = np.zeros((len(WIDTHS), n, FILTERS), np.float32)
        outside = np.ones(begin[-1], bool)
        outside[place] = False
        outside[begin[:-1]] = False
        values = []
        for k, width in enumerate(WIDTHS):
            z = x[: begin[-1]] @ self.filters[k][0]
            for j in range(1, width):
                z += x[j : begin[-1] + j] @ self.filters[k][j]
            z += self.bias[k]
            z[outside] = -np.inf
            values.append(z)
            pooled[k] = np.maximum.reduceat(z, begin[:-1], axis=0) if n else 0
        logits = np.einsum("wnf,wf->n", np.maximum(pooled, 0), self.out) + self.base
        return logits, x, begin, values, pooled

    def score(self, index: np.ndarray, at: np.ndarray) -> np.ndarray:
        z = self.slope * self.forward(index, at)[0].astype(np.float64) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _holding(index: np.ndarray, at: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """table x label x slot: the number of texts that hold a word of the slot."""
    seen = np.zeros((2, 2, 1 << BITS), np.int64)
    for first in range(0, len(toxic), 250):  # some texts at a time, for memory
        rows = np.arange(first, min(first + 250, len(toxic)))
        part, ends = _select(index, at, rows)
        text = np.repeat(np.arange(len(rows)), np.diff(ends))
        for k in range(2):
            pairs = np.unique(text << BITS | part[k])
            label = toxic[rows][pairs >> BITS].astype(np.int64)
            np.add.at(seen[k], (label, pairs & ((1 << BITS) - 1)), 1)
    return seen


def _select(index: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(at)[rows]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return index[:, np.arange(ends[-1]) + np.repeat(at[:-1][rows] - ends[:-1], sizes)], ends


def _step(model: Classifier, index: np.ndarray, at: np.ndarray, toxic: np.ndarray, memory: list) -> None:
    """One step of Adagrad on a few texts."""
    logits, x, begin, values, pooled = model.forward(index, at)
    error = (1 / (1 + np.exp(-logits)) - toxic).astype(np.float32) / len(toxic)
    padded = np.full((2, len(x)), -1, np.int64)
    place = np.arange(at[-1]) + np.repeat(begin[:-1] - at[:-1], np.diff(at))
    padded[:, place] = index
    seen_tables, seen_filters, seen_bias, seen_out = memory
    text = np.repeat(np.arange(len(toxic)), np.diff(begin))
    updates = []
    for k, width in enumerate(WIDTHS):
        top = values[k] == pooled[k][text]
        row, col = np.nonzero(top)
        arg = np.zeros((len(toxic), FILTERS), np.int64)
        arg[text[row], col] = row
        flow = error[:, None] * model.out[k] * (pooled[k] > 0)
        for j in range(width):
            near = x[arg + j]
            grad = np.einsum("nf,nfd->df", flow, near)
            seen_filters[k][j] += grad**2
            updates.append((arg + j, flow[:, :, None] * model.filters[k][j].T[None]))
            model.filters[k][j] -= RATE * 0.2 * grad / (np.sqrt(seen_filters[k][j]) + 1e-6)
        grad = flow.sum(axis=0)
        seen_bias[k] += grad**2
        model.bias[k] -= RATE * 0.2 * grad / (np.sqrt(seen_bias[k]) + 1e-6)
        grad = (error[:, None] * np.maximum(pooled[k], 0)).sum(axis=0)
        seen_out[k] += grad**2
        model.out[k] -= RATE * 0.2 * grad / (np.sqrt(seen_out[k]) + 1e-6)
    model.base -= RATE * float(error.sum())
    for where, grad in updates:
        for t in range(2):
            slot = padded[t][where].ravel()
            g = grad[:, :, t * DIMS : (t + 1) * DIMS].reshape(-1, DIMS)[slot >= 0]
            slot = slot[slot >= 0]
            np.add.at(seen_tables[t], slot, g**2)
            np.subtract.at(model.tables[t], slot, RATE * g / (np.sqrt(seen_tables[t][slot]) + 1e-6))


def _platt(logits: np.ndarray, toxic: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logits, each standing so many times, by logistic regression with softened labels."""
    n1, n0 = (times * toxic).sum(), (times * (1 - toxic)).sum()
    target = np.where(toxic > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    mean = np.average(logits, weights=times)
    scale = max(1e-6, np.average((logits - mean) ** 2, weights=times) ** 0.5)
    x = np.stack([logits / scale, np.ones(len(logits))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        hessian = (x * (times * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w -= np.clip(np.linalg.solve(hessian, x.T @ (times * (p - target)) + 1e-3 * w), -1, 1)
    return max(float(w[0] / scale), 1e-6), float(w[1])


def best_threshold(scores: np.ndarray, toxic: np.ndarray, times: np.ndarray) -> float:
    """The threshold of the best F1, in the middle of the gap it lies in; scores stand so many times each."""
    order = np.argsort(-scores, kind="stable")
    s, n = scores[order], times[order]
    t = toxic[order] * n
    hits = np.cumsum(t)
    f1 = 2 * hits / (np.cumsum(n) + t.sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(np.argmax(f1))
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0)) / 2)


def _beginning() -> tuple[Classifier, list]:
    """A classifier before training, and the sums of squares of its steps."""
    rng = np.random.default_rng(7)
    model = Classifier(
        rng.normal(0, 0.02, (2, 1 << BITS, DIMS)).astype(np.float32),
        [rng.normal(0, 0.2, (w, 2 * DIMS, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros((len(WIDTHS), FILTERS), np.float32),
        rng.normal(0, 0.2, (len(WIDTHS), FILTERS)).astype(np.float32),
        0.0,
    )
    memory = [np.full_like(model.tables, 0.01), [np.full_like(f, 0.01) for f in model.filters], np.full_like(model.bias, 0.01), np.full_like(model.out, 0.01)]
    return model, memory


def _dense(model: Classifier, memory: list) -> np.ndarray:
    """All numbers besides the tables."""
    parts = [*model.filters, model.bias, model.out, np.array([model.base]), *memory[1], memory[2], memory[3]]
    return np.concatenate([p.ravel() for p in parts]).astype(np.float64)


def _add_dense(model: Classifier, memory: list, change: np.ndarray) -> None:
    at = 0
    for part in [*model.filters, model.bias, model.out, None, *memory[1], memory[2], memory[3]]:
        if part is None:
            model.base += float(change[at])
            at += 1
            continue
        part += change[at : at + part.size].reshape(part.shape).astype(part.dtype)
        at += part.size


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of the words, offsets and labels of a batch."""
    lists = batch.column("words")
    at = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy()))).astype(np.int64)
    both = lists.flatten().to_numpy(zero_copy_only=False)
    index = np.empty((2, len(both)), np.int32)  # written in place, as copies of a large batch are what a task holds most
    np.right_shift(both, 32, out=index[0], casting="unsafe")
    np.bitwise_and(both, 0xFFFFFFFF, out=index[1], casting="unsafe")
    return index, at, batch.column("toxic").to_numpy().astype(np.float64)


_SUMS = ["place", "slot", "n", *(f"v{k}" for k in range(2 * DIMS))]


def _sums(place: int, slot: np.ndarray, n: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """Rows of _SUMS; values beyond those given are 0."""
    values = np.pad(values, ((0, 0), (0, 2 * DIMS - values.shape[1])))
    columns = [np.full(len(slot), place), slot, n, *values.T]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c, np.int64)) for c in columns], names=_SUMS)


def _summed(rows: DataFrame, task) -> pa.Table:
    """The rows that ``task`` makes of all parts, added up by place and slot: at most 2 tables and one row of numbers."""
    made = rows.mapInArrow(task, ", ".join(f"{c} bigint" for c in _SUMS))
    return made.groupBy("place", "slot").agg(*[F.sum(c).alias(c) for c in _SUMS[2:]]).toArrow()


def _values(sums: pa.Table) -> np.ndarray:
    return np.stack([sums.column(f"v{k}").to_numpy() for k in range(2 * DIMS)], axis=1)


def _count_holding(rows: DataFrame) -> np.ndarray:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 2, 1 << BITS), np.int64)
        for batch in batches:
            seen += _holding(*_texts(batch))
        for k in range(2):
            slot = np.flatnonzero(seen[k].any(axis=0))
            yield _sums(k, slot, np.ones(len(slot)), seen[k][:, slot].T)

    sums = _summed(rows, task)
    seen = np.zeros((2, 2, 1 << BITS))
    place, slot = sums.column("place").to_numpy(), sums.column("slot").to_numpy()
    for label in (0, 1):
        seen[place, label, slot] = sums.column(f"v{label}").to_numpy()
    return seen


def _train_round(rows: DataFrame, model: Classifier, memory: list, epoch: int) -> None:
    """One pass over all rows; changes model and memory by the mean of what the parts change."""
    shared = rows.sparkSession.sparkContext.broadcast((model, memory))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, squares = copy.deepcopy(shared.value)
        rng, n = np.random.default_rng([7, epoch]), 0
        for batch in batches:
            index, at, toxic = _texts(batch)
            order = rng.permutation(len(toxic))
            for k in range(0, len(order), BATCH):
                some = np.sort(order[k : k + BATCH])
                _step(own, *_select(index, at, some), toxic[some].astype(np.float32), squares)
            n += len(toxic)
        if not n:
            return
        before, squares_before = shared.value
        for k in range(2):
            change = np.concatenate([own.tables[k] - before.tables[k], squares[0][k] - squares_before[0][k]], axis=1)
            slot = np.flatnonzero(change.any(axis=1))
            units = np.rint(change[slot].astype(np.float64) * UNITS).astype(np.int64)
            yield _sums(k, slot, np.full(len(slot), n), units * n)
        change = _dense(own, squares) - _dense(before, squares_before)
        units = np.rint(change * UNITS).astype(np.int64)
        yield _sums(2, np.arange(len(units)), np.full(len(units), n), units[:, None] * n)

    sums = _summed(rows, task)
    shared.unpersist()
    place, slot = sums.column("place").to_numpy(), sums.column("slot").to_numpy()
    mean = _values(sums) / sums.column("n").to_numpy()[:, None] / UNITS
    for k in range(2):
        own = place == k
        model.tables[k][slot[own]] += mean[own, :DIMS].astype(np.float32)
        memory[0][k][slot[own]] += mean[own, DIMS:].astype(np.float32)
    own = place == 2
    _add_dense(model, memory, mean[own, 0][np.argsort(slot[own])])


def _count_logits(rows: DataFrame, model: Classifier) -> pa.Table:
    """lang, logit, toxic and how many rows have them; logits in steps of 1 / STEPS."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, at, _ = _texts(batch)
            logits = [
                shared.value.forward(*_select(index, at, np.arange(k, min(k + 256, len(at) - 1))))[0]
                for k in range(0, len(at) - 1, 256)
            ]
            steps = np.rint(np.clip(np.concatenate([[], *logits]), -100, 100) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("toxic"), pa.array(steps)], names=["lang", "toxic", "logit"])

    found = rows.mapInArrow(task, "lang string, toxic int, logit bigint").groupBy("lang", "toxic", "logit")
    return found.agg(F.count("*").alias("times")).orderBy("lang", "toxic", "logit").toArrow()


def _calibrate(model: Classifier, counted: pa.Table) -> None:
    logits = counted.column("logit").to_numpy() / STEPS
    toxic = counted.column("toxic").to_numpy().astype(np.float64)
    times = counted.column("times").to_numpy().astype(np.float64)
    model.slope, model.shift = _platt(logits, toxic, times)
    scores = 1 / (1 + np.exp(-np.clip(model.slope * logits + model.shift, -500, 500)))
    model.threshold = best_threshold(scores, toxic, times)
    lang = np.array([x or "" for x in counted.column("lang").to_pylist()], object)
    for name in sorted(set(lang) - {""}):
        own = lang == name
        if min((times * toxic)[own].sum(), (times * (1 - toxic))[own].sum()) >= LEAST_ROWS:
            model.thresholds[name] = best_threshold(scores[own], toxic[own], times[own])


def fit(docs: DataFrame, labels: DataFrame, shard_rows: int = SHARD_ROWS) -> Classifier:
    """A classifier of documents (doc_id, text, lang) from all labels (doc_id, toxic)."""
    chosen = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    chosen = chosen.agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    # few texts without a label pass the filter of ids, and none with one is lost, so that only these are shuffled
    asked = ngrams._bits(chosen.select(F.xxhash64(F.col("doc_id").try_cast(id_type)).alias("hash")))
    docs = docs.filter(ngrams._holds(asked, F.xxhash64("doc_id")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in arrays.blocks(arrays.column(batch, "text")):
                index, at = slots(data, offsets)
                both = (index[0].astype(np.int64) << 32) | index[1]
                part = batch.slice(row, len(offsets) - 1)
                words = arrays.list_array(both, at, pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "held", "toxic", "lang")), words], names=["doc_id", "held", "toxic", "lang", "words"])

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", lang.alias("lang")).hint("merge").join(chosen, "doc_id")
    held = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(CALIBRATION)) == 0
    shards = max(1, -(-labels.count() // shard_rows))
    rows = rows.select("doc_id", held.alias("held"), "toxic", "lang", "text").repartition(shards, "doc_id")
    rows = rows.sortWithinPartitions("doc_id", "text")
    made = rows.mapInArrow(hashed, f"doc_id {id_type}, held boolean, toxic int, lang string, words array<bigint>")
    rows = cut_lineage(made)
    learn = rows.filter("NOT held").select("toxic", "lang", "words")
    counts = {(r.held, r.toxic): r.n for r in rows.groupBy("held", "toxic").agg(F.count("*").alias("n")).collect()}
    no, yes = counts.get((False, 0), 0), counts.get((False, 1), 0)
    model, memory = _beginning()
    if not (no and yes):
        model.out[:] = 0
        every = sum(counts.values())
        share = sum(n for (_, toxic), n in counts.items() if toxic) / every if every else 0.0
        model.shift = float(np.log(share / (1 - share))) if 0 < share < 1 else (50.0 if share else -800.0)
        return model
    # embeddings begin as the shrunk log-odds of the texts that hold a word of the slot
    share, weight, seen = yes / (no + yes), 5.0, _count_holding(learn)
    odds = np.log((seen[:, 1] + weight * share) / (seen[:, 0] + weight * (1 - share))) - np.log(share / (1 - share))
    model.tables[:, :, 0] = odds / 2
    for k in range(len(WIDTHS)):  # one filter of each width begins as the sum of its words' log-odds
        model.filters[k][:, :, 0] = 0
        model.filters[k][:, [0, DIMS], 0] = 1
        model.bias[k, 0] = -1
        model.out[k, 0] = 0.5
    model.base = -2.0
    for epoch in range(EPOCHS):
        _train_round(learn, model, memory, epoch)
    both = counts.get((True, 0), 0) and counts.get((True, 1), 0)
    _calibrate(model, _count_logits(rows.filter("held") if both else learn, model))
    return model


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """The rows with `score`, the probability that their text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name != "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = shared.value
        for batch in batches:
            rest = batch.select([f.name for f in kept])
            for row, data, offsets in arrays.blocks(arrays.column(batch, "text"), 1 << 20):
                part = rest.slice(row, len(offsets) - 1)
                made = pa.array(classifier.score(*slots(data, offsets)), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, "score"])

    return docs.mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))


def rejected(docs: DataFrame, model: Classifier) -> DataFrame:
    """The rows with `score` and `rejected`: whether it reaches the threshold of the row's language."""
    scored = score(docs, model)
    limit = F.lit(model.threshold)
    if model.thresholds and "lang" in docs.columns:
        own = F.create_map(*(F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair))
        limit = F.coalesce(own[F.col("lang").cast("string")], limit)
    return scored.withColumn("rejected", F.col("score") >= limit)
