"""Toxicity by held-out accuracy and the language model against brute force."""

import collections
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from chatterscope.llm import kneser_ney, queries, toxicity


def test_toxic_rows_of_planted_words_are_found(spark):
    rng = random.Random(1)
    bad = {"en": ["scum", "moron"], "fr": ["vejuté", "vequta"]}
    docs, labels = [], []
    for i in range(900):
        lang, toxic = rng.choice(["en", "fr"]), rng.random() < 0.2
        words = ["".join(rng.choices("aeiou" if lang == "fr" else "bcdfg", k=4)) for _ in range(rng.randint(5, 150))]
        if toxic:
            for _ in range(2):
                words.insert(rng.randint(0, len(words)), rng.choice(bad[lang]).capitalize() + ",")
        docs.append((i, " ".join(words), lang))
        labels.append((i, int(toxic)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(frame, marks.filter("doc_id < 600"))
    again = toxicity.fit(frame.repartition(5), marks.filter("doc_id < 600"))
    assert np.array_equal(model.out, again.out) and model.thresholds == again.thresholds
    got = {r.doc_id: r for r in toxicity.rejected(frame, model).filter("doc_id >= 600").collect()}
    right = sum(got[i].rejected == bool(t) for i, t in labels if i >= 600)
    assert right >= 0.97 * len(got)
    assert sum((got[i].score >= toxicity.THRESHOLD) == bool(t) for i, t in labels if i >= 600) >= 0.95 * len(got)


def test_held_out_rows_of_the_tables(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    rows = queries.op2_toxicity(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    clean = [r for r in held if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)
    order = sorted(held, key=lambda r: r.score)
    ranks = [k + 1 for k, r in enumerate(order) if r.toxic]
    auc = (sum(ranks) - len(ranks) * (len(ranks) + 1) / 2) / (len(ranks) * (len(held) - len(ranks)))
    assert auc > 0.75  # from about 230 learned rows


def test_toxicity_of_odd_rows(spark, odd, none):
    marks = spark.createDataFrame([(1, 1), (1, 0), (8, 0), (9, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    for labels in (marks, marks.filter("doc_id = 8"), marks.limit(0)):
        model = toxicity.fit(odd, labels)
        scored = toxicity.rejected(odd, model)
        assert scored.count() == odd.count() and scored.filter("score BETWEEN 0 AND 1").count() == odd.count()
        assert len({r.score for r in scored.filter("doc_id IN (2, 3, 4)").collect()}) == 1
        assert toxicity.rejected(none, model).count() == 0
    assert toxicity.fit(none, marks).base == 0


def tokens(text):
    return [x for x in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x] + [None]


class Brute:
    def __init__(self, texts):
        rows = [tokens(t) for t in texts]
        self.c = collections.Counter(x for r in rows for x in r)
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.pairs = collections.Counter(p for r in rows for p in zip([0, *r], r))
        self.before = collections.Counter(a for (a, _), n in self.pairs.items() for _ in range(n))
        self.ends = collections.Counter(b for _, b in self.pairs)
        self.kinds = collections.Counter((a, min(n, 3)) for (a, _), n in self.pairs.items())
        self.d, self.d1 = (self.discounts(x.values()) for x in (self.pairs, self.ends))
        total = len(self.pairs)
        self.left = sum(self.d1[min(n, 3)] for n in self.ends.values()) / total if total else 1
        self.total = max(1, total)

    @staticmethod
    def discounts(counts):
        n = [sum(1 for x in counts if x == k) for k in (1, 2, 3, 4)]
        if not all(n):
            return [0, 0.5, 0.75, 0.9]
        y = n[0] / (n[0] + 2 * n[1])
        found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
        return [0, *(min(max(d, 0.05), 0.95 * (k + 1)) for k, d in enumerate(found))]

    def p1(self, w):
        return self.left / (self.v + 1) + (self.ends[w] - self.d1[min(self.ends[w], 3)]) / self.total

    def p(self, a, w):
        if a not in self.before:
            return self.p1(w)
        n, gamma = self.pairs[a, w], sum(self.d[k] * self.kinds[a, k] for k in (1, 2, 3))
        return (n - self.d[min(n, 3)] + gamma * self.p1(w)) / self.before[a]

    def score(self, text):
        row = tokens(text)
        base = sum(math.log10((self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in row)
        return len(row), sum(self.c[w] > 0 for w in row), base, sum(math.log10(self.p(a, w)) for a, w in zip([0, *row], row))


def same(got, want):
    return got[:2] == want[:2] and got[2:] == pytest.approx(want[2:], rel=1e-9, abs=1e-9)


def test_scores_equal_brute_force(spark, sf_dir, documents):
    docs = {r.doc_id: r.text for r in documents.collect()}
    model = Brute([t for i, t in docs.items() if zlib.crc32(str(i).encode()) % 10])
    rows = queries.op9_kneser_ney(spark, sf_dir).collect()
    assert len(rows) == len(docs) and {r.train_tokens for r in rows} == {model.n}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)
    assert all(same((r.n_tokens, r.n_known, r.base_score, r.score), model.score(docs[r.doc_id])) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_after_any_word_sum_to_one(spark, odd):
    texts = ["a b a b c", "b a", "c c c", ""]
    folder = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    model = Brute(texts)
    words = ["a", "b", "c", None, "unknown"]
    for before in ["a", "c", "unknown"]:
        assert sum(model.p(before, w) for w in words) == pytest.approx(1)
    many = [f"{x} {y}" for x in words[:3] for y in words if y] + texts
    got = kneser_ney.score(spark.createDataFrame([(t,) for t in many], "text string"), folder).collect()
    assert all(same((r.n_tokens, r.n_known, r.base_score, r.score), model.score(r.text)) for r in got)
    assert kneser_ney.perplexity(kneser_ney.score(odd, folder)).filter("perplexity >= 1").count() == odd.count()


def test_language_model_of_odd_rows(spark, odd, none):
    model = Brute([r.text for r in odd.collect()])
    scored = kneser_ney.score(odd, kneser_ney.train(odd)).collect()
    assert all(same((r.n_tokens, r.n_known, r.base_score, r.score), model.score(r.text)) for r in scored)
    empty = kneser_ney.train(none)
    assert {r.train_tokens for r in kneser_ney.score(odd, empty).collect()} == {0}
    assert kneser_ney.score(none, empty).count() == 0


def test_spread_bigrams_and_small_parts_change_nothing(spark, documents, monkeypatch):
    monkeypatch.setattr(kneser_ney, "PART_TOKENS", 2_000)
    monkeypatch.setattr(kneser_ney, "WORDS_IN_PART", 500)
    texts = [r.text for r in documents.collect()]
    model = Brute(texts)
    got = kneser_ney.score(documents, kneser_ney.train(documents)).collect()
    assert all(same((r.n_tokens, r.n_known, r.base_score, r.score), model.score(r.text)) for r in got)


def test_all_labels_are_learned_from(spark):
    """A word that only the last rows hold, and parts of 50 rows."""
    rows = [(i, f"some text {i % 7} " + ("vile words" if i % 3 == 0 else "kind words")) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marks = frame.selectExpr("doc_id", "CAST(doc_id % 3 = 0 AS INT) AS toxic")
    model = toxicity.fit(frame, marks, 50)
    learned = frame.filter("pmod(xxhash64(CAST(doc_id AS STRING)), 5) <> 0").count()
    seen = []
    count = toxicity._count_holding

    def holding(part):
        seen.append(part.count())
        return count(part)

    toxicity._count_holding, again = holding, None
    try:
        again = toxicity.fit(frame.repartition(3), marks, 50)
    finally:
        toxicity._count_holding = count
    assert seen == [learned] and np.array_equal(model.tables, again.tables)
    got = {r.doc_id: r.rejected for r in toxicity.rejected(frame, model).collect()}
    assert got == {i: i % 3 == 0 for i in range(300)}


def test_ids_of_other_types_are_learned_from(spark, monkeypatch):
    """The filter of labelled ids loses no label whose id has another type, and lets few other texts through."""
    rows = [(i, f"some text {i % 7} " + ("vile words" if i % 3 == 0 else "kind words")) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marks = frame.filter("doc_id < 300").selectExpr("doc_id", "CAST(doc_id % 3 = 0 AS INT) AS toxic")
    passed, holds = [], toxicity.ngrams._holds
    monkeypatch.setattr(toxicity.ngrams, "_holds", lambda bits, hash_: passed.append(holds(bits, hash_)) or passed[-1])
    models = [toxicity.fit(frame, marks.withColumn("doc_id", marks.doc_id.cast(kind))) for kind in ("bigint", "int", "string")]
    assert all(np.array_equal(models[0].tables, m.tables) and np.array_equal(models[0].out, m.out) for m in models)
    assert {r.doc_id for r in frame.filter(passed[0]).collect()} >= set(range(300))
    assert frame.filter(passed[0]).count() < 1000
    far = spark.createDataFrame([(5_000_000_000, 1)], "doc_id long, toxic int").union(marks)
    small = toxicity.fit(frame.withColumn("doc_id", frame.doc_id.cast("int")), far)
    assert small.out.any()


def test_table_rows_are_read_without_copies():
    want = np.random.default_rng(1).integers(0, 1 << toxicity.BITS, (2, 100_000))
    words = pa.ListArray.from_arrays(pa.array([0, 7, 100_000], pa.int32()), pa.array((want[0] << 32) | want[1]))
    batch = pa.RecordBatch.from_arrays([words, pa.array([0, 1])], names=["words", "toxic"])
    tracemalloc.start()
    index, at, toxic = toxicity._texts(batch)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(index, want) and index.dtype == np.int32 and list(at) == [0, 7, 100_000] and list(toxic) == [0, 1]
    assert most < 1.5 * index.nbytes
