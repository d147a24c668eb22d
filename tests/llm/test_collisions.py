"""Texts that a polynomial hash modulo a power of two takes for each other."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatterscope.llm import arrays, kneser_ney, near_duplicates, piece_bpe, queries, sentence_spans, token_counts, token_files


def thue_morse(n=10):
    """A word of 2^n letters and its complement."""
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


ONE, TWO = thue_morse()
TEXTS = [(1, ONE), (2, TWO), (3, f"{ONE} {TWO} x"), (4, f"{TWO} {ONE} x"), (5, f" {TWO}\n{ONE}")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(1)


def test_hashes_differ():
    data = np.frombuffer((ONE + TWO).encode(), np.uint8)
    half = np.array([0, len(ONE)])
    for values in (data, data.astype(np.uint32), arrays.mix(data.astype(np.uint64))):
        first, second = arrays.span_hashes(values, half, half + len(ONE))
        assert first != second


def test_products_modulo_the_prime():
    rng = np.random.default_rng(1)
    prime = 2**61 - 1
    a, b = (rng.integers(0, prime, 500, dtype=np.uint64) for _ in range(2))
    a[:3], b[:3] = prime - 1, prime - 1
    assert [int(x) for x in arrays.times(a, b)] == [int(x) * int(y) % prime for x, y in zip(a, b, strict=True)]
    small = rng.integers(0, 2**32, 500, dtype=np.uint32)
    assert [int(x) for x in arrays.times(small, b)] == [int(x) * int(y) % prime for x, y in zip(small, b, strict=True)]


def test_spans_are_told_apart_whatever_their_hashes(monkeypatch):
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 3000, dtype=np.uint8)
    starts = rng.integers(0, 2990, 2000)
    ends = starts + rng.integers(1, 8, 2000)
    monkeypatch.setattr(arrays, "span_hashes", lambda values, a, b: (b - a).astype(np.uint64) % np.uint64(3))
    _, chosen, which = arrays.distinct_spans(data, starts, ends)
    spans = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert [spans[chosen[k]] for k in which] == spans and len(chosen) == len(set(spans))


def test_ids_are_those_of_the_libraries(docs, monkeypatch):
    import sentencepiece
    from tokenizers import Tokenizer

    piece = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    got = {r.doc_id: r.ids for r in piece_bpe.encode_decode(docs, queries.tokenizer("piece_bpe_32k.model")).collect()}
    assert got == {i: piece.encode(t) for i, t in TEXTS}
    counted = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, queries.tokenizer("piece_bpe_32k.model")).collect()}
    assert counted == {i: len(piece.encode(t)) for i, t in TEXTS}
    path = queries.tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)

    def same(texts):
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
        ids, at = token_files.encode(path, data, offsets, 0)
        assert [ids[a : b - 1].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [library.encode(t, add_special_tokens=False).ids for t in texts]

    same([t for _, t in TEXTS])
    # what a worker remembers is told apart by bytes, too
    monkeypatch.setattr(arrays, "span_hashes", lambda values, a, b: (b - a).astype(np.uint64))
    token_files.seen_of.cache_clear()
    same(["one two six", "ten two"])
    same(["red two ten", "six", "", "one red"])
    token_files.seen_of.cache_clear()


def test_other_operators_tell_them_apart(docs):
    classes = {r.doc_id: r.class_id for r in near_duplicates.classes(docs.filter("doc_id < 3")).collect()}
    assert classes == {1: 1, 2: 2}
    held = docs.withColumn("held_out", F.lit(False))
    scored = {r.doc_id: r for r in kneser_ney.score(held, kneser_ney.train(held)).collect()}
    count = Counter(w for _, t in TEXTS for w in [*t.split(), "end"])
    n, v = sum(count.values()), len(count)
    for i, text in TEXTS:
        expected = sum(np.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*text.split(), "end"])
        assert scored[i].base_score == pytest.approx(expected)
    assert zlib.crc32(ONE.encode()) != zlib.crc32(TWO.encode())


def test_passages_of_one_hash_are_not_removed(spark):
    def passage(word):
        return " ".join(f"{word} w{k}." if k % 5 == 4 else f"v{k}" for k in range(60))

    rows = [(1, passage(ONE)), (2, passage(TWO)), (3, passage(ONE))]
    found = sentence_spans.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    removed = {r.doc_id: r.n_removed for r in found}
    assert removed[1] == 0 and removed[3] > 0
    assert hashlib.sha256(next(r.text for r in found if r.doc_id == 2).encode()).hexdigest()
    assert TWO in next(r.text for r in found if r.doc_id == 2)
