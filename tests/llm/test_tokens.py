"""Pieces, token counts and token files against the libraries, with odd rows and random texts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chatterscope.llm import arrays, piece_bpe, queries, token_counts, token_files

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SP = sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = ["", " ", "  ", "a  b   c    d", "\n\n x", "<s> hi </s>", "▁x", "a" * 700, "\t\tf(bar)[1]={};\0", "one " * 999]
    alphabet = [*"abeinorst  \n.,'’1234", "é", "中", "😀", " ", "　", "\r", "\x1c", "'s", "<|endoftext|>", " the"]
    out += ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(2000)]
    out += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0x500), rng.randint(0x4E00, 0x9000)])) for _ in range(120)) for _ in range(100)]
    return out


def flat(texts):
    return arrays.flat(pa.array(texts, pa.large_string()))


def rows(values, at):
    return [values[a:b].tolist() for a, b in zip(at, at[1:])]


def test_pieces_equal_the_library(texts):
    model = piece_bpe.load(PIECES)
    ids, at = piece_bpe.encode(model, *flat(texts))
    want = SP.encode(texts, num_threads=1)
    assert rows(ids, at) == want
    assert piece_bpe.decode(model, ids, at) == [SP.decode(x) for x in want]


def test_any_ids_are_decoded_like_the_library():
    rng, model = random.Random(4), piece_bpe.load(PIECES)
    lists = [[rng.randint(3, 400) for _ in range(rng.randint(0, 20))] for _ in range(300)]
    at = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    assert piece_bpe.decode(model, np.array(sum(lists, []), np.int32), at) == [SP.decode(x) for x in lists]


def test_transducer_equals_the_library_for_any_chunk_and_table_size(texts):
    want = [len(x) for x in SP.encode(texts, num_threads=1)]
    assert token_counts.load(PIECES).counts(*flat(texts)).tolist() == want
    small = token_counts.Transducer(piece_bpe.load(PIECES), most_cells=1000)
    for chunk in (1, 3, 50):
        assert small.counts(*flat(texts[:300]), chunk=chunk).tolist() == want[:300]
    assert small.flushes > 0


def test_byte_pieces_equal_the_library(texts):
    tokenizer = Tokenizer.from_file(BYTES)
    ids, at = token_files.encode(BYTES, *flat(texts), 0)
    assert rows(ids, at) == [e.ids + [0] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_odd_rows_are_kept_with_their_columns(odd, none):
    both = piece_bpe.encode_decode(odd, PIECES)
    assert both.count() == odd.count() and {"label", "ids", "decoded"} <= set(both.columns)
    assert both.filter("doc_id IN (2, 3) AND size(ids) = 0 AND decoded = ''").count() == 2
    assert both.filter("text IS NOT NULL AND decoded <> replace(text, '▁', ' ')").count() == 0
    counted = token_counts.count_tokens(odd, PIECES)
    assert counted.count() == odd.count()
    got = {(r.doc_id, r.text): r.n_tokens for r in counted.collect()}
    assert got == {(r.doc_id, r.text): len(SP.encode(r.text or "")) for r in odd.collect()}
    assert piece_bpe.encode_decode(none, PIECES).count() == token_counts.count_tokens(none, PIECES).count() == 0


def test_token_files_round_trip(spark, odd, none):
    tokenizer = Tokenizer.from_file(BYTES)
    folder = token_files.written(odd, BYTES)
    ordered = sorted(odd.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for doc_id, text in ordered:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((doc_id, start, len(ids), ids.tobytes()))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_ids, bytes(r.ids)) for r in token_files.read(spark, folder).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    some = token_files.read(spark, folder, [5, 7]).collect()
    assert sorted((r.doc_id, r.start, r.n_ids, bytes(r.ids)) for r in some) == sorted(w for w in want if w[0] in (5, 7))
    assert token_files.read(spark, token_files.written(none, BYTES)).count() == 0


def test_queries_equal_the_libraries(spark, sf_dir, documents):
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    counts = {r.doc_id: r for r in queries.op3_token_counts(spark, sf_dir).collect()}
    assert all(counts[i].n_tokens == len(SP.encode(t)) and counts[i].n_bytes == len(t.encode()) for i, t in docs)
    files = {r.doc_id: r for r in queries.op7_token_files(spark, sf_dir).collect()}
    tokenizer, start = Tokenizer.from_file(BYTES), 0
    for i, t in docs:
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4")
        assert (files[i].start, files[i].n_tokens, files[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    import hashlib

    for r in queries.op10_piece_bpe(spark, sf_dir).collect():
        text = dict(docs)[r.doc_id]
        ids = SP.encode(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(SP.decode(ids).encode()).hexdigest()
