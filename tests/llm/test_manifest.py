"""Merkle manifest, WARC archives and spelling variants against plain Python."""

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from os.path import commonprefix

import pytest
from pyspark.sql import functions as F

from chatterscope.llm import merkle, spelling, warc

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row):
    parts = ["-" if v is None else str(v) for v in row]
    return sha("".join(p if v is None else f"{len(p.encode())}:{p}" for p, v in zip(parts, row, strict=True)))


def brute_tree(leaves):
    """The root, and for every leaf its (left, right) steps."""
    level, groups, steps = list(leaves), [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(level) > 1:
        up, joined = [], []
        for k in range(0, len(level), merkle.FANOUT):
            run = level[k : k + merkle.FANOUT]
            for j in range(len(run)):
                for i in groups[k + j]:
                    steps[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha("".join(run)))
            joined.append([i for g in groups[k : k + merkle.FANOUT] for i in g])
        level, groups = up, joined
    return (level[0] if level else merkle.NOTHING), steps


def brute_manifest(rows):
    by = defaultdict(list)
    for row in rows:
        by[row[1]].append((row[0] is not None, row[0] or 0, brute_leaf(row), row))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(by[s], key=lambda x: x[:3]), *brute_tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])])) for s in names}
    root, above = brute_tree([trees[s][1] for s in names])
    out = []
    for s, up in zip(names, above, strict=True):
        leaves, subroot, steps = trees[s]
        for (_, _, leaf, row), own in zip(leaves, steps, strict=True):
            way = own + up
            copy = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                copy = (*row[:4], re.sub("[A-Z]", lambda m: m[0].lower(), row[4]))
            end = brute_leaf(copy)
            for left, right in way:
                end = sha(left + end + right)
            out.append((row[0], leaf, subroot, root, sha("".join(a + b for a, b in way)), end, end == root))
    return sorted(out, key=repr)


def manifest_rows(docs):
    found = merkle.check_copy(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.lowered(F.col("text")))
    found = found.select("doc_id", "leaf", "group_root", "root", merkle.proof_hash(F.col("steps")), "folded_root", "verified")
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("sizes", [[1], [2], [17], [1, 1], [300, 16, 1, 40], [1] * 40, [5000]])
def test_manifest_equals_brute_force(spark, sizes):
    rng = random.Random(len(sizes))
    sources = [None, "", "é", "z", *(f"s{i}" for i in range(40))]
    rows = []
    for s, n in zip(sources, sizes, strict=False):
        rows += [(i, s, rng.choice(["en", None]), i, rng.choice(["Some Text É", "", None, "lower"])) for i in rng.sample(range(9999), n)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert manifest_rows(docs) == brute_manifest(rows)


def test_manifest_of_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "a", "en", 1, "X")] * 400 + [(None, "a", None, None, None), (None, "a", None, None, ""), (1, "a", "en", 1, "Y"), (2, None, "en", 1, "long " * 50_000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clashing = docs.withColumns({c: F.lit("x") for c in ("tree", "at", "level", "leaf", "slot", "steps", "part", "row", "copy")})
    assert manifest_rows(clashing) == brute_manifest(rows)


def test_manifest_of_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert manifest_rows(docs) == []


def test_a_proof_fails_for_any_other_leaf(spark):
    rows = [(i, "a", "en", i, f"Text {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle.check_copy(docs, F.col("doc_id") == 7, F.lit("Text 8")).select("doc_id", "verified").collect()
    assert {r.doc_id for r in found if not r.verified} == {7}


# archives

PAGES = "page_id long, url string, payload binary"


def round_trip(pages):
    return sorted(map(tuple, warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def brute_archive(rows, least=warc.LEAST_BYTES):
    last = {}
    for page_id, _, payload in rows:
        payload = payload or b""
        if len(payload) >= least and page_id is not None:
            last[payload] = max(page_id, last.get(payload, page_id))
    out = []
    for page_id, _, payload in rows:
        payload = payload or b""
        to = last.get(payload)
        revisit = to is not None and (page_id is None or page_id < to)
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def test_archives_come_back(spark):
    rng = random.Random(3)
    big = [rng.randbytes(1000), b"a" * 5000, b"\0\r\n\r\n" * 900]
    rows = [(i, f"http://h/{i}?a=b c\r\né", rng.choice([*big, b"short", b"x" * 999, rng.randbytes(1200), b""])) for i in range(500)]
    rows += [(None, None, big[0]), (None, "", None), (3, "u", big[1]), (499, "u", big[1]), (-5, "u", big[2]), (600, "http://long", rng.randbytes(17 << 20))]
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit("x") for c in ("key", "salt", "revisit", "largest", "n", "data")})
    assert round_trip(pages.repartition(4)) == brute_archive(rows)
    assert round_trip(pages.limit(0)) == []


def test_archives_are_plain_gzip_members_with_their_payloads(spark, tmp_path):
    rows = [(i, f"http://h/{i}", (b"<html>%d</html>" % (i % 7)) * 100) for i in range(200)]
    path = str(tmp_path / "archive")
    warc.write(spark.createDataFrame(rows, PAGES).repartition(2), path, segment=2000)
    files = sorted((tmp_path / "archive").glob("part-*"))
    text = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert text.count(b"WARC/1.1\r\nWARC-Type: re") == 200
    kept = {r.page_id: bytes(r.payload) for r in warc.read(spark, path, payload=True).filter("record_type = 'response'").collect()}
    assert kept == {i: p for i, _, p in rows if i >= 193}
    assert len(files) > 2  # a file holds a bounded number of segments


def archive(n=3, size=5000):
    return b"".join([*(warc.page_record(i, f"http://h/{i}", bytes([65 + i]) * size) for i in range(n)), warc.end_record(n)])


def pieces(data, size):
    return (data[k : k + size] for k in range(0, len(data), size))


@pytest.mark.parametrize("size", [1, 7, 100, 1 << 16])
def test_reader_takes_any_pieces(size):
    assert [r["payload_bytes"] for r in warc.records(pieces(archive(), size))] == [5000] * 3
    long = archive(2, 3_000_000)
    assert [len(r["payload"]) for r in warc.records(pieces(long, size << 6), keep=True)] == [3_000_000] * 2


@pytest.mark.parametrize(
    ("broken", "message"),
    [
        (lambda: archive()[:-5], "ends within a record"),
        (lambda: archive()[: -len(warc.end_record(3))], "ends within a segment"),
        (lambda: archive(2)[: -len(warc.end_record(2))] + warc.end_record(3), "another number"),
        (lambda: b"not gzip at all", "broken gzip"),
        (lambda: archive() + b"junk", "broken gzip"),
        (lambda: gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\n\r\nabc\r\n\r\n"), "Content-Length"),
        (lambda: gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"), "shorter"),
        (lambda: gzip.compress(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nabc\r\n\r\n"), "goes on"),
        (lambda: gzip.compress(b"WARC/1.1\r\nContent-Length: 3\r\nWARC-Block-Digest: sha1:00\r\n\r\nabc\r\n\r\n"), "block digest"),
        (lambda: gzip.compress(b"WARC/1.1\r\nContent-Length: 3\r\nWARC-Payload-Digest: sha1:00\r\n\r\nabc\r\n\r\n"), "payload digest"),
        (lambda: gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n"), "not a record"),
        (lambda: gzip.compress(b"WARC/1.1\r\nContent-Length\r\n\r\n"), "colon"),
        (lambda: gzip.compress(b"WARC/1.1\r\n"), "without end"),
    ],
)
def test_reader_refuses_broken_archives(broken, message):
    with pytest.raises(ValueError, match=message):
        list(warc.records(pieces(broken(), 100)))


# spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    before, after = len(commonprefix([a, b])), len(commonprefix([a[::-1], b[::-1]]))
    return a != b and len(b) - len(a) <= 1 and before + after >= len(b) - 1


def brute_variants(rows, slip, least=spelling.LEAST_COUNT):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= least}
    out = {}
    for w in n:
        links = [x for x in n if near(w, x)]
        best = min(links, key=lambda x: (-n[x], x), default=None)
        form = best if best and n[best] >= 5 * n[w] else None
        out[w] = [n[w], len(links), form, n.get(form)]
    for w, found in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        found.append(root)
    return sorted((w, *v) for w, v in out.items())


def variants(docs, **options):
    return sorted(map(tuple, spelling.variants(docs, **options).select("word", "n", "n_near", "form", "form_n", "root").collect()))


def texts(n, seed, letters="abéÿ", sizes=(6, 9)):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(60)]
    return [(i % 40, " ".join(rng.choice(words).upper() if k % 3 else words[int(rng.paretovariate(0.5)) % 60] for k in range(80))) for i in range(n)]


@pytest.mark.parametrize(("slip", "block"), [(0, spelling.BLOCK), (7, 5), (7, 30), (3, 1)])
def test_variants_equal_brute_force(spark, slip, block):
    rows = texts(60, slip + block)
    assert variants(spark.createDataFrame(rows, "doc_id long, text string"), slip=slip, block=block) == brute_variants(rows, slip)


def test_one_beginning_may_hold_all_words(spark):
    rng = random.Random(2)
    words = ["commonbeginning" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    rows = [(i, " ".join(words)) for i in range(6)]
    assert variants(spark.createDataFrame(rows, "doc_id long, text string"), block=10) == brute_variants(rows, 0)


def test_variants_of_odd_rows(odd, none, spark):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert variants(odd, slip=2, least=1) == brute_variants(rows, 2, 1)
    assert variants(none) == []
    long = [(1, "x" * 20_000 + " " + "Naïveté " * 9), (None, "x" * 19_999), (2, "× ÷ÀÀÀÀÀÀ")]
    for slip in (0, 1):
        assert variants(spark.createDataFrame(long, "doc_id long, text string"), slip=slip, least=1) == brute_variants(long, slip, 1)
