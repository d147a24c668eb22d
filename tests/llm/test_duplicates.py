"""Near duplicates, repeated passages and fingerprints against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from chatterscope.llm import arrays, near_duplicates, queries, sentence_spans, winnowing


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = [x for x in re.split("[ \t-\r]+", lower(text)) if x]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def sentence(rng, n=9):
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n)) + "."


def test_all_similar_pairs_share_a_class(spark, sf_dir, documents):
    rows = queries.op6_near_duplicates(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    class_of = {r.doc_id: r.class_id for r in rows}
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = collections.defaultdict(list)
    for i in sorted(sets):
        for s in sets[i]:
            holders[s].append(i)
    common = collections.Counter((a, b) for ids in holders.values() for n, b in enumerate(ids) for a in ids[:n])
    near = {p: n / (len(sets[p[0]]) + len(sets[p[1]]) - n) for p, n in common.items()}
    assert [p for p, j in near.items() if j >= 0.8 and class_of[p[0]] != class_of[p[1]]] == []
    # what holds a class together: no text without a similar one in it
    best = collections.defaultdict(float)
    for (a, b), j in near.items():
        if class_of[a] == class_of[b]:
            best[a], best[b] = max(best[a], j), max(best[b], j)
    sizes = collections.Counter(class_of.values())
    assert all(best[i] > 0.7 for i, c in class_of.items() if sizes[c] > 1 and sets[i])


def test_a_chain_of_near_copies_is_one_class_and_copies_count(spark):
    rng = random.Random(1)
    words = sentence(rng, 300).split()
    docs = [(100, "other words " + sentence(rng, 40)), (101, None), (102, ""), (103, " "), (None, sentence(rng, 30))]
    for k in range(6):  # each is near the next, the first is far from the last
        docs += [(k, " ".join(words[12 * k : 220 + 12 * k])), (50 + k, " ".join(words[12 * k : 220 + 12 * k]).upper())]
    docs.append(docs[-1])
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = near_duplicates.classes(frame).collect()
    assert len(found) == len(docs)
    assert {r.class_id for r in found if r.doc_id is not None and r.doc_id < 60} == {0}
    assert {r.n_copies for r in found if r.doc_id == 55} == {3}
    assert {r.class_id for r in found if r.doc_id is not None and r.doc_id >= 100} == {100, 101, 102, 103}
    kept = near_duplicates.keep_first(frame).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == [(False, 0), (False, 100), (False, 101), (False, 102), (False, 103), (True, None)]


def test_many_stars_and_pairs_give_the_same_classes(documents):
    few = {(r.doc_id, r.class_id) for r in near_duplicates.classes(documents, stars=0).collect()}
    many = {(r.doc_id, r.class_id) for r in near_duplicates.classes(documents, stars=3).collect()}
    assert few == many


def test_samples_meet_as_often_as_weights_overlap():
    rng = np.random.default_rng(5)
    h = arrays.mix(np.arange(400, dtype=np.uint64))
    x, y = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 300)
    at = np.array([0, 300, 600])
    keys = np.concatenate((h[:300], h[100:]))
    weights = np.concatenate((x, y)).astype(np.float32)
    draws = near_duplicates.samples(keys, weights, at, 3000, near_duplicates._draws())
    low, high = np.minimum(x[100:], y[:200]).sum(), x[:100].sum() + y[200:].sum() + np.maximum(x[100:], y[:200]).sum()
    assert abs((draws[0] == draws[1]).mean() - low / high) < 0.035


def test_near_duplicates_of_odd_rows(odd, none):
    found = near_duplicates.classes(odd)
    assert found.count() == odd.count() and near_duplicates.classes(none).count() == 0
    kept = near_duplicates.keep_first(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1


def brute_spans(docs, run=3, min_words=15, longest=20):
    """Sentences kept of (doc_id, key, text), by quadratic search."""
    units = {}
    for doc_id, key, text in docs:
        out = []
        for part in re.finditer(r"[^ \t-\r]+", text):
            word, new = part[0], not out or out[-1][1]
            if not new and (len(out[-1][0]) == longest or re.search("[\n\r]", text[last:part.start()])):
                new = True
            if new:
                out.append([[], False, part.start()])
            out[-1][0].append(lower(word))
            out[-1][1] = word[-1] in ".!?"
            last = part.end()
        units[doc_id, key] = out
    first, places = {}, []
    for d in sorted(units):
        u = units[d]
        shortest = set()
        for i in range(len(u)):
            for j in range(i + run, len(u) + 1):
                if sum(len(x[0]) for x in u[i:j]) >= min_words:
                    shortest.add((i, j))
                    break
            for k in range(i + 1 - run, -1, -1):
                if sum(len(x[0]) for x in u[k : i + 1]) >= min_words:
                    shortest.add((k, i + 1))
                    break
        for a, b in sorted(shortest):
            content = tuple(w for x in u[a:b] for w in x[0])
            if content in first:
                places.append((d, a, b))
            else:
                first[content] = (d, a)
    gone = collections.defaultdict(set)
    for d, a, b in places:
        gone[d].update(range(a, b))
    return units, gone


def test_repeated_passages_against_brute_force(spark):
    rng = random.Random(7)
    pool = [sentence(rng, rng.choice([1, 2, 5, 9, 30, 45])) for _ in range(40)]
    docs = []
    for i in range(60):
        parts = [sentence(rng, rng.randint(1, 30)) for _ in range(rng.randint(0, 5))]
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, 35)
            parts[rng.randint(0, len(parts)) : 0] = pool[a : a + rng.randint(1, 6)]
        docs.append((i, "".join(p + rng.choice([" ", "\n", "  "]) for p in parts)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in sentence_spans.dedup_spans(frame).collect()}
    units, gone = brute_spans([(i, 0, t) for i, t in docs])
    assert sum(map(len, gone.values())) > 50
    for i, text in docs:
        u, out = units[i, 0], gone.get((i, 0), set())
        ends = [x[2] for x in u[1:]] + [len(text)]
        want = (text[: u[0][2]] if u else text) + "".join(text[x[2] : e] for k, (x, e) in enumerate(zip(u, ends)) if k not in out)
        assert (got[i].text, got[i].n_removed, got[i].n_sentences) == (want, len(out), len(u))


def test_a_long_shared_passage_goes_from_all_but_the_first(spark):
    rng = random.Random(8)
    for passage in (" ".join(sentence(rng) for _ in range(7)), sentence(rng, 60)):
        docs = [(i, f"{sentence(rng)} {sentence(rng)} {passage} {sentence(rng)}") for i in range(40)]
        got = sentence_spans.dedup_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()
        own = {i: t.replace(passage + " ", "") for i, t in docs}
        assert all(r.text == (docs[0][1] if r.doc_id == 0 else own[r.doc_id]) for r in got)


def test_passages_planted_inside_sentences_go_from_all_but_the_first(spark):
    rng = random.Random(12)
    words = lambda n: sentence(rng, n)[:-1].split()
    for lengths in ((51, 60, 70), (39, 100, 300)):
        docs, planted = [], {}
        for k in range(12):
            passage = words(lengths[k % 3])
            for i in (2 * k, 2 * k + 1):
                before, after = words(rng.randint(3, 60)), words(rng.randint(3, 60))
                docs.append((i, " ".join(before + passage + after) + "."))
                planted[i] = before, passage, after
        got = {r.doc_id: r.text for r in sentence_spans.dedup_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
        for i, text in docs:
            before, passage, after = planted[i]
            out = got[i].rstrip(".").split()
            if i % 2 == 0:
                assert got[i] == text
                continue
            stayed = len(out) - len(before) - len(after)
            head = next(n for n in range(stayed + 1) if out == before + passage[:n] + passage[len(passage) - stayed + n :] + after)
            assert head < sentence_spans.NEAR and stayed - head < sentence_spans.NEAR


def test_frequent_and_rare_spans_give_the_same_result(spark, documents, monkeypatch):
    frame = documents.select("doc_id", "text")
    rows = lambda: sorted((r.doc_id, r.text, r.n_removed) for r in sentence_spans.dedup_spans(frame).na.fill("").collect())
    want = rows()
    for name, value in (("FREQUENT", 0), ("SAMPLE", 1)):
        monkeypatch.setattr(sentence_spans, name, value)
        assert rows() == want
        monkeypatch.undo()


def test_spans_of_odd_rows(odd, none):
    got = sentence_spans.dedup_spans(odd)
    assert got.count() == odd.count() and got.filter("doc_id < 8 AND n_removed > 0").count() == 0
    assert got.filter("doc_id = 2 AND text IS NULL").count() == 1
    assert sentence_spans.dedup_spans(none).count() == 0


def test_winnowing_against_brute_force():
    def brute(text, k, w):
        p = np.array([ord(c) for c in text], np.uint32)
        if not len(p):
            return []
        if len(p) < k:
            return [(0, int(arrays.span_hashes(p, np.zeros(1, np.int64), np.array([len(p)]))[0] >> np.uint64(32)))]
        grams = [int(winnowing.gram_hashes(p[a : a + k], k)[0] >> np.uint64(32)) for a in range(len(p) - k + 1)]
        out = set()
        for a in range(max(1, len(grams) - w + 1)):
            least = min(grams[a : a + w])
            out.add((max(a + x for x, g in enumerate(grams[a : a + w]) if g == least), least))
        return sorted(out)

    rng = random.Random(2)
    texts = ["".join(rng.choices("ab é", k=n)) for n in (0, 1, 2, 5, 8, 9, 12, 50, 100, 0, 3)] + ["a" * 30]
    for k, w in ((1, 1), (2, 1), (3, 4), (5, 5), (4, 7), (8, 16)):
        values, places, at = winnowing.winnow(*arrays.code_points(*arrays.flat(pa.array(texts, pa.large_string()))), k, w)
        got = [list(zip(places[a:b].tolist(), values[a:b].tolist())) for a, b in zip(at, at[1:])]
        assert got == [brute(t, k, w) for t in texts]


def test_next_document_and_edits(spark, odd, none, documents):
    frame = documents.select("doc_id", "text")
    docs = sorted(((r.doc_id, r.text) for r in frame.collect()), reverse=True)
    for rows in (7, 10_000):
        got = {r.doc_id: r for r in winnowing.compare_with_next(frame.repartition(3), range_rows=rows).collect()}
        assert len(got) == len(docs)
        for (i, own), (_, after) in zip(docs, docs[1:] + docs[:1]):
            half = len(own) // 2
            edited = own[: len(own) - half] + after[:half]
            assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(own)
            assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert winnowing.compare_with_next(odd, range_rows=2).count() == odd.count()
    assert winnowing.compare_with_next(none).count() == 0
    assert winnowing.compare_with_next(odd.filter("doc_id = 3")).first().near_next == 1
    prints = {(r.text or "", str(r.hashes)) for r in winnowing.fingerprint(odd).collect()}
    assert len(prints) == odd.select("text").na.fill("").distinct().count()


def test_short_texts_share_hashes_with_their_kept_halves(spark):
    rng = random.Random(3)
    docs = [(i, "".join(rng.choices("abcdefghij klmnop", k=30 + i))) for i in range(120)]
    got = winnowing.compare_with_next(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(got) == 120 and all(0 < r.near_edited < 1 for r in got)
    # a passage of K + WINDOW - 1 characters in otherwise different texts
    passage = "".join(rng.choices("abcdefghij", k=winnowing.K + winnowing.WINDOW - 1))
    texts = ["".join(rng.choices(letters, k=40)) + passage + "".join(rng.choices(letters, k=40)) for letters in ("qrstu", "vwxyz")]
    assert len(passage) == 15
    (a, b) = (set(r.hashes) for r in winnowing.fingerprint(spark.createDataFrame([(t,) for t in texts], "text string")).collect())
    assert a & b
