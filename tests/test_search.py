"""Search and sentence-end model against plain Python."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from chatterscope.operators import boundary as BD
from chatterscope.operators import search as S
from chatterscope.session import fresh_path


def docs_of(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("id"), "text"
    )


def bm25(texts, terms):
    words = {i: re.findall(r"\w+", t.lower()) for i, t in texts.items()}
    avg = sum(map(len, words.values())) / len(words)
    scores = Counter()
    for term in terms:
        found = {i: w.count(term) for i, w in words.items() if term in w}
        idf = math.log(1 + (len(words) - len(found) + 0.5) / (len(found) + 0.5))
        for i, tf in found.items():
            scores[i] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words[i]) / avg))
    return scores


def test_scores_equal_brute_force(spark, sf_dir):
    docs = docs_of(spark, sf_dir)
    expected = bm25({r.id: r.text for r in docs.collect()}, ["the", "reading", "of"])
    best = sorted(expected.items(), key=lambda x: (-round(x[1], 9), x[0]))[:80]
    got = S.text_match(S.postings(docs), S.corpus_stats(docs), "The reading, of the").collect()
    assert [r.id for r in got] == [i for i, _ in best]
    assert all(abs(r.score - s) < 1e-8 for r, (_, s) in zip(got, best))


def test_stored_index_gives_the_same_hits(spark, sf_dir):
    docs, path = docs_of(spark, sf_dir), fresh_path(spark, "postings")
    S.write_postings(S.postings(docs), path, 4)
    stats = S.corpus_stats(docs)
    direct = S.text_match(S.postings(docs), stats, ["der", "und"], 10).collect()
    stored = S.text_match(spark.read.parquet(path), stats, ["der", "und"], 10).collect()
    assert direct == stored and len(direct) == 10


def test_no_hit(spark):
    docs = spark.createDataFrame([(1, "one two")], "id bigint, text string")
    assert S.text_match(S.postings(docs), S.corpus_stats(docs), "three").collect() == []


TEXT = "Stop here. Mr. Smith left?\nNo! J. won. (Yes?)\nDone."


def test_candidates(spark):
    df = spark.createDataFrame([(1, TEXT)], "id bigint, text string")
    rows = [
        (r.prevword, r.punct, r.next_cap, r.one_char, r.ends_line)
        for r in BD.candidates(df).orderBy("pos").collect()
    ]
    assert rows == [
        ("here", ".", "true", "false", False),
        ("mr", ".", "true", "false", False),
        ("left", "?", "true", "false", True),
        ("no", "!", "true", "false", False),
        ("j", ".", "false", "true", False),
        ("won", ".", "false", "false", False),
        ("yes", "?", "false", "false", False),
        ("done", ".", "false", "false", False),
    ]


def test_model_equals_brute_force(spark, sf_dir):
    docs = docs_of(spark, sf_dir)
    found = BD.candidates(docs)
    rows = [r.asDict() for r in found.collect()]
    labels = Counter(r["ends_line"] for r in rows)
    counts = {f: Counter((r[f], r["ends_line"]) for r in rows) for f in BD.FEATURES}
    bins = {f: len({r[f] for r in rows}) for f in BD.FEATURES}

    def score(row, label):
        total = math.log2((labels[label] + 0.5) / (len(rows) + 1))
        for f in BD.FEATURES:
            total += math.log2((counts[f][row[f], label] + 0.5) / (labels[label] + 0.5 * bins[f]))
        return total

    model = BD.boundary_model_fit(found)
    scored = BD.boundary_model_score(BD.candidates(docs, BD.SCORED_MARKS), model).collect()
    assert len(scored) > len(rows)
    for r in scored:
        row = r.asDict()
        assert abs(r.true_log - score(row, True)) < 1e-9
        assert abs(r.false_log - score(row, False)) < 1e-9
        assert r.boundary == (r.true_log > r.false_log)
