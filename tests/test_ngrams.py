"""Phrase counting, pruning and totals, against plain Python."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from chatterscope.functions import text as T
from chatterscope.functions import time as TM
from chatterscope.operators import ngrams as N


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_windows_bridge_commas_but_not_stop_words_or_sentences(spark):
    text = "Big cats, small dogs the red fox jumped. Blue birds sing"
    comments = spark.createDataFrame([(text,)], "body string")
    got = {(r.n, r.ngram) for r in N.phrases(comments, []).collect()}
    assert (2, "cats small") in got and (3, "big cats small") in got
    assert (2, "dogs red") not in got and (2, "jumped blue") not in got
    assert (2, "red fox") in got and (3, "red fox jumped") in got
    assert (3, "blue birds sing") in got


def brute(tokens, stop, n):
    kept, out = [[]], []
    for token in tokens:
        if token == T.BREAK:
            kept.append([])
        else:
            kept[-1].append(token)
    for sentence in kept:
        for i in range(len(sentence) - n + 1):
            window = sentence[i : i + n]
            if not set(window) & stop and (n > 1 or len(window[0]) > 1):
                out.append(" ".join(window))
    return out


def test_counts_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("text").alias("body"))
    tokens = docs.select(
        T.strip_punctuation(T.sentence_tokens(T.normalize_text(F.col("body")))).alias("t")
    )
    stop, expected = set(T.stopword_set()), Counter()
    for row in tokens.collect():
        for n in N.NS:
            expected.update((n, g) for g in brute(row.t, stop, n))
    counts = N.count_phrases(N.phrases(docs, []), [])
    assert {(r.n, r.ngram): r.cnt for r in counts.collect()} == dict(expected)


def counted(spark, rows):
    return spark.createDataFrame(rows, "bucket string, community string, n int, ngram string, cnt bigint")


def test_pruning_is_strict_at_the_default_floors(spark):
    rows = [("m", "c", 1, "w20", 20), ("m", "c", 1, "w21", 21), ("m", "c", 2, "p 3", 3), ("m", "c", 3, "p q 4", 4)]
    kept = rows_of(N.above_floor(counted(spark, rows)), "ngram")
    assert kept == [("p q 4",), ("w21",)]


def test_adaptive_threshold_truncates(spark):
    rows = [("m", "c", 2, "big", 99_999_900), ("m", "c", 2, "at", 5), ("m", "c", 2, "under", 4)]
    rows += [("m", "c", 2, "fill", 91)]
    kept = rows_of(N.prune_adaptive(counted(spark, rows)), "ngram")
    # total 100,000,000: threshold int(5e-8 * total) = 5, strict
    assert kept == [("big",), ("fill",)]


def test_totals_are_taken_before_pruning(spark):
    rows = [("a", "c", 1, "x", 30), ("a", "d", 1, "y", 5), ("b", "c", 1, "x", 25), ("b", "c", 2, "x y", 2)]
    got = rows_of(N.community_table(counted(spark, rows)), "bucket", "ngram", "cnt", "total")
    assert got == [("a", "x", 30, 35), ("b", "x", 25, 25)]


def test_counters_add_only_surviving_buckets(spark):
    rows = [("a", "c", 1, "x", 30), ("b", "c", 1, "x", 10), ("d", "c", 1, "x", 40), ("d", "e", 1, "y", 60)]
    got = rows_of(N.community_counters(counted(spark, rows)), "community", "ngram", "wcount", "total")
    assert got == [("c", "x", 70, 130), ("e", "y", 60, 100)]
    rolled = rows_of(N.community_rollup(counted(spark, rows)), "community", "ngram", "cnt", "total")
    assert rolled == [("c", "x", 80, 140), ("e", "y", 60, 140)]


def test_null_bucket_keeps_its_total(spark):
    got = N.community_table(counted(spark, [(None, "c", 1, "x", 30)])).first()
    assert got.total == 30


def test_a_hot_phrase_and_community(spark):
    comments = spark.range(0, 3000, 1, 8).select(
        F.lit("m").alias("bucket"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("community"),
        F.lit("words appear daily").alias("body"),
    )
    counts = N.count_phrases(N.phrases(comments, ["bucket", "community"]), ["bucket", "community"])
    hot = counts.where("community = 'hot' AND ngram = 'words appear'").first()
    assert hot.cnt == 1000
    assert counts.where("ngram = 'words appear'").agg(F.sum("cnt")).first()[0] == 3000


def test_buckets(spark):
    days = [dt.date(2014, 12, 29) + dt.timedelta(d) for d in range(400)]
    epoch = dt.date(1970, 1, 1)
    rows = [(str((d - epoch).days * 86400 + 86399),) for d in days]
    df = spark.createDataFrame(rows, "e string").select(
        *[TM.bucket_time(F.col("e"), g).alias(g) for g in TM.GRAINS],
        TM.parse_epoch(F.col("e")).alias("text"),
        TM.epoch_millis(TM.epoch_day(F.col("e"))).alias("ms"),
    )
    for d, r in zip(days, df.collect()):
        assert r.day == d and r.month == d.replace(day=1) and r.text == str(d)
        assert r.week == dt.datetime.strptime(d.strftime("%Y-%W") + "-0", "%Y-%W-%w").date()
        assert r.ms == (d - epoch).days * 86_400_000


def test_buckets_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("1420070400",)], "e string")
        assert df.select(TM.parse_epoch(F.col("e"))).first()[0] == "2015-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shuffled(spark):
    """Bytes that all stages so far have written for shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = store.stageList(None, False, False, none, spark._jvm.java.util.ArrayList())
    return sum(s.shuffleWriteBytes() for s in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(stages))


def test_phrases_that_cannot_be_frequent_are_not_shuffled(spark, sf_dir):
    from chatterscope.plans import fixtures as X

    comments = X.comments(spark, sf_dir)

    def bytes_of(df):
        before = shuffled(spark)
        df.count()
        return shuffled(spark) - before

    old = [bytes_of(N.count_phrases(N.phrases(comments, ["month"], ns), ["month"])) for ns in ([1], N.NS)]
    before = shuffled(spark)
    one = N.frequent_phrases(comments, ["month"], ["month"], True, ns=[1])
    one.count()
    middle = shuffled(spark)
    N.frequent_phrases(comments, ["month"], ["month"], True).count()
    new = [middle - before, shuffled(spark) - middle]
    assert 0 < (new[1] - new[0]) * 3 <= old[1] - old[0]


def test_frequent_phrases_with_any_filter_size(spark, sf_dir, monkeypatch):
    from chatterscope.plans import fixtures as X

    comments = X.comments(spark, sf_dir)
    cols = ["community", "n", "ngram", "cnt", "total"]
    counts = N.count_phrases(N.phrases(comments, ["community"]), ["community"])
    whole = rows_of(N.join_totals(N.above_floor(counts), N.totals(counts)), *cols)
    for words in (1, N.FILTER_WORDS):
        monkeypatch.setattr(N, "FILTER_WORDS", words)
        assert rows_of(N.frequent_phrases(comments, ["community"]), *cols) == whole
    only = [r for r in whole if r[1] == 2]
    assert rows_of(N.frequent_phrases(comments, ["community"], ns=[2]), *cols) == only
    assert N.frequent_phrases(comments.limit(0), ["community"]).count() == 0


def test_the_model_moves_phrases_across_sentence_ends(spark):
    from chatterscope.operators import boundary as B

    def model(ends):
        marks = [(word, mark) for word in ("cats", "dogs", "birds") for mark in ".?!" * 10]
        lines = [(i, f"the {w}{m}{chr(10) if m in ends else ' '}then more") for i, (w, m) in enumerate(marks)]
        lines += [(i, f"x{mark} more") for i, mark in enumerate(".?!" * 10)]
        return B.boundary_model_fit(B.candidates(spark.createDataFrame(lines, "id long, text string")))

    texts = [("big cats? small dogs. red birds, (green fish) blue",), (None,), ("",), ("mr.x don't stop",)]
    comments = spark.createDataFrame(texts, "body string")
    all_ends = {r.ngram for r in N.phrases(comments, [], [2], model=model(".?!")).collect()}
    no_dots = {r.ngram for r in N.phrases(comments, [], [2], model=model("?!")).collect()}
    assert {"big cats", "small dogs"} <= all_ends and "big cats" in no_dots
    assert "dogs. red" in no_dots and "small dogs." in no_dots
    assert not {g for g in all_ends if g.startswith(("dogs", "cats"))} and "cats small" not in no_dots
    fixed = {r.ngram for r in N.phrases(comments, [], [2]).collect()}
    assert "dogs red" not in fixed and "red birds" in fixed


def test_candidates_are_not_shuffled_by_the_word_before(spark, sf_dir):
    from chatterscope.operators import boundary as B
    from chatterscope.plans import fixtures as X

    docs = X.table(spark, sf_dir, "documents").selectExpr("doc_id AS id", "text")
    model = B.boundary_model_fit(B.candidates(docs))
    marked = B.mark_sentences(docs.withColumnRenamed("text", "normalized"), model)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(prevword" not in plan
    texts = {r.id: r.text for r in docs.collect()}
    for r in marked.collect():  # nothing but marks is changed
        assert len(r.normalized) == len(texts[r.id])
        assert all(a == b or (b in B.SCORED_MARKS and a == T.BREAK) for a, b in zip(r.normalized, texts[r.id], strict=True))


def test_asked_phrases_write_only_their_numbers(spark, sf_dir, monkeypatch):
    from chatterscope.plans import fixtures as X

    comments = X.comments(spark, sf_dir)
    written, write = [], N.cut_lineage
    monkeypatch.setattr(N, "cut_lineage", lambda df: written.append(df.columns) or write(df))
    terms = ["de", "la de", "a", "", "no such phrase", "la  de", "eriner thanea", "de"]
    counts, totals = N.asked_phrases(comments, ["month", "community"], ["month"], terms)
    assert len(written) == 1 and "words" not in written[0]
    whole = N.count_phrases(N.phrases(comments, ["month", "community"]), ["month", "community"])
    assert set(counts.collect()) == set(whole.where(F.col("ngram").isin(terms)).collect())
    assert set(totals.collect()) == set(N.totals(whole, ["month"]).collect())
    assert N.asked_phrases(comments, ["month"], ["month"], ["", "a"])[0].count() == 0


def test_pairs_are_counted_by_number_and_then_exactly(spark, sf_dir, monkeypatch):
    from chatterscope.plans import fixtures as X

    comments = X.comments(spark, sf_dir)
    cols = ["month", "n", "ngram", "cnt", "total"]
    counts = N.count_phrases(N.phrases(comments, ["month"]), ["month"])
    whole = rows_of(N.join_totals(N.above_floor(counts), N.totals(counts, ["month"]), ["month"]), *cols)
    written, write = [], N.cut_lineage
    monkeypatch.setattr(N, "cut_lineage", lambda df: written.append(df.columns) or write(df))
    assert rows_of(N.frequent_phrases(comments, ["month"], ["month"], True), *cols) == whole
    # words, totals, single words and their filter, pairs as hashes only and their filter, the result
    assert written[4] == ["hash"] and [c for c in written if "ngram" in c] == [written[2], written[6]] and len(written) == 7
    # phrases that share a hash are told apart in the end
    monkeypatch.setattr(N, "_hash", lambda first, last: F.xxhash64("key") if last - first > 1 else F.xxhash64("key", f"w{first}"))
    assert rows_of(N.frequent_phrases(comments, ["month"], ["month"], True), *cols) == whole


def test_filters_are_put_in_order_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "FILTER_BLOCK", 3)
    hashes = spark.range(1000).select(F.xxhash64("id").alias("hash"))
    filter_ = N._bits(hashes)
    assert filter_[1] == 256 and filter_[1] >> N.FILTER_BLOCK > 1
    assert hashes.where(N._holds(filter_, F.col("hash"))).count() == 1000
    others = spark.range(1000, 11000).where(N._holds(filter_, F.xxhash64("id"))).count()
    assert others < 1500


def shuffle_files(spark):
    """The blocks of shuffles that are on disk."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = [str(b) for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks)]
    return {name for name in names if "shuffle" in name}


def test_all_phrases_are_counted_in_rounds_that_leave_no_shuffle_files(spark, sf_dir, monkeypatch):
    from chatterscope import session
    from chatterscope.plans import fixtures as X

    comments = X.comments(spark, sf_dir)
    odd = [(None, "big cats big cats"), ("a", None), ("a", ""), ("b", "the of"), ("b", "lone")]
    rows = comments.selectExpr("community", "body").unionByName(spark.createDataFrame(odd, "community string, body string"))
    whole = sorted(N.count_phrases(N.phrases(rows, ["community"]), ["community"]).collect(), key=str)
    assert len(N.phrase_rounds(rows, ["community"])) == 1
    monkeypatch.setattr(session, "ROUND_ROWS", 10_000)
    before = shuffle_files(spark)
    parts = N.phrase_rounds(rows, ["community"])
    found = session.cut_rounds(parts)
    assert shuffle_files(spark) <= before
    assert 3 < len(parts) <= session.ROUNDS
    assert sorted(found.collect(), key=str) == whole
    assert max(part.count() for part in parts) < len(whole) / 2
    assert N.phrase_rounds(rows.limit(0), ["community"])[0].count() == 0


def test_the_model_is_applied_in_rounds(spark, sf_dir, monkeypatch):
    from chatterscope import session
    from chatterscope.operators import boundary as B
    from chatterscope.plans import fixtures as X

    docs = X.table(spark, sf_dir, "documents").selectExpr("doc_id AS id", "text")
    texts = docs.withColumnRenamed("text", "normalized").repartition(5).unionByName(
        spark.createDataFrame([(-1, None), (-2, ""), (-3, "no mark")], "id long, normalized string")
    )
    model = session.cut_lineage(B.boundary_model_fit(B.candidates(docs)))
    whole = sorted(B.mark_sentences(texts, model).collect())
    assert any(T.BREAK in (r.normalized or "") for r in whole)
    written, write = [], B.cut_rounds
    monkeypatch.setattr(B, "cut_rounds", lambda parts: written.append(len(parts)) or write(parts))
    monkeypatch.setattr(session, "ROUND_ROWS", 20_000)
    assert sorted(B.mark_sentences(texts, model).collect()) == whole
    assert written[0] > 1


def test_phrases_by_model_shuffles_its_counts_in_rounds(spark, sf_dir, monkeypatch):
    from chatterscope import session
    from chatterscope.plans import registry

    query = registry.queries()["phrases_by_model"]
    whole = set(query(spark, sf_dir).collect())
    monkeypatch.setattr(session, "ROUND_ROWS", 10_000, raising=False)
    found = query(spark, sf_dir)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert set(found.collect()) == whole
