"""Jobs end to end on comment files, run twice."""

import pytest
from pyspark.sql import functions as F

from chatterscope.__main__ import parser
from chatterscope.operators import trends as TR
from chatterscope.plans import jobs
from chatterscope.session import fresh_path
from chatterscope.sources import tables
from chatterscope.streaming import pages as SP


def corpus(spark):
    root = fresh_path(spark, "corpus")
    for month, start in (("2014-12", 1417392000), ("2015-01", 1420070400)):
        rows = spark.range(0, 1200).select(
            F.concat(F.lit("u"), F.col("id") % 10).alias("author"),
            F.format_string("green tea leaves number %d", F.col("id")).alias("body"),
            (F.lit(start) + F.col("id") * 600).cast("string").alias("created_utc"),
            F.when(F.col("id") % 20 < 10, "Tea").otherwise("coffee").alias("subreddit"),
        )
        rows.write.json(f"{root}/{month[:4]}/RC_{month}")
    return root


def test_phrase_jobs(spark):
    source, monthly, community = corpus(spark), fresh_path(spark, "m"), fresh_path(spark, "c")
    names = fresh_path(spark, "names")
    spark.createDataFrame([("tea",), ("COFFEE",), ("none",)], "v string").coalesce(1).write.text(names)
    for _ in range(2):
        jobs.monthly_phrases(spark, source, monthly, white=names, first=1)
        jobs.community_phrases(spark, source, community)
    table = jobs.read_monthly_phrases(spark, monthly)
    row = table.where("ngram = 'green tea leaves'").orderBy("month").collect()
    assert [(str(r.month), r.cnt, r.total) for r in row] == [
        ("2014-12-01", 600, 1800),
        ("2015-01-01", 600, 1800),
    ]
    counters = jobs.read_community_counters(spark, community)
    top = TR.top_communities(counters, ["green tea"]).orderBy("rank").collect()
    assert [(r.community, r.wcount) for r in top] == [("Tea", 1200), ("coffee", 1200)]
    label = TR.compare_ngrams("Green Tea", table, counters).select("label").distinct().collect()
    assert [r.label for r in label] == ["green tea::Tea"]


def test_daily_jobs(spark):
    source, phrases, stats = corpus(spark), fresh_path(spark, "d"), fresh_path(spark, "s")
    for _ in range(2):
        jobs.daily_phrases(spark, source, phrases)
        jobs.daily_statistics(spark, source, stats)
    days = jobs.read_daily_statistics(spark, stats)
    assert days.agg(F.sum("comments")).first()[0] == 2400
    first = days.orderBy("date").first()
    assert (first.year, first.comments, first.authors, first.communities) == (2014, 144, 10, 2)
    table = jobs.read_daily_phrases(spark, phrases)
    assert table.where("ngram = 'green tea'").agg(F.sum("cnt")).first()[0] == 2400


def straddling(spark):
    """A January file with days of January, a February file with one comment of 31 January."""
    root = fresh_path(spark, "corpus")
    for month, start, n in (("2015-01", 1422576000, 150), ("2015-02", 1422748799, 1)):
        rows = spark.range(0, n).select(
            F.concat(F.lit("u"), F.col("id") % 10).alias("author"),
            F.lit("green tea leaves").alias("body"),
            (F.lit(start) + F.col("id") * 60).cast("string").alias("created_utc"),
            F.lit("Tea").alias("subreddit"),
        )
        rows.write.json(f"{root}/{month[:4]}/RC_{month}")
    return root


def test_files_that_share_days(spark):
    source = straddling(spark)
    month = lambda m: f"{source}/2015/RC_2015-{m}"
    states = []
    for runs in ([source], [month("01"), month("02"), month("02")], [month("02"), month("01")]):
        daily, stats, weekly = (fresh_path(spark, n) for n in ("d", "s", "w"))
        for path in runs:
            jobs.daily_phrases(spark, path, daily)
            jobs.daily_statistics(spark, path, stats)
            jobs.community_phrases(spark, path, weekly, grain="week")
        states.append(
            [
                sorted(map(tuple, jobs.read_daily_statistics(spark, stats).collect())),
                sorted(map(tuple, jobs.read_daily_phrases(spark, daily).collect())),
                sorted(map(tuple, jobs.read_community_phrases(spark, weekly).collect())),
            ]
        )
    assert states[0] == states[1] == states[2]
    assert sum(r[2] for r in states[0][0]) == 151


def test_a_broken_line_stops_a_job(spark):
    root = fresh_path(spark, "corpus")
    spark.createDataFrame([("{broken",)], "v string").write.text(f"{root}/2015/RC_2015-01")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        jobs.daily_statistics(spark, root, fresh_path(spark, "s"))

def test_graph_job(spark):
    source, out = corpus(spark), fresh_path(spark, "g")
    for _ in range(2):
        jobs.author_graph(spark, source, out)
    edges = spark.read.parquet(f"{out}/edges").orderBy("year").collect()
    assert [(r.year, r.src, r.dst, r.weight) for r in edges] == [
        (2014, "coffee", "Tea", 10),
        (2015, "coffee", "Tea", 10),
    ]
    nodes = spark.read.parquet(f"{out}/nodes").where("year = 2015").collect()
    assert {r.node for r in nodes} == {"Tea", "coffee"}
    document = fresh_path(spark, "x")
    jobs.graph_file(spark, out, document, 2015)
    assert "modularity_class" in "".join(r.value for r in spark.read.text(document).collect())


def test_search_job(spark):
    docs, out = fresh_path(spark, "docs"), fresh_path(spark, "index")
    rows = [(1, "Tea", "green tea leaves"), (2, "Cup", "a cup of tea"), (3, "None", "")]
    spark.createDataFrame(rows, "id bigint, title string, text string").write.parquet(docs)
    jobs.search_index(spark, docs, out)
    assert [r.title for r in jobs.search(spark, out, "green tea").collect()] == ["Tea", "Cup"]


def test_page_job(spark):
    source, out = fresh_path(spark, "pages"), fresh_path(spark, "out")
    for title, link in (("A", "b"), ("B", "a")):
        page = f"<page><title>{title}</title><revision><text>[[{link}]]</text></revision></page>"
        spark.createDataFrame([(page,)], "v string").write.mode("append").text(source)
        jobs.page_backlinks(spark, source, out)
    table = tables.collect_backlinks(SP.backlinks(spark, f"{out}/backlinks"))
    assert {r.title: r.referredby for r in table.collect()} == {"a": ["b"], "b": ["a"]}
    assert SP.indexed(spark, f"{out}/index").count() == 2


def test_command_line():
    assert parser().parse_args(["monthly-phrases", "--source", "a", "--out", "b", "--first", "7"]).first == 7
    options = parser().parse_args(["author-graph", "--source", "a", "--out", "b", "--rounds", "3"])
    assert (options.job, options.rounds, options.hub_degree) == ("author-graph", 3, 100)


def test_jobs_of_a_period_replace_only_its_months(spark):
    source, out = corpus(spark), fresh_path(spark, "period")
    jobs.daily_statistics(spark, source, out)
    jobs.daily_statistics(spark, source, out, period="2015-01")
    assert jobs.read_daily_statistics(spark, out).agg(F.sum("comments")).first()[0] == 2400
    only = fresh_path(spark, "period")
    jobs.daily_statistics(spark, source, only, period="2014")
    assert {r.year for r in jobs.read_daily_statistics(spark, only).select("year").distinct().collect()} == {2014}
    monthly = fresh_path(spark, "period")
    jobs.monthly_phrases(spark, source, monthly, period="2015-01")
    assert {str(r.month) for r in jobs.read_monthly_phrases(spark, monthly).collect()} == {"2015-01-01"}
    with pytest.raises(ValueError):
        jobs.author_graph(spark, source, fresh_path(spark, "period"), period="2015-01")


def test_daily_documents(spark):
    import json

    stats, out = fresh_path(spark, "s"), fresh_path(spark, "json")
    jobs.daily_statistics(spark, corpus(spark), stats)
    for _ in range(2):
        jobs.daily_documents(spark, stats, out)
    documents = {r.metric: json.loads(r.value) for r in spark.read.text(out).collect()}
    assert set(documents) == {"comments", "authors", "communities"}
    assert sum(v for _, v in documents["comments"]) == 2400
    assert [t for t, _ in documents["comments"]] == sorted(t for t, _ in documents["comments"])


def test_message_and_follower_jobs(spark):
    first, second, out = (fresh_path(spark, n) for n in ("tweets", "tweets", "messages"))
    spark.createDataFrame([("1", "old"), ("2", "two"), (None, "no id")], "id_str string, text string").write.json(first)
    spark.createDataFrame([("1", "new")], "id_str string, text string").write.json(second)
    for batch, source in ((0, first), (1, second), (1, second), (0, first)):
        jobs.message_table(spark, source, out, batch)
    assert {r.id: r.text for r in jobs.read_messages(spark, out).collect()} == {"1": "new", "2": "two"}
    lists, walk = fresh_path(spark, "followers"), fresh_path(spark, "walk")
    spark.createDataFrame([(1, [2, 3]), (2, [4]), (4, [5])], "parent bigint, follower array<bigint>").write.json(lists)
    jobs.follower_walk(spark, lists, walk, 1, 2)
    assert {r.account: r.hop for r in spark.read.parquet(walk).collect()} == {1: 0, 2: 1, 3: 1, 4: 2}
    options = vars(parser().parse_args(["follower-walk", "--source", "a", "--out", "b", "--account", "1", "--influential", "yes"]))
    assert options["influential"] is True and options["account"] == 1 and options["hops"] == 2
