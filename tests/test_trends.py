"""Spine, series, top communities, comparison."""

import datetime as dt

from chatterscope.operators import trends as TR

MONTHLY = "month date, community string, ngram string, n int, cnt bigint, total bigint, percentage double"
COUNTERS = "community string, n int, ngram string, wcount bigint, total bigint"


def day(y, m):
    return dt.date(y, m, 1)


def tables(spark):
    monthly = spark.createDataFrame(
        [
            (day(2007, 10), "allsubreddit", "obama", 1, 30, 300, 0.1),
            (day(2015, 12), "allsubreddit", "obama", 1, 60, 300, 0.2),
            (day(2016, 1), "allsubreddit", "obama", 1, 99, 300, 0.3),
            (day(2008, 1), "allsubreddit", "orphan", 1, 40, 400, 0.1),
        ],
        MONTHLY,
    )
    rows = [(f"c{i}", 1, "obama", i % 4, 9) for i in range(8)] + [("c1", 1, "hidden", 5, 9)]
    return monthly, spark.createDataFrame(rows + [("c9", 2, "obama", 99, 9)], COUNTERS)


def test_spine(spark):
    months = [r.month for r in TR.month_spine(spark).orderBy("month").collect()]
    assert len(months) == 99 and months[0] == day(2007, 10) and months[-1] == day(2015, 12)


def test_series_is_zero_filled(spark):
    monthly, _ = tables(spark)
    rows = TR.ngram_timeseries(monthly, ["obama", "unknown"]).orderBy("month").collect()
    assert len(rows) == 99 and {r.ngram for r in rows} == {"obama"}
    assert (rows[0].cnt, rows[-1].cnt, sum(r.cnt for r in rows)) == (30, 60, 90)
    assert rows[1].percentage == 0.0


def test_a_key_outside_the_spine_gets_zeros(spark):
    series = spark.createDataFrame([("x", day(2020, 1), 5)], "k string, month date, v bigint")
    rows = TR.spine_left_join(series, ["k"], ["v"]).collect()
    assert len(rows) == 99 and sum(r.v for r in rows) == 0


def test_top_communities_break_ties_by_name_and_match_n(spark):
    _, counters = tables(spark)
    got = TR.top_communities(counters, ["obama"]).orderBy("rank").collect()
    assert [r.community for r in got] == ["c3", "c7", "c2", "c6", "c1"]


def test_compare(spark):
    monthly, counters = tables(spark)
    got = TR.compare_ngrams(" Obama ,orphan,hidden, obama", monthly, counters).collect()
    by_label = {}
    for r in got:
        by_label.setdefault(r.label, []).append(r.cnt)
    # known in both tables; without community; with community but without corpus-wide rows
    assert set(by_label) == {"obama::c3", "orphan"}
    assert (len(by_label["obama::c3"]), sum(by_label["obama::c3"])) == (99, 90)
    assert (len(by_label["orphan"]), sum(by_label["orphan"])) == (99, 0)
