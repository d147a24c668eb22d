"""Registered queries: epoch conversion, daily statistics, author activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.functions import time as TM
from chatterscope.operators import activity as A
from chatterscope.plans import fixtures as X
from chatterscope.plans.catalog import Catalog
from chatterscope.plans.filter_queries import ACTIVITY, activity

CATALOG = Catalog()
query = CATALOG.query

EVENTS = (
    "clicks AS (SELECT event_id, CAST(user_id AS VARCHAR) AS author, event_type AS community, "
    "ts FROM events)"
)
DAILY = f"""WITH {EVENTS},
daily AS (SELECT CAST(ts AS DATE) AS date, count(DISTINCT community) AS communities,
          count(*) AS comments, count(DISTINCT author) AS authors FROM clicks GROUP BY ALL)"""
ACTIVE = f"""WITH {ACTIVITY},
author_activity AS (SELECT author, community, count(*) AS comments FROM activity
  WHERE author NOT IN ('[deleted]', 'AutoModerator') AND community NOT IN ('AskReddit', 'reddit.com')
  GROUP BY ALL)"""


def events_as_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("author"),
        F.col("event_type").alias("community"),
        TM.epoch_seconds(F.col("ts")).cast("string").alias("created_utc"),
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events")
def parse_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_comments(spark, sf_dir).select(
        "event_id", TM.parse_epoch(F.col("created_utc")).alias("date")
    )


@query(
    "SELECT event_id, CAST(epoch_ms(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS BIGINT) AS ts_ms "
    "FROM events"
)
def epoch_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = TM.epoch_day(F.col("created_utc"))
    return events_as_comments(spark, sf_dir).select("event_id", TM.epoch_millis(day).alias("ts_ms"))


@query(f"{DAILY} SELECT * FROM daily")
def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.daily_stats(events_as_comments(spark, sf_dir))


@query(f"{ACTIVE} SELECT * FROM author_activity")
def author_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.author_activity(activity(spark, sf_dir))


@query(f"{ACTIVE} SELECT * FROM author_activity WHERE comments > 3")
def active_memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.active_memberships(A.author_activity(activity(spark, sf_dir)), more_than=3)


@query(
    f"{ACTIVE} SELECT author, count(*) AS communities FROM author_activity WHERE comments > 3 "
    "GROUP BY author HAVING count(*) > 1"
)
def multi_community_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.multi_community_authors(
        A.active_memberships(A.author_activity(activity(spark, sf_dir)), more_than=3)
    )


SERIES = f"""{DAILY}, series AS (
SELECT 'comments' AS metric, CAST(epoch_ms(CAST(date AS TIMESTAMP)) AS BIGINT) AS ts_ms, comments AS value FROM daily
UNION ALL SELECT 'authors', CAST(epoch_ms(CAST(date AS TIMESTAMP)) AS BIGINT), authors FROM daily
UNION ALL SELECT 'communities', CAST(epoch_ms(CAST(date AS TIMESTAMP)) AS BIGINT), communities FROM daily)"""


@query(f"{SERIES} SELECT * FROM series")
def stats_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.stats_series(A.daily_stats(events_as_comments(spark, sf_dir)))


@query(
    f"{SERIES} SELECT metric, '[' || string_agg('[' || ts_ms || ',' || value || ']', ',' "
    "ORDER BY ts_ms) || ']' AS document FROM series GROUP BY metric"
)
def export_series_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.export_series_json(A.stats_series(A.daily_stats(events_as_comments(spark, sf_dir))))
