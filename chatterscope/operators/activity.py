"""Daily statistics, author activity and memberships."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope import constants as C
from chatterscope.functions import time as TM
from chatterscope.operators.filters import filter_system_accounts


METRICS = ("comments", "authors", "communities")


def daily_stats(comments: DataFrame, approximate: bool = False) -> DataFrame:
    """Per day: distinct communities, comments, distinct authors.

    Distinct values are deduplicated by (day, value) before the day is summed up, so one busy day
    is spread over all tasks; ``approximate`` uses sketches instead.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return comments.groupBy(TM.epoch_day(F.col("created_utc")).alias("date")).agg(
        distinct("community").alias("communities"),
        F.count(F.lit(1)).alias("comments"),
        distinct("author").alias("authors"),
    )


def daily_rows(stats: DataFrame) -> DataFrame:
    """Daily statistics with the year that partitions their table."""
    return stats.withColumn("year", F.year("date"))


def author_activity(comments: DataFrame, *also: str) -> DataFrame:
    """Comments per author and community, without system accounts."""
    return (
        filter_system_accounts(comments)
        .groupBy(*also, "author", "community")
        .agg(F.count(F.lit(1)).alias("comments"))
    )


def active_memberships(activity: DataFrame, more_than: int = C.ACTIVE_COMMENTS) -> DataFrame:
    return activity.where(F.col("comments") > more_than)


def multi_community_authors(members: DataFrame, *also: str) -> DataFrame:
    """Authors that are active in more than one community."""
    return (
        members.groupBy(*also, "author")
        .agg(F.count(F.lit(1)).alias("communities"))
        .where(F.col("communities") > 1)
    )


def stats_series(stats: DataFrame) -> DataFrame:
    """Daily statistics as rows (metric, ts_ms, value), in time order."""
    return (
        stats.select(TM.epoch_millis(F.col("date")).alias("ts_ms"), *METRICS)
        .unpivot("ts_ms", list(METRICS), "metric", "value")
        .select("metric", "ts_ms", "value")
        .orderBy("ts_ms", "metric")
    )


def export_series_json(series: DataFrame) -> DataFrame:
    """One JSON document ``[[ts_ms, value], ...]`` per metric, sorted by time.

    A document has one pair per day, so it is bounded by the calendar, not by the comments.
    """
    pairs = F.array_sort(F.collect_list(F.array("ts_ms", "value")))
    return series.groupBy("metric").agg(F.to_json(pairs).alias("document"))
