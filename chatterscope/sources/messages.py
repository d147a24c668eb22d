"""Short messages and follower lists, as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.sources.comments import scan_json_lines

# Message fields.
TWEET_SCHEMA = (
    "id_str STRING, text STRING, lang STRING, "
    "user STRUCT<id_str: STRING, screen_name: STRING, followers_count: BIGINT>, "
    "retweeted_status STRUCT<id_str: STRING>"
)
FOLLOWER_SCHEMA = "parent BIGINT, follower ARRAY<BIGINT>"


def scan_tweets(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Message archive; gzip files are read as they are."""
    return scan_json_lines(spark, path, TWEET_SCHEMA)


def project_tweet(tweets: DataFrame) -> DataFrame:
    """id, text, user, retweeted, retweet_id (its own id when it is no retweet)."""
    return tweets.select(
        F.col("id_str").alias("id"),
        "text",
        "user",
        F.col("retweeted_status").isNotNull().alias("retweeted"),
        F.coalesce("retweeted_status.id_str", "id_str").alias("retweet_id"),
    )


def scan_followers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return scan_json_lines(spark, path, FOLLOWER_SCHEMA)


def explode_followers(messages: DataFrame) -> DataFrame:
    """Distinct (follower, parent) edges of follower messages."""
    return messages.select(F.explode("follower").alias("follower"), "parent").distinct()
