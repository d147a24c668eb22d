"""Registered queries: scans of files that Spark first writes from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.plans import fixtures as X
from chatterscope.plans.catalog import Catalog
from chatterscope.session import fresh_path
from chatterscope.sources import comments as CM
from chatterscope.sources import lists, messages, tables

CATALOG = Catalog()
query = CATALOG.query


def _comment_lines(comments: DataFrame) -> DataFrame:
    """One JSON line per comment, each followed by an empty line."""
    record = F.to_json(
        F.struct(
            F.col("id").cast("string").alias("id"),
            "author",
            "body",
            "created_utc",
            F.col("community").alias("subreddit"),
            (F.col("id") % 100).alias("score"),
            (F.col("id") % 2 == 0).alias("archived"),
        )
    )
    return comments.select(F.explode(F.array(record, F.lit(""))).alias("value"))


@query(
    f"WITH {X.COMMENTS} SELECT CAST(id AS VARCHAR) AS id, author, body, created_utc, community "
    "FROM comments"
)
def scan_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "comment-lines")
    _comment_lines(X.comments(spark, sf_dir)).write.text(path)
    wanted = "id STRING, author STRING, body STRING, created_utc STRING, subreddit STRING"
    return CM.as_community_comments(CM.scan_json_lines(spark, path, wanted))


@query(
    f"WITH {X.COMMENTS} SELECT CAST(id AS VARCHAR) AS id, author, length(body) AS chars, "
    "created_utc, community AS subreddit, id % 100 AS score, id % 2 = 0 AS archived, "
    "CAST(NULL AS BIGINT) AS gilded FROM comments"
)
def scan_comments_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "typed-comments")
    _comment_lines(X.comments(spark, sf_dir)).write.text(path)
    return CM.scan_comments_typed(spark, path).select(
        "id",
        "author",
        F.length("body").cast("bigint").alias("chars"),
        "created_utc",
        "subreddit",
        "score",
        "archived",
        "gilded",
    )


@query(
    f"""WITH {X.COMMENTS},
k AS (SELECT id, CASE WHEN lang = 'de' THEN strftime(month, '%Y/')
                      WHEN lang = 'fr' THEN strftime(month, 'raw/%Y/RC_%Y-%m')
                      ELSE strftime(month, '%Y/RC_%Y-%m') END AS key FROM comments)
SELECT id, key, CAST(split_part(key, '/', 1) AS INTEGER) AS year,
       CAST(right(key, 2) AS INTEGER) AS month
FROM k WHERE right(key, 1) <> '/' AND len(string_split(key, '/')) = 2"""
)
def path_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.date_format("month", "yyyy/'RC_'yyyy-MM")
    keys = X.comments(spark, sf_dir).select(
        "id",
        F.when(F.col("lang") == "de", F.date_format("month", "yyyy/"))
        .when(F.col("lang") == "fr", F.concat(F.lit("raw/"), key))
        .otherwise(key)
        .alias("key"),
    )
    return CM.path_month(keys)


@query(
    f"WITH {X.COMMENTS} SELECT CAST(month(month) AS INTEGER) AS month, community, "
    "count(*) AS comments FROM comments WHERE year(month) = 2008 GROUP BY ALL"
)
def select_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments of a whole year from a table partitioned by year and month."""
    path = fresh_path(spark, "partitioned-comments")
    dated = X.comments(spark, sf_dir).withColumns(
        {"year": F.year("month"), "month": F.month("month")}
    )
    tables.write_partitioned(dated, path, ["year", "month"])
    chosen = CM.select_period(tables.read_batches(spark, path, dated.schema), 2008)
    return chosen.groupBy("month", "community").agg(F.count(F.lit(1)).alias("comments"))


@query("SELECT lower(lang || '_' || source) AS name FROM documents GROUP BY lang, source")
def scan_name_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "name-list")
    docs = X.table(spark, sf_dir, "documents")
    docs.select(F.upper(F.concat("lang", F.lit("_"), "source", F.lit("   ")))).distinct().write.text(path)
    return lists.scan_name_list(spark, path).select("name")


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as messages; later turns repeat the first one's id."""
    turns = X.table(spark, sf_dir, "conversations")
    first = F.concat(F.col("conv_id").cast("string"), F.lit("-0"))
    return turns.select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias(
            "id_str"
        ),
        "text",
        F.lit("en").alias("lang"),
        F.struct(
            F.col("conv_id").cast("string").alias("id_str"),
            F.col("role").alias("screen_name"),
            F.length("text").cast("bigint").alias("followers_count"),
        ).alias("user"),
        F.when(F.col("turn") > 0, F.struct(first.alias("id_str"))).alias("retweeted_status"),
    )


def _tweet_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tweets")
    tweets(spark, sf_dir).write.option("compression", "gzip").json(path)
    return messages.scan_tweets(spark, path)


@query(
    "SELECT conv_id || '-' || turn AS id_str, text, role AS screen_name, "
    "CASE WHEN turn > 0 THEN conv_id || '-0' END AS retweeted_id FROM conversations"
)
def scan_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tweet_archive(spark, sf_dir).select(
        "id_str",
        "text",
        "user.screen_name",
        F.col("retweeted_status.id_str").alias("retweeted_id"),
    )


@query(
    "SELECT conv_id || '-' || turn AS id, text, CAST(conv_id AS VARCHAR) AS user_id, "
    "turn > 0 AS retweeted, conv_id || '-0' AS retweet_id FROM conversations"
)
def project_tweet(spark: SparkSession, sf_dir: str) -> DataFrame:
    projected = messages.project_tweet(_tweet_archive(spark, sf_dir))
    return projected.withColumn("user_id", F.col("user.id_str")).drop("user")


def follower_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and the customers that buy from them, in messages of at most 1000 followers."""
    lines = X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    bought = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        bought.groupBy(
            F.col("l_suppkey").alias("parent"), F.floor(F.col("o_custkey") / 1000).alias("page")
        )
        .agg(F.collect_set("o_custkey").alias("follower"))
        .drop("page")
    )


def follower_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.explode_followers(follower_messages(spark, sf_dir))


FOLLOWERS = (
    "followers AS (SELECT DISTINCT o_custkey AS follower, l_suppkey AS parent "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)


@query(f"WITH {FOLLOWERS} SELECT * FROM followers")
def explode_followers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "followers")
    follower_messages(spark, sf_dir).write.json(path)
    return messages.explode_followers(messages.scan_followers(spark, path))


@query(
    r"""WITH l AS (SELECT source || '_' || doc_id || CASE WHEN lang = 'de' THEN ' x' ELSE '' END
       || ' ' || format('{:,}', n_chars) AS value FROM documents)
SELECT split_part(value, ' ', 1) AS name, CAST(replace(split_part(value, ' ', 2), ',', '') AS BIGINT) AS subscribers
FROM l WHERE len(string_split(value, ' ')) = 2"""
)
def clean_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = X.table(spark, sf_dir, "documents").select(
        F.concat(
            F.col("source"),
            F.lit("_"),
            F.col("doc_id").cast("string"),
            F.when(F.col("lang") == "de", " x").otherwise(""),
            F.lit(" "),
            F.format_number("n_chars", 0),
        ).alias("value")
    )
    return lists.clean_whitelist(lines)


@query(
    "SELECT lang || doc_id AS name FROM documents UNION ALL "
    "SELECT source || doc_id AS name FROM documents"
)
def clean_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id").cast("string")
    lines = X.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("/r/"), F.col("lang"), doc, F.lit(" /r/"), F.col("source"), doc).alias(
            "value"
        )
    )
    return lists.clean_blacklist(lines)
