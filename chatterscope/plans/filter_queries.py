"""Registered queries: list filters, projections, time buckets, tracked words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.functions import text as T
from chatterscope.functions import time as TM
from chatterscope.operators import filters
from chatterscope.plans import fixtures as X
from chatterscope.plans.catalog import Catalog
from chatterscope.sources import lists

CATALOG = Catalog()
query = CATALOG.query

# The white list: sources in the order of their first document; the black list: sources whose
# name ends in 3 or 7 - they overlap on purpose.
LISTS = """ranked AS (SELECT upper(source) AS name, min(doc_id) AS pos FROM documents GROUP BY source),
white AS (SELECT lower(name) AS name FROM ranked ORDER BY pos LIMIT 12),
black AS (SELECT DISTINCT lower(source) AS name FROM documents
          WHERE source LIKE '%3' OR source LIKE '%7')"""
COMMENT_ROW = "id, community, month"


def white_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = X.table(spark, sf_dir, "documents")
    ranked = docs.groupBy(F.upper("source").alias("name")).agg(F.min("doc_id").alias("pos"))
    return lists.whitelist_top_k(ranked, 12)


def black_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = X.table(spark, sf_dir, "documents").select(F.col("source").alias("name"))
    return docs.where(F.col("name").endswith("3") | F.col("name").endswith("7")).distinct()


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.comments(spark, sf_dir).select("id", "community", "month")


@query(
    f"WITH {X.COMMENTS}, {LISTS} SELECT {COMMENT_ROW} FROM comments "
    "WHERE lower(community) IN (SELECT name FROM white)"
)
def filter_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_whitelist(_rows(spark, sf_dir), white_list(spark, sf_dir))


@query(
    f"WITH {X.COMMENTS}, {LISTS} SELECT {COMMENT_ROW} FROM comments "
    "WHERE lower(community) NOT IN (SELECT name FROM black)"
)
def filter_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_blacklist(_rows(spark, sf_dir), black_list(spark, sf_dir))


@query(
    f"WITH {X.COMMENTS}, {LISTS} SELECT {COMMENT_ROW} FROM comments "
    "WHERE lower(community) IN (SELECT name FROM white) "
    "AND lower(community) NOT IN (SELECT name FROM black)"
)
def semi_anti_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.semi_anti_lists(
        _rows(spark, sf_dir), white_list(spark, sf_dir), black_list(spark, sf_dir)
    )


@query(f"WITH {LISTS} SELECT name, pos FROM ranked ORDER BY pos LIMIT 12")
def whitelist_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return white_list(spark, sf_dir)


ACTIVITY = """activity AS (
SELECT CASE o_custkey % 100 WHEN 0 THEN '[deleted]' WHEN 1 THEN 'AutoModerator'
            WHEN 2 THEN NULL ELSE 'c' || o_custkey END AS author,
       CASE p_brand WHEN 'Brand#1' THEN 'AskReddit' WHEN 'Brand#2' THEN 'reddit.com'
            ELSE p_brand END AS community, year(o_orderdate) AS year
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """author, community, year: customers that buy a brand, with system accounts mixed in."""
    lines = X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = X.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    bought = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    slot = F.col("o_custkey") % 100
    return bought.select(
        F.when(slot == 0, "[deleted]")
        .when(slot == 1, "AutoModerator")
        .when(slot != 2, F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
        .alias("author"),
        F.when(F.col("p_brand") == "Brand#1", "AskReddit")
        .when(F.col("p_brand") == "Brand#2", "reddit.com")
        .otherwise(F.col("p_brand"))
        .alias("community"),
        F.year("o_orderdate").cast("bigint").alias("year"),
    )


@query(
    f"WITH {ACTIVITY} SELECT author, community, year, count(*) AS comments FROM activity "
    "WHERE author <> '[deleted]' AND author <> 'AutoModerator' "
    "AND community <> 'AskReddit' AND community <> 'reddit.com' GROUP BY ALL"
)
def filter_system_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.filter_system_accounts(activity(spark, sf_dir))
    return kept.groupBy("author", "community", "year").agg(
        F.count(F.lit(1)).alias("comments")
    )


@query(f"WITH {X.COMMENTS} SELECT body, created_utc, community FROM comments")
def project_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.comments(spark, sf_dir).select("body", "created_utc", "community")


@query(
    f"""WITH {X.COMMENTS},
e AS (SELECT make_timestamp(CAST(created_utc AS BIGINT) * 1000000) AS ts FROM comments
      UNION ALL SELECT date_trunc('second', ts) FROM events)
SELECT CAST(date_trunc('month', ts) AS DATE) AS month,
       CAST(date_trunc('week', ts) AS DATE) + 6 AS week, CAST(ts AS DATE) AS day, count(*) AS cnt
FROM e GROUP BY ALL"""
)
def bucket_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments and events per day with the week and month they fall into."""
    comments = X.comments(spark, sf_dir).select("created_utc")
    events = X.table(spark, sf_dir, "events").select(
        TM.epoch_seconds(F.col("ts")).cast("string").alias("created_utc")
    )
    stamped = comments.unionByName(events)
    return stamped.groupBy(
        *[TM.bucket_time(F.col("created_utc"), g).alias(g) for g in ("month", "week", "day")]
    ).agg(F.count(F.lit(1)).alias("cnt"))


TRACKED = ("the", "and", "that", "url", "der", "with")


@query(
    f"""WITH m AS (SELECT doc_id, lang, text,
  regexp_extract_all(lower(text), {X.PLAIN_TOKEN_SQL}) AS toks FROM documents)
SELECT doc_id, lang, text FROM m
WHERE lang = 'en' AND list_has_any(toks, [{', '.join(X.sql_text(t) for t in TRACKED)}])"""
)
def filter_track_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = X.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return filters.filter_track_terms(messages, TRACKED)


@query(
    f"""WITH t AS (SELECT item_id, regexp_extract_all(lower(text), {X.PLAIN_TOKEN_SQL}) AS toks FROM benchmark),
terms AS (SELECT DISTINCT list_distinct([toks[1], toks[3]]) AS words FROM t WHERE len(toks) > 2 AND trim(toks[1]) <> '' AND trim(toks[3]) <> ''),
m AS (SELECT doc_id, lang, text, regexp_extract_all(lower(text), {X.PLAIN_TOKEN_SQL}) AS toks FROM documents WHERE lang = 'en')
SELECT doc_id, lang, text FROM m WHERE EXISTS (SELECT 1 FROM terms WHERE list_has_all(m.toks, terms.words))"""
)
def filter_many_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the first and third token of a benchmark item in any place."""
    toks = T.tokenize(F.lower("text")).alias("toks")
    items = X.table(spark, sf_dir, "benchmark").select(toks).where(F.size("toks") > 2)
    words = items.select(F.col("toks")[0].alias("a"), F.col("toks")[2].alias("b"))
    words = words.where((F.trim("a") != "") & (F.trim("b") != ""))
    # as tokens, for a run of tabs or line ends is one too
    terms = words.select(F.array("a", "b").alias("words"))
    messages = X.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return filters.filter_many_terms(messages, terms)
