"""Comment files: JSON lines under YYYY/RC_YYYY-MM keys, and tables partitioned by year, month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fields of a comment.  created_utc is text that holds epoch seconds.
COMMENT_SCHEMA = (
    "archived BOOLEAN, author STRING, author_flair_css_class STRING, body STRING, "
    "controversiality BIGINT, created_utc STRING, distinguished STRING, downs BIGINT, "
    "edited STRING, gilded BIGINT, id STRING, link_id STRING, name STRING, parent_id STRING, "
    "retrieved_on BIGINT, score BIGINT, score_hidden BOOLEAN, subreddit STRING, "
    "subreddit_id STRING, ups BIGINT"
)
MONTH_KEY = r"^(\d{4})/RC_(\d{4})-(\d{1,2})$"
MONTH_PATH = r"(\d{4})/RC_(\d{4})-(\d{1,2})(?:/[^/]*)?$"


def scan_json_lines(
    spark: SparkSession, path: str | list[str], schema: str, corrupt: str | None = None
) -> DataFrame:
    """JSON lines with the wanted fields only; empty lines are skipped.

    A broken line stops the job, unless ``corrupt`` names a column that shall hold such lines.
    """
    if corrupt is None:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(f"{schema}, {corrupt} STRING").option("columnNameOfCorruptRecord", corrupt).json(path)


def scan_comments_typed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The fixed comment schema, every field optional; also the view ``comments``.

    A broken line stops the job.
    """
    comments = scan_json_lines(spark, path, COMMENT_SCHEMA)
    comments.createOrReplaceTempView("comments")
    return comments


def as_community_comments(comments: DataFrame) -> DataFrame:
    """The columns that the operators use."""
    community = F.col("subreddit").alias("community")
    return comments.select("id", "author", "body", "created_utc", community)


def _month(path: Column, pattern: str) -> Column:
    return F.make_date(
        F.regexp_extract(path, pattern, 2).cast("int"),
        F.regexp_extract(path, pattern, 3).cast("int"),
        F.lit(1),
    )


def path_month(keys: DataFrame, key: str = "key") -> DataFrame:
    """Year and month of each file key; directory keys and keys of other depth are left out."""
    month = _month(F.col(key), MONTH_KEY)
    return keys.where(F.col(key).rlike(MONTH_KEY)).withColumns(
        {"year": F.year(month), "month": F.month(month)}
    )


def scan_month_files(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All comments below ``root`` with the month of the file they come from; a broken line stops the
    job."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    files = reader.option("recursiveFileLookup", "true").json(root)
    path = F.col("_metadata.file_path")
    return files.where(path.rlike(MONTH_PATH)).withColumn("month", _month(path, MONTH_PATH))


def file_months(spark: SparkSession, root: str) -> list[int]:
    """Months, as YYYYMM, of all files below ``root``, with or without comments."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = F.col("path")
    month = _month(path, MONTH_PATH)
    months = files.where(path.rlike(MONTH_PATH)).select((F.year(month) * 100 + F.month(month)).alias("m"))
    return sorted(r.m for r in months.distinct().collect())


def select_period(comments: DataFrame, year: int, month: int | None = None) -> DataFrame:
    """A whole year or one month; prunes partitions of a table partitioned by year and month."""
    chosen = comments.where(F.col("year") == year)
    return chosen if month is None else chosen.where(F.col("month") == month)
