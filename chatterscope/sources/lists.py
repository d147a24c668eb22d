"""Community lists: scanning, cleaning raw lists, first k names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_name_list(spark: SparkSession, path: str) -> DataFrame:
    """One name per line: name (right-trimmed, lower case) and pos, which sorts like the lines."""
    return spark.read.text(path).select(
        F.lower(F.rtrim("value")).alias("name"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("pos"),
    )


def whitelist_top_k(names: DataFrame, k: int) -> DataFrame:
    """The first k entries of an ordered list."""
    return names.orderBy("pos").limit(k)


def clean_whitelist(lines: DataFrame) -> DataFrame:
    """Lines ``name 1,234`` with exactly two parts to name and subscribers."""
    parts = lines.select(F.split(F.rtrim("value"), " ").alias("p")).where(F.size("p") == 2)
    return parts.select(
        F.col("p")[0].alias("name"),
        F.replace(F.col("p")[1], F.lit(",")).try_cast("bigint").alias("subscribers"),
    )


def clean_blacklist(lines: DataFrame) -> DataFrame:
    """Lines ``/r/a /r/b ...`` to one name per row."""
    links = lines.select(F.explode(F.split(F.rtrim("value"), " ")).alias("link"))
    return links.select(F.get(F.split("link", "/"), F.lit(2)).alias("name")).where(
        F.col("name").isNotNull()
    )
