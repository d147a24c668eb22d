"""Answers over the phrase tables: zero-filled series, top communities, comparison of phrases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatterscope import constants as C
from chatterscope.functions import time as TM


def _month(text: str) -> Column:
    return F.lit(text).cast("date")


def _months(start: str, end: str) -> Column:
    return F.sequence(_month(start), F.add_months(_month(end), -1), F.expr("interval 1 month"))


def month_spine(spark: SparkSession, start: str = C.FIRST_MONTH, end: str = C.END_MONTH):
    """One row per month; the end is exclusive."""
    return spark.range(1).select(F.explode(_months(start, end)).alias("month"))


def spine_left_join(
    series: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    start: str = C.FIRST_MONTH,
    end: str = C.END_MONTH,
) -> DataFrame:
    """Zero-filled series: keys, month and values for every month of the spine.

    ``series`` has one row per (keys, month).  The months of a key are gathered into a map, which
    the spine bounds, and the spine is laid out afterwards: one shuffle of the sparse rows, where
    a join would also shuffle the dense ones.
    """
    inside = (F.col("month") >= _month(start)) & (F.col("month") < _month(end))
    entry = F.when(inside, F.struct(F.col("month"), F.struct(*values).alias("v")))
    gathered = series.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(entry)).alias("found")
    )
    types = dict(series.dtypes)
    dense = gathered.select(*keys, "found", F.explode(_months(start, end)).alias("month"))
    value = F.col("found")[F.col("month")]
    return dense.select(
        *keys,
        "month",
        *[F.coalesce(value[v], F.lit(0)).cast(types[v]).alias(v) for v in values],
    )


def ngram_timeseries(
    table: DataFrame, terms: Sequence[str], start: str = C.FIRST_MONTH, end: str = C.END_MONTH
) -> DataFrame:
    """Zero-filled corpus-wide (ngram, month, cnt, percentage); unknown n-grams have no rows."""
    found = table.where(
        (F.col("community") == C.ALL_COMMUNITIES) & F.col("ngram").isin(list(terms))
    )
    return spine_left_join(found, ["ngram"], ["cnt", "percentage"], start, end)


def top_communities(
    counters: DataFrame, terms: Sequence[str] | None = None, k: int = C.TOP_COMMUNITIES
) -> DataFrame:
    """The k communities with the highest count per n-gram, for some or all n-grams.

    n is the number of words of the n-gram.  Spark cuts each task's rows to k per n-gram before
    it shuffles them.
    """
    known = counters.where(F.col("n") == F.size(F.split("ngram", " ")))
    if terms is not None:
        known = known.where(F.col("ngram").isin(list(terms)))
    ranked = Window.partitionBy("ngram").orderBy(F.col("wcount").desc(), "community")
    return (
        known.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("ngram", "rank", "community", "wcount")
    )


def split_query(text: str) -> list[str]:
    """Comma-separated phrases, trimmed and in lower case, each once."""
    return list(dict.fromkeys(part.strip().lower() for part in text.split(",")))


def compare_ngrams(
    query: str,
    table: DataFrame,
    counters: DataFrame,
    start: str = C.FIRST_MONTH,
    end: str = C.END_MONTH,
) -> DataFrame:
    """Series of every phrase of a query: ngram, label, ts_ms, cnt, percentage.

    The label is ``phrase::top community``.  A phrase without community gets zeros under its bare
    name; one with community but without corpus-wide rows gets no series.
    """
    terms = split_query(query)
    spark = table.sparkSession
    asked = spark.createDataFrame([(t,) for t in terms], "ngram string")
    best = top_communities(counters, terms, 1).select("ngram", "community")
    labelled = asked.join(best, "ngram", "left").select(
        "ngram",
        F.col("community").isNotNull().alias("known"),
        F.coalesce(F.concat("ngram", F.lit("::"), "community"), "ngram").alias("label"),
    )
    filled = ngram_timeseries(table, terms, start, end)
    shown = labelled.where("known").join(filled, "ngram")
    empty = labelled.where("NOT known").select(
        "*",
        F.explode(_months(start, end)).alias("month"),
        F.lit(0).cast("bigint").alias("cnt"),
        F.lit(0.0).alias("percentage"),
    )
    return shown.unionByName(empty).select(
        "ngram", "label", TM.epoch_millis(F.col("month")).alias("ts_ms"), "cnt", "percentage"
    )


def leading_phrases(table: DataFrame, k: int) -> DataFrame:
    """The k most frequent n-grams over all months."""
    return (
        table.groupBy("ngram", "n")
        .agg(F.sum("cnt").alias("occurrences"))
        .orderBy(F.col("occurrences").desc(), "ngram")
        .limit(k)
    )
