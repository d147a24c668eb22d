"""Full-text search: an index of postings and ranked matches."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope import constants as C

WORD = r"[\p{L}\p{N}_]+"
K1 = 1.2
B = 0.75


def words_of(documents: DataFrame, text: str = "text", id: str = "id") -> DataFrame:
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return documents.select(F.col(id).alias("id"), words.alias("words"))


def postings(documents: DataFrame, text: str = "text", id: str = "id") -> DataFrame:
    """term, id, tf, length.  The length rides along, so that scoring needs no second join."""
    words = words_of(documents, text, id).withColumn("length", F.size("words"))
    # an outer explode: before an inner one Spark would test the array, tokenizing every text twice
    terms = words.select("id", "length", F.explode_outer("words").alias("term"))
    found = terms.where(F.col("term").isNotNull())
    return found.groupBy("term", "id", "length").agg(F.count(F.lit(1)).alias("tf"))


def write_postings(index: DataFrame, path: str, partitions: int | None = None) -> None:
    """Store postings in term order, so that a search skips all files but those of its terms.

    Ranges are cut by (term, id): a term in most documents is spread over several files.
    """
    keys = ["term", "id"] if partitions is None else [partitions, "term", "id"]
    index.repartitionByRange(*keys).sortWithinPartitions("term", "id").write.parquet(path)


def corpus_stats(documents: DataFrame, text: str = "text", id: str = "id") -> DataFrame:
    """One row: documents and their average length in words."""
    words = words_of(documents, text, id)
    return words.agg(
        F.count(F.lit(1)).alias("documents"), F.avg(F.size("words")).alias("avg_length")
    )


def index_stats(index: DataFrame, documents: DataFrame) -> DataFrame:
    """The same row from an index of the documents, without reading their texts again."""
    words = index.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("words"))
    total = documents.agg(F.count(F.lit(1)).alias("documents"))
    return total.select("documents", (words.select("words").scalar() / F.col("documents")).alias("avg_length"))


def with_titles(hits: DataFrame, titles: DataFrame) -> DataFrame:
    """Hits (id, score) with the title of (id, title); as few rows as there are hits."""
    return titles.select("id", "title").join(F.broadcast(hits), "id", "right")


def query_terms(query: str | Sequence[str]) -> list[str]:
    text = query if isinstance(query, str) else " ".join(query)
    return list(dict.fromkeys(re.findall(r"\w+", text.lower())))


def text_match(
    index: DataFrame, stats: DataFrame, query: str | Sequence[str], k: int = C.SEARCH_HITS
) -> DataFrame:
    """The k best documents with any of the terms, by BM25 score: id, score.

    Only the postings of the asked terms are read; the per-term numbers are as few as the terms.
    """
    terms = query_terms(query)
    hits = index.where(F.col("term").isin(terms))
    # counting tf > 0 keeps both uses of the hits alike, so that Spark computes them once
    found_in = hits.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))
    documents = stats.select("documents").scalar()
    avg_length = stats.select("avg_length").scalar()
    idf = F.ln(1 + (documents - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = found_in.select("term", idf.alias("idf"))
    tf = F.col("tf").cast("double")
    gain = tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / avg_length))
    return (
        hits.join(F.broadcast(weighted), "term")
        .groupBy("id")
        .agg(F.round(F.sum(F.col("idf") * gain), 9).alias("score"))
        .orderBy(F.col("score").desc(), "id")
        .limit(k)
    )


def match_all(documents: DataFrame, k: int = C.SEARCH_HITS, id: str = "id") -> DataFrame:
    return documents.orderBy(id).limit(k)
