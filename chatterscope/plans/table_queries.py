"""Registered queries: batch tables and what merging makes of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.operators import activity as A
from chatterscope.operators import graph as G
from chatterscope.operators import ngrams as N
from chatterscope.plans import fixtures as X
from chatterscope.plans.activity_queries import DAILY, events_as_comments
from chatterscope.plans.catalog import Catalog
from chatterscope.plans.graph_queries import BOUGHT, year_edges
from chatterscope.plans.ngram_queries import BUCKETED, FLOOR, frequent_counts
from chatterscope.session import cut_rounds, fresh_cut, fresh_path
from chatterscope.sources import tables

CATALOG = Catalog()
query = CATALOG.query


def _batch_table(spark: SparkSession, df: DataFrame, name: str, partition_by=()) -> DataFrame:
    path = fresh_cut(spark, name)
    tables.write_batches(df, path, partition_by)
    return tables.read_batches(spark, path, df.schema)


@query(
    f"""WITH {X.TOKENS},
b AS (SELECT CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 ELSE 3 END AS batch,
             p.month, p.community, ngram, n, count(*) AS cnt
      FROM phrases p JOIN comments c USING (id) GROUP BY ALL)
SELECT ngram, community, month, n, max_by(cnt, batch) AS cnt FROM b GROUP BY ALL"""
)
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrase counts arrive per language; for a phrase, community and month the last language counts.

    A round of ``phrase_rounds`` holds all counts of its phrases, so it has a batch table of its own."""
    comments = X.comments(spark, sf_dir).withColumn(
        "batch",
        F.when(F.col("lang") == "de", 0)
        .when(F.col("lang") == "en", 1)
        .when(F.col("lang") == "es", 2)
        .otherwise(3),
    )
    keys = ["batch", "month", "community"]

    def merged(counts: DataFrame) -> DataFrame:
        rows = _batch_table(spark, counts, "ngram-table")
        return tables.upsert_last_wins(rows, ["ngram", "community", "month"])

    return cut_rounds(N.phrase_rounds(comments, keys), merged)


@query(
    f"WITH {BUCKETED} SELECT community, n, ngram, CAST(sum(cnt) AS BIGINT) AS wcount, "
    f"CAST(sum(total) AS BIGINT) AS total FROM cc JOIN bt USING (bucket, n) WHERE {FLOOR} GROUP BY ALL"
)
def merge_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter increments of every month as a batch of its own, added up on reading."""
    deltas = frequent_counts(spark, sf_dir)
    months = F.year("bucket") * 100 + F.month("bucket")
    rows = deltas.select(
        months.alias("batch"), "community", "n", "ngram", F.col("cnt").alias("wcount"), "total"
    )
    stored = _batch_table(spark, rows, "counter-table")
    return tables.merge_counters(stored, ["community", "n", "ngram"], ["wcount", "total"])


@query(
    f"WITH {BOUGHT} SELECT CAST(year AS INTEGER) AS year, src AS node1, dst AS neighbour, "
    "CAST(weight AS INTEGER) AS weight FROM year_kept"
)
def write_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacency rows written by year, read back and laid out as edges."""
    path = fresh_path(spark, "adjacency")
    rows = G.adjacency_rows(year_edges(spark, sf_dir), ["year"])
    rows = rows.withColumn("year", F.col("year").cast("int"))
    tables.write_partitioned(rows, path, ["year"], ["node1"])
    edges = G.adjacency_edges(tables.read_batches(spark, path, rows.schema), ["year"])
    return edges.select("year", F.col("src").alias("node1"), F.col("dst").alias("neighbour"), "weight")


@query(f"{DAILY} SELECT CAST(year(date) AS INTEGER) AS year, * FROM daily")
def write_daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows keyed by (year, date), in a table partitioned by year."""
    stats = A.daily_rows(A.daily_stats(events_as_comments(spark, sf_dir)))
    rows = _batch_table(spark, stats.withColumn("batch", F.lit(0)), "daily-stats", ["year"])
    return tables.upsert_last_wins(rows, ["year", "date"])


@query(
    "SELECT doc_id AS id, CASE WHEN label_id IS NULL THEN text ELSE text || ' #' || quality END AS text "
    "FROM documents LEFT JOIN (SELECT doc_id AS label_id, quality FROM labels) ON doc_id = label_id"
)
def index_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, then the labelled ones again with their label: the later text counts."""
    docs = X.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    labels = X.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    again = docs.join(labels, "id").select(
        "id", F.concat("text", F.lit(" #"), F.col("quality").cast("string")).alias("text")
    )
    batches = docs.withColumn("batch", F.lit(0)).unionByName(again.withColumn("batch", F.lit(1)))
    return tables.upsert_last_wins(_batch_table(spark, batches, "document-index"), ["id"])
