"""The batch jobs from comment files to result tables.

Every job reads comment files (JSON lines under YYYY/RC_YYYY-MM keys) and replaces the batches or
years that it computed, so a job can be run again, month by month or for all months at once.  A batch is
the month of a file.  What a file holds of another month's days is added up on reading, and floors apply
to the sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope import constants as C
from chatterscope.functions import time as TM
from chatterscope.operators import activity as A
from chatterscope.operators import clustering, filters
from chatterscope.operators import followers as FW
from chatterscope.operators import graph as G
from chatterscope.operators import ngrams as N
from chatterscope.operators import search as S
from chatterscope.session import cut_lineage
from chatterscope.sources import comments as CM
from chatterscope.sources import gexf, lists, tables, versions
from chatterscope.sources import messages as M
from chatterscope.streaming import pages as SP

PHRASE_FIELDS = "body STRING, created_utc STRING, subreddit STRING"
ACTIVITY_FIELDS = "author STRING, created_utc STRING, subreddit STRING"


def _comments(spark: SparkSession, source: str, fields: str, period: str | None = None) -> DataFrame:
    """Comments of the files of a period, YYYY or YYYY-MM; other files are not read."""
    comments = CM.scan_month_files(spark, source, fields).withColumnRenamed("subreddit", "community")
    if period is None:
        return comments
    chosen = comments.withColumn("year", F.year("month"))
    year, _, month = period.partition("-")
    if month:
        chosen = chosen.where(F.month("month") == int(month))
    return CM.select_period(chosen, int(year)).drop("year")


def _owned(spark: SparkSession, source: str, period: str | None) -> list[int]:
    """The months of the files of a period, which a run replaces."""
    months = CM.file_months(spark, source)
    return [m for m in months if period is None or str(m).startswith(period.replace("-", ""))]


def _listed(
    spark: SparkSession, comments: DataFrame, white: str | None, black: str | None, first: int | None
) -> DataFrame:
    if black:
        comments = filters.filter_blacklist(comments, lists.scan_name_list(spark, black))
    if white:
        names = lists.scan_name_list(spark, white)
        names = names if first is None else lists.whitelist_top_k(names, first)
        comments = filters.filter_whitelist(comments, names)
    return comments


def _month_number(date: str):
    return F.year(date) * 100 + F.month(date)


def monthly_phrases(
    spark: SparkSession,
    source: str,
    out: str,
    white: str | None = None,
    black: str | None = None,
    first: int | None = None,
    period: str | None = None,
) -> None:
    """Corpus-wide phrase table, one batch per month of the files."""
    comments = _listed(spark, _comments(spark, source, PHRASE_FIELDS, period), white, black, first)
    table = N.monthly_frequent(comments)
    tables.write_batches(
        table.withColumn("batch", _month_number("month")),
        out,
        sort_by=["ngram"],
        owned=_owned(spark, source, period),
    )


def community_phrases(
    spark: SparkSession,
    source: str,
    out: str,
    white: str | None = None,
    black: str | None = None,
    first: int | None = None,
    grain: str = "month",
    period: str | None = None,
) -> None:
    """Phrase counts per community (``out``/table) and its counters (``out``/counters).

    Both come from one pass over the text and have one batch per month of the files.
    """
    comments = _listed(spark, _comments(spark, source, PHRASE_FIELDS, period), white, black, first)
    comments = comments.withColumns(
        {
            "bucket": TM.bucket_time(F.col("created_utc"), grain),
            "batch": _month_number("month"),
        }
    )
    keys = ["batch", "bucket", "community"]
    counts = cut_lineage(N.count_phrases(N.phrases(comments, keys), keys))
    owned = _owned(spark, source, period)
    tables.write_batches(counts, f"{out}/table", sort_by=["ngram"], owned=owned)

    rolled = counts.groupBy("batch", "community", "n", "ngram").agg(F.sum("cnt").alias("cnt"))
    deltas = N.join_totals(N.above_floor(rolled), N.totals(counts, ["batch"]), ["batch"])
    tables.write_batches(
        deltas.withColumnRenamed("cnt", "wcount"), f"{out}/counters", sort_by=["ngram"], owned=owned
    )


def read_monthly_phrases(spark: SparkSession, path: str) -> DataFrame:
    return tables.upsert_last_wins(tables.read_batches(spark, path), ["ngram", "community", "month"])


def _summed(batches: DataFrame) -> DataFrame:
    return tables.merge_counters(batches, ["bucket", "community", "n", "ngram"], ["cnt"])


def read_community_phrases(spark: SparkSession, path: str) -> DataFrame:
    """The phrase table per bucket and community."""
    return N.community_table(_summed(tables.read_batches(spark, f"{path}/table")))


def read_community_counters(spark: SparkSession, path: str) -> DataFrame:
    batches = tables.read_batches(spark, f"{path}/counters")
    return tables.merge_counters(batches, ["community", "n", "ngram"], ["wcount", "total"])


def daily_phrases(
    spark: SparkSession,
    source: str,
    out: str,
    white: str | None = None,
    black: str | None = None,
    period: str | None = None,
) -> None:
    """Phrase counts per day and community."""
    comments = _listed(spark, _comments(spark, source, PHRASE_FIELDS, period), white, black, None)
    comments = comments.withColumns(
        {
            "bucket": TM.bucket_time(F.col("created_utc"), "day"),
            "batch": _month_number("month"),
        }
    )
    keys = ["batch", "bucket", "community"]
    counts = N.count_phrases(N.phrases(comments, keys), keys)
    tables.write_batches(counts, out, sort_by=["ngram"], owned=_owned(spark, source, period))


def read_daily_phrases(spark: SparkSession, path: str) -> DataFrame:
    """Day and community phrase table, divided by the totals over all days stored."""
    counts = cut_lineage(_summed(tables.read_batches(spark, path)))
    return N.relative_frequency(N.prune_adaptive(counts))


def daily_statistics(spark: SparkSession, source: str, out: str, period: str | None = None) -> None:
    """What daily rows are counted from: the authors of each day, and its communities with their
    comments, one batch per month of the files."""
    comments = _comments(spark, source, ACTIVITY_FIELDS, period).select(
        _month_number("month").alias("batch"),
        TM.epoch_day(F.col("created_utc")).alias("date"),
        F.inline(
            F.array(
                F.struct(F.lit("community").alias("kind"), F.col("community").alias("name")),
                F.struct(F.lit("author").alias("kind"), F.col("author").alias("name")),
            )
        ),
    )
    rows = comments.groupBy("batch", "date", "kind", "name").agg(F.count(F.lit(1)).alias("comments"))
    rows = rows.withColumn("year", F.year("date"))
    tables.write_batches(rows, out, ["year"], owned=_owned(spark, source, period))


def read_daily_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Daily rows: date, communities, comments, authors, year."""
    rows = tables.read_batches(spark, path).groupBy("date", "kind", "name").agg(
        F.sum("comments").alias("comments")
    )

    def of(kind: str, value):
        return F.when(F.col("kind") == kind, value)

    stats = rows.groupBy("date").agg(
        F.count(of("community", F.col("name"))).alias("communities"),
        F.sum(of("community", F.col("comments"))).alias("comments"),
        F.count(of("author", F.col("name"))).alias("authors"),
    )
    return A.daily_rows(stats)


def daily_documents(spark: SparkSession, statistics: str, out: str) -> None:
    """The series of each daily number as one JSON document: ``out``/metric=<name>, a line each."""
    documents = A.export_series_json(A.stats_series(read_daily_statistics(spark, statistics)))
    documents.withColumnRenamed("document", "value").write.mode("overwrite").partitionBy("metric").text(out)


def author_graph(
    spark: SparkSession,
    source: str,
    out: str,
    comments_more_than: int = C.ACTIVE_COMMENTS,
    authors_more_than: int = C.EDGE_AUTHORS,
    hub_degree: int = C.HUB_DEGREE,
    rounds: int = 5,
    classes: str = "modularity",
    period: str | None = None,
) -> None:
    """Per year: ``out``/adjacency, the published graph in ``out``/edges and ``out``/nodes with
    the class of every node, ``out``/modularity.

    ``classes`` are found by modularity, or by "propagation" in ``rounds`` and until labels settle.

    A year is computed from all its files: thresholds hold for the year, not for a month, and a period
    is a year.
    """
    if period and "-" in period:
        raise ValueError("the graph of a year needs all its months")
    also = ["year"]
    comments = _comments(spark, source, ACTIVITY_FIELDS, period).withColumn("year", F.year("month"))
    members = A.active_memberships(A.author_activity(comments, *also), comments_more_than)
    edges = cut_lineage(G.overlap_edges(cut_lineage(members), authors_more_than, also))
    years = sorted({m // 100 for m in _owned(spark, source, period)})

    def write(rows: DataFrame, name: str, sort_by=()) -> None:
        tables.write_partitioned(rows, f"{out}/{name}", also, sort_by)
        tables.clear_partitions(rows, f"{out}/{name}", "year", years)

    write(G.adjacency_rows(edges, also), "adjacency", ["node1"])

    published = cut_lineage(G.graph_by_year(edges, hub_degree, also))
    labels = (
        clustering.modularity_classes(published, also)
        if classes == "modularity"
        else clustering.communities(published, rounds, also)
    )
    write(published, "edges", ["src"])
    write(labels, "nodes", ["node"])
    write(cut_lineage(clustering.modularity(published, labels, also)), "modularity")


def graph_file(spark: SparkSession, graph: str, out: str, year: int = 2015) -> None:
    """One year's published graph with its classes, as one document in ordered parts."""
    # with their schemas, as no year may have an edge left
    schemas = {"edges": "src string, dst string, weight bigint, year int", "nodes": "node string, community string, year int"}
    edges, labels = (tables.read_batches(spark, f"{graph}/{n}", s).where(F.col("year") == year) for n, s in schemas.items())
    gexf.write_document(edges.select("src", "dst", "weight"), labels.select("node", "community"), out)


def search_index(spark: SparkSession, source: str, out: str) -> None:
    """Postings (``out``/postings), titles and the corpus numbers of documents (id, title, text)."""
    documents = spark.read.parquet(source)
    S.write_postings(S.postings(documents), f"{out}/postings")
    index = spark.read.parquet(f"{out}/postings")
    documents.select("id", "title").write.parquet(f"{out}/titles")
    S.index_stats(index, documents.select("id")).write.parquet(f"{out}/stats")


def search(spark: SparkSession, index: str, query: str, k: int = C.SEARCH_HITS) -> DataFrame:
    """The k best documents of a stored index: id, title, score."""
    postings, stats = (spark.read.parquet(f"{index}/{n}") for n in ("postings", "stats"))
    hits = S.text_match(postings, stats, query, k)
    return S.with_titles(hits, spark.read.parquet(f"{index}/titles")).orderBy(F.col("score").desc(), "id")


def page_backlinks(spark: SparkSession, source: str, out: str) -> None:
    """Pages (one XML text per line of the files) that came since the last run, to the backlink and
    search tables below ``out``."""
    pages = SP.parse_filter(SP.stream_pages(spark, "text", source))
    once = {"availableNow": True}
    SP.write_backlinks(pages, f"{out}/backlinks", f"{out}/progress/backlinks", once).awaitTermination()
    SP.write_index(pages, f"{out}/index", f"{out}/progress/index", once).awaitTermination()


def message_table(spark: SparkSession, source: str, out: str, batch: int, buckets: int = 64) -> None:
    """Messages (JSON lines) of one delivery, by number, into a table with one row per message id; the row
    of the latest delivery counts, and a repeated delivery changes nothing."""
    rows = M.project_tweet(M.scan_tweets(spark, source)).withColumn("batch", F.lit(batch).cast("bigint"))
    latest = lambda found: tables.last_rows(found, ["id"])
    versions.merge_buckets(rows.where(F.col("id").isNotNull()), out, "id", latest, buckets, ("messages", batch))


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return versions.read(spark, path).drop("batch")


def follower_walk(spark: SparkSession, source: str, out: str, account: int, hops: int = 2, influential: bool = False) -> None:
    """Accounts within so many hops of followers of an account (JSON lines of follower lists), with their
    hop; only influential ones if asked for."""
    edges = cut_lineage(M.explode_followers(M.scan_followers(spark, source)))
    walk = FW.influential_followers if influential else FW.k_hop_followers
    walk(edges, account, hops).write.mode("overwrite").parquet(out)
