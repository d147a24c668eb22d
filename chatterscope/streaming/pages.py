"""Page stream: parse, filter, backlink table, index table.

Result tables are versioned and dealt to buckets by title or id.  A micro-batch is merged into the
buckets it touches as one more version, so their size follows from the pages, not from the number of
ticks; a batch that is run again after a failure leaves them as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatterscope.functions import pages as P
from chatterscope.session import cut_lineage
from chatterscope.sources import tables, versions


def stream_pages(
    spark: SparkSession, source: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """Unbounded column ``value`` (one page XML each), from the beginning, without empty messages.

    ``source`` is any streaming format; Kafka needs its connector on the class path.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    stream = reader.options(**options).load(path)
    value = F.col("value").cast("string").alias("value")
    return stream.select(value).where(F.length("value") > 0)


def parse_filter(messages: DataFrame) -> DataFrame:
    """id, title, text, links of all pages in the article name space."""
    page = P.parsed_pages(messages, "value")
    return page.where(P.in_article_namespace(F.col("title"))).select(
        P.page_id(F.col("title")).alias("id"),
        "title",
        "text",
        P.extract_links(F.col("text")).alias("links"),
    )


PAGE_ROWS = "title STRING, id STRING, linksto ARRAY<STRING>, batch BIGINT"
LINK_ROWS = "target STRING, title STRING"
DOCUMENT_ROWS = "id STRING, title STRING, text STRING, batch BIGINT"


def page_rows(pages: DataFrame) -> DataFrame:
    return pages.select("title", "id", F.array_sort(F.array_distinct("links")).alias("linksto"))


def link_rows(pages: DataFrame) -> DataFrame:
    # outer, so that Spark does not parse every page once more to test its links
    links = pages.select(F.explode_outer("links").alias("target"), "title")
    return links.where(F.col("target").isNotNull()).distinct()


def _start(writer, trigger: dict | None) -> StreamingQuery:
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def last_pages(rows: DataFrame) -> DataFrame:
    return tables.last_rows(rows, ["title"])


def last_documents(rows: DataFrame) -> DataFrame:
    return tables.last_rows(rows, ["id"])


def write_backlinks(
    pages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, buckets: int = 64
) -> StreamingQuery:
    """Every tick: the batch's pages to ``path``/pages, its inverted links to ``path``/links."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = cut_lineage(batch)
        if not batch.limit(1).count():
            return
        number = F.lit(batch_id).cast("bigint").alias("batch")
        own = page_rows(batch).select("title", "id", "linksto", number)
        versions.merge_buckets(own, f"{path}/pages", "title", last_pages, buckets, ("stream", batch_id))
        links = link_rows(batch).select("target", "title")
        versions.merge_buckets(links, f"{path}/links", "target", lambda rows: rows.distinct(), buckets, ("stream", batch_id))

    return _start(
        pages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint), trigger
    )


def backlinks(spark: SparkSession, path: str, title: str | None = None) -> DataFrame:
    """The backlink table as it stands, a row for every backlink; for one title two buckets are read."""
    if title is None:
        pages = versions.read(spark, f"{path}/pages", schema=PAGE_ROWS)
        links = versions.read(spark, f"{path}/links", schema=LINK_ROWS)
    else:
        pages = versions.lookup(spark, f"{path}/pages", "title", title)
        links = versions.lookup(spark, f"{path}/links", "target", title)
    return tables.with_sources(pages.drop("batch"), links)


def write_index(
    pages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, buckets: int = 64
) -> StreamingQuery:
    """Every tick: the batch's documents (id, title, text)."""

    def index(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("id", "title", "text", F.lit(batch_id).cast("bigint").alias("batch"))
        versions.merge_buckets(rows, path, "id", last_documents, buckets, ("stream", batch_id))

    return _start(
        pages.writeStream.foreachBatch(index).option("checkpointLocation", checkpoint), trigger
    )


def indexed(spark: SparkSession, path: str) -> DataFrame:
    return versions.read(spark, path, schema=DOCUMENT_ROWS).drop("batch")


def append_rows(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Stateless results to a Parquet folder, exactly once."""
    writer = rows.writeStream.format("parquet").option("path", path)
    return _start(writer.option("checkpointLocation", checkpoint), trigger)
