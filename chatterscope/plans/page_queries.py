"""Registered queries: page XML, links, page streams, backlinks, message stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.functions import pages as P
from chatterscope.plans import fixtures as X
from chatterscope.plans.catalog import Catalog
from chatterscope.plans.filter_queries import TRACKED
from chatterscope.session import cut_lineage, fresh_path
from chatterscope.sources import tables
from chatterscope.streaming import messages as SM
from chatterscope.streaming import pages as SP

CATALOG = Catalog()
query = CATALOG.query

DRAIN = {"availableNow": True}
_ANCHOR = r'<a href="/?([^"]*)"[^>]*>([^<]*)</a>'

# Every web page becomes a wiki page: anchors turn into [[target|label]], some titles get a name
# space, and every fifth page is named after its first link.
PAGES = rf"""raw AS (
SELECT page_id, CASE WHEN page_id % 5 = 0 THEN regexp_extract(html, '<a href="/?([^"]*)"', 1)
         ELSE CASE page_id % 7 WHEN 1 THEN 'Template:' WHEN 2 THEN 'File:' ELSE '' END
              || regexp_extract(html, '<title>([^<]*)</title>', 1) END AS name,
       regexp_replace(regexp_replace(html, '{_ANCHOR}', '[[\1|\2]]', 'g'), '\[\[([T-Zt-z])', '[[File:\1', 'g') AS body
FROM pages),
msgs AS (SELECT page_id, '<page><title>' || replace(replace(replace(name, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
  || '</title><revision><text>' || replace(replace(replace(body, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
  || '</text></revision></page>' AS value FROM raw),
parsed AS (SELECT page_id, lower(name) AS title, nullif(body, '') AS text FROM raw),
found AS (SELECT page_id, title, text, [lower(split_part(ltrim(rtrim(x, ']'), '['), '|', 1))
  FOR x IN regexp_extract_all(text, '\[\[.*?\]\]')] AS all_links FROM parsed),
linked AS (SELECT page_id, title, text, [x FOR x IN all_links IF NOT (contains(x, ':')
  AND (contains(split_part(x, ':', 1), 'template') OR contains(split_part(x, ':', 1), 'file')))] AS links FROM found),
articles AS (SELECT sha256(title) AS id, * FROM linked
  WHERE NOT contains(title, 'template:') AND NOT contains(title, 'file:'))"""


def page_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id and value, the XML of the page."""
    html = X.table(spark, sf_dir, "pages").select("page_id", "html")
    slot = F.col("page_id") % 7
    name = F.when(
        F.col("page_id") % 5 == 0, F.regexp_extract("html", r'<a href="/?([^"]*)"', 1)
    ).otherwise(
        F.concat(
            F.when(slot == 1, "Template:").when(slot == 2, "File:").otherwise(""),
            F.regexp_extract("html", "<title>([^<]*)</title>", 1),
        )
    )
    linked = F.regexp_replace("html", _ANCHOR, "[[$1|$2]]")
    body = F.regexp_replace(linked, r"\[\[([T-Zt-z])", "[[File:$1")

    def escaped(text: Column) -> Column:
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(char), F.lit(entity))
        return text

    return html.select(
        "page_id",
        F.concat(
            F.lit("<page><title>"),
            escaped(name),
            F.lit("</title><revision><text>"),
            escaped(body),
            F.lit("</text></revision></page>"),
        ).alias("value"),
    )


@query(f"WITH {PAGES} SELECT page_id, title, text FROM parsed")
def parse_page_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parsed_pages(page_messages(spark, sf_dir), "value", "page_id")


@query(f"WITH {PAGES} SELECT page_id, title FROM articles")
def filter_page_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = parse_page_xml(spark, sf_dir).select("page_id", "title")
    return titles.where(P.in_article_namespace(F.col("title")))


@query(
    f"WITH {PAGES} SELECT page_id, generate_subscripts(links, 1) AS pos, unnest(links) AS target FROM linked"
)
def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = P.extract_links(F.col("text"))
    found = parse_page_xml(spark, sf_dir).select(
        "page_id", F.posexplode_outer(links).alias("pos", "target")
    )
    found = found.where(F.col("target").isNotNull())
    return found.withColumn("pos", (F.col("pos") + 1).cast("bigint"))


def page_topic(spark: SparkSession, sf_dir: str) -> str:
    """The page messages as files, as a topic would hold them, with an empty one after each."""
    path = fresh_path(spark, "page-topic")
    messages = page_messages(spark, sf_dir).repartition(4)
    messages.select(F.explode(F.array("value", F.lit(""))).alias("value")).write.parquet(path)
    return path


def page_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic as a stream of several micro-batches."""
    path = page_topic(spark, sf_dir)
    stream = spark.readStream.schema("value STRING").option("maxFilesPerTrigger", 2).parquet(path)
    return stream.where(F.length("value") > 0)


def _drain(spark: SparkSession, start, name: str) -> str:
    path = fresh_path(spark, name)
    start(path, fresh_path(spark, f"{name}-progress"), DRAIN).awaitTermination()
    return path


@query(f"WITH {PAGES} SELECT value FROM msgs")
def stream_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = page_topic(spark, sf_dir)
    lines = fresh_path(spark, "page-lines")
    flat = F.translate("value", "\n", "\x0b")
    spark.read.parquet(topic).select(flat.alias("value")).write.text(lines)
    stream = SP.stream_pages(spark, "text", lines, maxFilesPerTrigger="2")
    path = _drain(spark, lambda *a: SP.append_rows(stream, *a), "stream-pages")
    return spark.read.parquet(path).select(F.translate("value", "\x0b", "\n").alias("value"))


@query(f"WITH {PAGES} SELECT id, title, text, array_to_string(links, ' ') AS links FROM articles")
def stream_parse_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = SP.parse_filter(page_stream(spark, sf_dir))
    path = _drain(spark, lambda *a: SP.append_rows(pages, *a), "parsed-pages")
    return spark.read.parquet(path).withColumn("links", F.array_join("links", " "))


BACKLINKS = f"""WITH {PAGES},
edges AS (SELECT DISTINCT title AS source, unnest(links) AS target FROM articles),
refs AS (SELECT target AS title, string_agg(source, '|' ORDER BY source) AS referredby FROM edges GROUP BY target),
own AS (SELECT DISTINCT id, title FROM articles)"""


@query(
    f"{BACKLINKS} SELECT coalesce(own.title, refs.title) AS title, id, referredby "
    "FROM own FULL JOIN refs ON own.title = refs.title"
)
def stream_backlinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = SP.parse_filter(page_stream(spark, sf_dir))
    path = _drain(spark, lambda *a: SP.write_backlinks(pages, *a), "backlinks")
    table = tables.collect_backlinks(SP.backlinks(spark, path))
    return table.select("title", "id", F.array_join("referredby", "|").alias("referredby"))


@query(f"WITH {PAGES} SELECT id, title, max(text) AS text FROM articles GROUP BY ALL")
def stream_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages drained in one batch, so that equal titles are settled by their text."""
    path = page_topic(spark, sf_dir)
    stream = spark.readStream.schema("value STRING").parquet(path).where(F.length("value") > 0)
    pages = SP.parse_filter(stream)
    index = _drain(spark, lambda *a: SP.write_index(pages, *a), "index")
    return SP.indexed(spark, index)


@query(
    f"{BACKLINKS}, last AS (SELECT title, max_by(links, batch_key) AS links FROM "
    "(SELECT title, links, (page_id % 3, list_sort(list_distinct(links))) AS batch_key FROM articles) GROUP BY title) "
    "SELECT coalesce(own.title, refs.title) AS title, id, "
    "array_to_string(list_sort(list_distinct(links)), '|') AS linksto, referredby "
    "FROM own JOIN last ON own.title = last.title FULL JOIN refs ON own.title = refs.title"
)
def upsert_set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages arrive in three batches; the last batch's links count, backlinks add up."""
    path = fresh_path(spark, "page-table")
    messages = page_messages(spark, sf_dir)
    numbered = messages.withColumn("batch", (F.col("page_id") % 3).cast("int"))
    page = P.parsed_pages(numbered, "value", "batch")
    pages = page.where(P.in_article_namespace(F.col("title"))).select(
        "batch",
        P.page_id(F.col("title")).alias("id"),
        "title",
        P.extract_links(F.col("text")).alias("links"),
    )
    pages = cut_lineage(pages)  # pages and links are made of them
    linksto = F.array_sort(F.array_distinct("links")).alias("linksto")
    tables.write_batches(pages.select("batch", "title", "id", linksto), f"{path}/pages")
    links = pages.select("batch", F.explode_outer("links").alias("target"), "title")
    tables.write_batches(links.where(F.col("target").isNotNull()), f"{path}/links")
    table = tables.collect_backlinks(
        tables.upsert_set_union(
            tables.read_batches(spark, f"{path}/pages"), tables.read_batches(spark, f"{path}/links")
        )
    )
    return table.select(
        "title",
        "id",
        F.array_join("linksto", "|").alias("linksto"),
        F.array_join("referredby", "|").alias("referredby"),
    )


@query(
    f"""WITH m AS (SELECT CAST(doc_id AS VARCHAR) AS id_str, text,
  regexp_extract_all(lower(text), {X.PLAIN_TOKEN_SQL}) AS toks FROM documents WHERE lang = 'en')
SELECT id_str, text FROM m WHERE list_has_any(toks, [{', '.join(X.sql_text(t) for t in TRACKED)}])"""
)
def stream_track_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "message-topic")
    docs = X.table(spark, sf_dir, "documents")
    docs.select(F.col("doc_id").cast("string").alias("id_str"), "text", "lang").write.json(path)
    stream = SM.stream_track_terms(SM.stream_messages(spark, path), TRACKED)
    rows = stream.select("id_str", "text")
    drained = _drain(spark, lambda *a: SP.append_rows(rows, *a), "tracked")
    return spark.read.parquet(drained)
