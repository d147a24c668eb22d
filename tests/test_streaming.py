"""Streams drained in several batches with a restart equal the batch result."""

from pyspark.sql import functions as F

from chatterscope.functions import pages as P
from chatterscope.session import fresh_path
from chatterscope.sources import tables, versions
from chatterscope.streaming import messages as SM
from chatterscope.streaming import pages as SP

DRAIN = {"availableNow": True}


def page(title, text):
    return f"<page><title>{title}</title><revision><text>{text}</text></revision></page>"


FIRST = [
    page("Alpha", "see [[Beta|b]] and [[Gamma]] and [[File:pic.png|p]]"),
    page("Template:Box", "[[Alpha]]"),
    "",
    "<page><broken",
]
SECOND = [
    page("Beta", "back to [[alpha]] [[x:y]]"),
    page("Alpha", "now only [[beta]]"),
    page("file:old", "[[Alpha]]"),
]


def write(spark, path, values):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode(
        "append"
    ).text(path)


def backlink_state(spark, path):
    rows = tables.collect_backlinks(SP.backlinks(spark, path)).collect()
    return {r.title: (r.id is not None, r.linksto, r.referredby) for r in rows}


def test_backlinks_survive_a_restart(spark):
    topic, path, progress = (fresh_path(spark, n) for n in ("topic", "links", "progress"))
    for values in (FIRST, SECOND):
        write(spark, topic, values)
        pages = SP.parse_filter(SP.stream_pages(spark, "text", topic))
        SP.write_backlinks(pages, path, progress, DRAIN).awaitTermination()
    expected = {
        "alpha": (True, ["beta"], ["beta"]),
        "beta": (True, ["alpha", "x:y"], ["alpha"]),
        "gamma": (False, None, ["alpha"]),
        "x:y": (False, None, ["beta"]),
    }
    assert backlink_state(spark, path) == expected


def test_a_replayed_batch_changes_nothing(spark):
    path = fresh_path(spark, "links")
    batch = SP.parse_filter(spark.createDataFrame([(v,) for v in FIRST], "value string"))
    number = F.lit(0).cast("bigint").alias("batch")
    pages = SP.page_rows(batch).select("title", "id", "linksto", number)
    links = SP.link_rows(batch).select("target", "title")
    for mark in (None, ("stream", 0), ("stream", 0)):  # twice merged, once known to be there
        versions.merge_buckets(pages, f"{path}/pages", "title", SP.last_pages, 8, mark)
        versions.merge_buckets(links, f"{path}/links", "target", lambda rows: rows.distinct(), 8, mark)
    assert backlink_state(spark, path)["gamma"] == (False, None, ["alpha"])
    assert len(backlink_state(spark, path)) == 3


def test_backlinks_without_any_link(spark):
    topic, path, progress = (fresh_path(spark, n) for n in ("topic", "links", "progress"))
    write(spark, topic, ["<page><title>Lone</title><text>no link</text></page>"])
    pages = SP.parse_filter(SP.stream_pages(spark, "text", topic))
    SP.write_backlinks(pages, path, progress, DRAIN).awaitTermination()
    assert backlink_state(spark, path) == {"lone": (True, [], None)}


def test_index_keeps_the_last_text(spark):
    topic, path, progress = (fresh_path(spark, n) for n in ("topic", "index", "progress"))
    for values in (FIRST, SECOND):
        write(spark, topic, values)
        pages = SP.parse_filter(SP.stream_pages(spark, "text", topic))
        SP.write_index(pages, path, progress, DRAIN).awaitTermination()
    texts = {r.title: r.text for r in SP.indexed(spark, path).collect()}
    assert texts == {"alpha": "now only [[beta]]", "beta": "back to [[alpha]] [[x:y]]"}


def test_tracked_words_stream(spark):
    topic, path, progress = (fresh_path(spark, n) for n in ("messages", "found", "progress"))
    rows = [("1", "Hello World", "en"), ("2", "worldly", "en"), ("3", "world", "de"), ("4", None, "en")]
    spark.createDataFrame(rows, "id_str string, text string, lang string").write.json(topic)
    found = SM.stream_track_terms(SM.stream_messages(spark, topic), ["WORLD", "unused"])
    SP.append_rows(found.select("id_str"), path, progress, DRAIN).awaitTermination()
    assert [r.id_str for r in spark.read.schema("id_str string").parquet(path).collect()] == ["1"]


def test_all_tracked_terms_count(spark):
    from chatterscope.operators.filters import filter_track_terms

    texts = ["w451", "w399", "w501", "to York, the new one", "york"]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    got = filter_track_terms(df, [f"w{i}" for i in range(500)] + ["New York", " "]).collect()
    assert [r.text for r in got] == ["w451", "w399", "to York, the new one"]
    assert filter_track_terms(df, []).count() == 0


def test_page_xml_variants(spark):
    rows = [
        ('<page xmlns="http://w.org/x"><title>A B</title><revision><text xml:space="preserve">T</text></revision></page>',),
        ("<page><title>C</title><text>D</text></page>",),
        ("<page><title>E</title></page>",),
        ("no xml",),
        (None,),
        ("<mediawiki><page><id>7</id><title>F</title><revision><text>  x <b>y</b></text></revision></page></mediawiki>",),
        ("<page><title>G</title><body><text>\n z &lt;p&gt; </text></body></page>",),
    ]
    df = spark.createDataFrame(rows, "v string").select(P.parse_page_xml(F.col("v")).alias("p"))
    assert [(r.p.title, r.p.text) for r in df.collect()] == [
        ("a b", "T"),
        ("c", "D"),
        ("e", None),
        (None, None),
        (None, None),
        ("f", "  x "),
        ("g", "\n z <p> "),
    ]


def test_links(spark):
    text = "[[Main Page|home]] [[Template:x]] [[[odd]]] [[a:file:b]] [[]] [[no\nbreak]]"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(P.extract_links(F.col("t"))).first()[0] == ["main page", "odd", "a:file:b", ""]
    strict = df.select(P.extract_links(F.col("t"), strict_reference=True)).first()[0]
    assert strict == ["Main Page", "Template:x", "odd", "a:file:b", ""]


def test_a_hundred_thousand_terms_in_batch_and_stream(spark):
    from chatterscope.operators import filters

    words = [f"w{i}" for i in range(3000)]
    pairs = [f"{words[i % 3000]} {words[(i * 7 + i // 3000) % 3000]}" for i in range(100_000)]
    terms = spark.createDataFrame([(t,) for t in [*pairs, "Lone", "  ", "red green blue"]], "term string")
    texts = ["W5 and w35", "w5 w36 apart", "a lone wolf", "green or blue, red", "green blue", None, "w1 w1"]
    rows = [(str(i), t, "en") for i, t in enumerate(texts)] + [("x", "lone", "de")]
    messages = spark.createDataFrame(rows, "id_str string, text string, lang string")
    wanted = [set(t.lower().split()) for t in [*pairs, "lone", "red green blue"]]
    brute = {str(i) for i, t in enumerate(texts) if t and any(w <= set(t.lower().replace(",", " ").split()) for w in wanted)}
    assert {r.id_str for r in filters.filter_many_terms(messages, terms).collect()} == brute and "0" in brute
    topic, out, progress = (fresh_path(spark, n) for n in ("topic", "tracked", "progress"))
    for part in (messages.where("id_str < '3'"), messages.where("id_str >= '3'")):
        part.write.mode("append").json(topic)
        stream = SM.stream_messages(spark, topic)
        SM.write_tracked(stream, terms, out, progress, DRAIN).awaitTermination()
    assert {r.id_str for r in versions.read(spark, out).collect()} == brute
    assert filters.filter_many_terms(messages, terms.limit(0)).count() == 0


def test_terms_of_tokens_may_hold_white_space(spark):
    from chatterscope.operators import filters

    terms = spark.createDataFrame([(["end", "\n\n"],), ([" ", "a"],), (["lone", "lone"],)], "words array<string>")
    rows = [("0", "the end", "en"), ("1", "the end\n\nof", "en"), ("2", "is a", "en"), ("3", "a\tis", "en"), ("4", "Lone", "en")]
    messages = spark.createDataFrame(rows, "id_str string, text string, lang string")
    assert {r.id_str for r in filters.filter_many_terms(messages, terms).collect()} == {"1", "2", "4"}


def test_items_with_a_line_break_as_a_token(spark):
    from chatterscope.plans import filter_queries

    folder = fresh_path(spark, "tables")
    items = spark.createDataFrame([(1, "thing.\nelse")], "item_id long, text string")
    docs = [(1, "en", "a thing"), (2, "en", "some\nthing"), (3, "en", "some\n\nthing")]
    items.write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, lang string, text string").write.parquet(f"{folder}/documents.parquet")
    assert {r.doc_id for r in filter_queries.filter_many_terms(spark, folder).collect()} == {2}
