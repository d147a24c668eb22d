"""Scans of files."""

import datetime as dt

import pytest

from chatterscope.session import fresh_path
from chatterscope.sources import comments as CM
from chatterscope.sources import gexf, lists, messages


def write_lines(spark, path, lines):
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(path)


LINES = [
    '{"author": "a", "body": "x y", "created_utc": "1420070400", "subreddit": "Pics", "score": 3}',
    "",
    '{"author": "b", "body": "z", "created_utc": 1420070401, "subreddit": "b", "edited": false, "new": 1}',
]


def test_json_lines(spark):
    path = fresh_path(spark, "json")
    write_lines(spark, path, LINES)
    rows = CM.scan_comments_typed(spark, path).orderBy("author").collect()
    assert [(r.author, r.created_utc, r.score, r.edited) for r in rows] == [
        ("a", "1420070400", 3, None),
        ("b", "1420070401", None, "false"),
    ]
    assert spark.sql("SELECT count(*) FROM comments").first()[0] == 2


def test_broken_lines(spark):
    path = fresh_path(spark, "json")
    write_lines(spark, path, [*LINES, "{broken"])
    kept = CM.scan_json_lines(spark, path, "author STRING", corrupt="bad").collect()
    assert sorted((r.author, r.bad) for r in kept if r.author) == [("a", None), ("b", None)]
    assert [r.bad for r in kept if r.bad] == ["{broken"]
    with pytest.raises(Exception):
        CM.scan_json_lines(spark, path, "author STRING").collect()


def test_month_of_file(spark):
    root = fresh_path(spark, "months")
    write_lines(spark, f"{root}/2007/RC_2007-10", LINES)
    write_lines(spark, f"{root}/2015/RC_2015-01", LINES[:1])
    write_lines(spark, f"{root}/2015/other", LINES)
    rows = CM.scan_month_files(spark, root, CM.COMMENT_SCHEMA).groupBy("month").count().collect()
    assert {r.month: r["count"] for r in rows} == {dt.date(2007, 10, 1): 2, dt.date(2015, 1, 1): 1}


def test_path_month(spark):
    keys = ["2007/RC_2007-10", "2007/", "a/2007/RC_2007-10", "2015/RC_2015-1", "RC_2007-10"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {r.key: (r.year, r.month) for r in CM.path_month(df).collect()}
    assert got == {"2007/RC_2007-10": (2007, 10), "2015/RC_2015-1": (2015, 1)}


def test_period_prunes_partitions(spark):
    path = fresh_path(spark, "parts")
    spark.createDataFrame([(1, 2007, 10), (2, 2008, 1)], "id int, year int, month int").write.partitionBy("year", "month").parquet(path)
    chosen = CM.select_period(spark.read.parquet(path), 2008, 1)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert [r.id for r in chosen.collect()] == [2]


def test_lists(spark):
    path = fresh_path(spark, "names")
    names = [f"Name{i}  " for i in range(500)]
    write_lines(spark, path, names)
    listed = lists.scan_name_list(spark, path)
    first = lists.whitelist_top_k(listed, 3).collect()
    assert [r.name for r in first] == ["name0", "name1", "name2"]
    raw = spark.createDataFrame([("pics 1,234",), ("a b 3",), ("one",), ("x 7 ",)], "value string")
    assert [tuple(r) for r in lists.clean_whitelist(raw).collect()] == [("pics", 1234), ("x", 7)]
    raw = spark.createDataFrame([("/r/a /r/b ",), ("/r/c",), ("none",)], "value string")
    assert [r.name for r in lists.clean_blacklist(raw).collect()] == ["a", "b", "c"]


def test_messages(spark):
    path = fresh_path(spark, "tweets")
    write_lines(
        spark,
        path,
        [
            '{"id_str": "1", "text": "t", "user": {"id_str": "u"}}',
            '{"id_str": "2", "text": "t", "user": {"id_str": "v"}, "retweeted_status": {"id_str": "1"}}',
        ],
    )
    got = messages.project_tweet(messages.scan_tweets(spark, path)).orderBy("id").collect()
    assert [(r.id, r.user.id_str, r.retweeted, r.retweet_id) for r in got] == [
        ("1", "u", False, "1"),
        ("2", "v", True, "1"),
    ]


GEXF = """<?xml version="1.0" encoding="UTF-8"?>
<gexf xmlns="http://www.gexf.net/1.3" version="1.3" xmlns:viz="http://www.gexf.net/1.3/viz">
  <graph defaultedgetype="undirected" mode="static">
    <nodes>
      <node id="a" label="A&amp;B">
        <attvalues><attvalue for="modularity_class" value="2"></attvalue></attvalues>
        <viz:size value="10.0"></viz:size>
      </node>
      <node id="b" label="b" />
    </nodes>
    <edges>
      <edge id="0" source="a" target="b" weight="6.0"></edge>
      <edge id="1" source="b" target="c" />
    </edges>
  </graph>
</gexf>"""


def test_graph_file(spark, tmp_path):
    path = tmp_path / "g.gexf"
    path.write_text(GEXF)
    nodes = gexf.scan_gexf_nodes(spark, str(path)).orderBy("id").collect()
    assert [tuple(r) for r in nodes] == [("a", "A&B", 2), ("b", "b", None)]
    edges = gexf.scan_gexf_edges(spark, str(path)).orderBy("id").collect()
    assert [tuple(r) for r in edges] == [("0", "a", "b", 6), ("1", "b", "c", 1)]


def test_a_graph_document_comes_back_and_is_xml(spark, tmp_path):
    from xml.etree import ElementTree

    rows = [("a&b", 'c"<d>', 7), ("a&b", "e f", 1), *((f"n{i:03}", f"n{i + 1:03}", i + 1) for i in range(300))]
    edges = spark.createDataFrame(rows, "src string, dst string, weight long").repartition(3)
    nodes = sorted({n for r in rows for n in r[:2]})
    labels = spark.createDataFrame([(n, nodes[0] if i % 2 else "n000") for i, n in enumerate(nodes) if n != "e f"], "node string, community string")
    folder, joined = tmp_path / "parts", tmp_path / "graph.gexf"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    gexf.write_document(edges, labels, str(folder))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(folder.glob("part-*"))
    joined.write_bytes(b"".join(p.read_bytes() for p in parts))
    tree = ElementTree.parse(joined).getroot()
    space = {"g": "http://www.gexf.net/1.3"}
    assert [n.get("id") for n in tree.iterfind("g:graph/g:nodes/g:node", space)] == nodes
    assert len(parts) > 1 and len(list(tree.iterfind("g:graph/g:edges/g:edge", space))) == len(rows)
    back = gexf.scan_gexf_edges(spark, str(joined)).select("src", "dst", "weight")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    classes = {r.node: r.community for r in gexf.scan_gexf_classes(spark, str(joined)).collect()}
    assert classes == {n: None for n in nodes} | {r.node: r.community for r in labels.collect()}
