"""Tables with versions: crashes, replays, readers, compaction, roll-back, buckets."""

import pytest
from pyspark.sql import functions as F

from chatterscope.session import fresh_path
from chatterscope.sources import tables, versions
from chatterscope.streaming import pages as SP

ROWS = "batch long, k string, v long"


def state(spark, table, version=None):
    rows = versions.read(spark, table, version)
    return {r.k: r.v for r in tables.upsert_last_wins(rows, ["k"]).collect()}


@pytest.fixture
def table(spark):
    path = fresh_path(spark, "versioned")
    versions.replace_parts(spark.createDataFrame([(0, "a", 1), (0, "b", 2)], ROWS), path)
    versions.replace_parts(spark.createDataFrame([(1, "a", 5), (1, "c", 3)], ROWS), path)
    return path


def test_parts_are_replaced_and_replays_change_nothing(spark, table):
    again = spark.createDataFrame([(0, "a", 1), (0, "b", 2)], ROWS)
    for _ in range(2):
        versions.replace_parts(again, table)
        assert state(spark, table) == {"a": 5, "b": 2, "c": 3}
        assert versions.read(spark, table).count() == 4
    versions.replace_parts(again.where("k = 'b'"), table, owned=[0, 1])
    assert state(spark, table) == {"b": 2}


def test_a_writer_that_dies_before_the_switch_leaves_the_version(spark, table, monkeypatch):
    def die(*args, **changed):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "_switch", die)
    with pytest.raises(RuntimeError):
        versions.replace_parts(spark.createDataFrame([(1, "a", 99)], ROWS), table)
    monkeypatch.undo()
    assert state(spark, table) == {"a": 5, "b": 2, "c": 3}
    versions.replace_parts(spark.createDataFrame([(1, "a", 99)], ROWS), table)
    assert state(spark, table) == {"a": 99, "b": 2}


def test_two_writers_of_one_version_do_not_overwrite_each_other(spark, table):
    held = versions.manifest(spark, table)
    versions._switch(spark, table, held)
    with pytest.raises(Exception, match="exists"):
        versions._switch(spark, table, held, parts={})
    assert state(spark, table) == {"a": 5, "b": 2, "c": 3}


def test_readers_go_on_while_a_table_is_compacted_and_rolled_back(spark, table):
    before = versions.versions(spark, table)[-1]
    reader = versions.read(spark, table)
    last = versions.compact(spark, table, 1, lambda rows: tables.last_rows(rows, ["k"]))
    assert reader.count() == 4 and versions.read(spark, table).count() == 3
    assert state(spark, table) == {"a": 5, "b": 2, "c": 3}
    assert list(versions.manifest(spark, table)["parts"]) == ["1"]
    versions.replace_parts(spark.createDataFrame([(2, "a", 7)], ROWS), table)
    assert state(spark, table)["a"] == 7
    assert versions.roll_back(spark, table, last) == last + 2
    assert state(spark, table)["a"] == 5 and state(spark, table, last + 1)["a"] == 7
    versions.expire(spark, table, keep=1)
    assert versions.versions(spark, table) == [last + 2] and state(spark, table)["a"] == 5
    with pytest.raises(Exception):
        versions.manifest(spark, table, before)


def test_a_table_without_versions(spark):
    path = fresh_path(spark, "versioned")
    with pytest.raises(ValueError):
        versions.read(spark, path)
    assert versions.read(spark, path, schema=ROWS).count() == 0
    assert versions.compact(spark, path, 5, lambda rows: rows) == -1


def test_merges_touch_only_their_buckets_and_lookups_read_one(spark):
    path = fresh_path(spark, "bucketed")
    schema = "title string, id string, linksto array<string>, batch long"
    rows = [(f"t{i}", f"i{i}", [str(i)], 0) for i in range(400)]
    versions.merge_buckets(spark.createDataFrame(rows, schema), path, "title", SP.last_pages, 16, ("stream", 0))
    first = versions.manifest(spark, path)["parts"]
    assert len(first) == 16
    update = spark.createDataFrame([("t7", "i7", ["new"], 1), ("fresh", "x", [], 1)], schema)
    for _ in range(2):  # the second time it is a replay
        n = versions.merge_buckets(update, path, "title", SP.last_pages, 4, ("stream", 1))
        assert n == 1
    then = versions.manifest(spark, path)["parts"]
    assert 1 <= sum(then[p] != first[p] for p in then) <= 2
    versions.merge_buckets(update, path, "title", SP.last_pages, batch=("other", 1))
    assert versions.read(spark, path).count() == 401
    found = versions.lookup(spark, path, "title", "t7")
    assert [r.linksto for r in found.collect()] == [["new"]]
    folders = {f.rsplit("/", 1)[0].rsplit("/", 1)[1] for f in found.inputFiles()}
    assert len(folders) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "IsNotNull(title)" in plan


def test_one_title_of_the_backlink_table(spark):
    path = fresh_path(spark, "pages")
    pages = spark.createDataFrame([("a", "1", ["b"], 0), ("b", "2", [], 0)], SP.PAGE_ROWS)
    versions.merge_buckets(pages, f"{path}/pages", "title", SP.last_pages, 8)
    links = spark.createDataFrame([("b", "a"), ("c", "a")], SP.LINK_ROWS)
    versions.merge_buckets(links, f"{path}/links", "target", lambda rows: rows.distinct(), 8)
    whole = sorted(map(tuple, SP.backlinks(spark, path).select("title", "id", "source").collect()))
    assert whole == [("a", "1", None), ("b", "2", "a"), ("c", None, "a")]
    for title, expected in (("b", [("b", "2", "a")]), ("c", [("c", None, "a")]), ("none", [])):
        assert [tuple(r) for r in SP.backlinks(spark, path, title).select("title", "id", "source").collect()] == expected


def test_last_rows_settle_ties_without_sorting_long_values(spark):
    rows = [(0, "a", "x"), (1, "a", "p"), (1, "a", "q"), (1, None, "n"), (0, None, "m"), (1, "b", None)]
    df = spark.createDataFrame(rows, "batch long, k string, text string")
    last = {r.k: (r.batch, r.text) for r in tables.last_rows(df, ["k"]).collect()}
    assert last == {"a": (1, "q"), None: (1, "n"), "b": (1, None)}
    assert tables.last_rows(df.select("batch", "k"), ["k"]).count() == 3
    assert F.col("k") is not None
