"""Batch tables: repeated batches change nothing."""

import os

import pytest

from chatterscope import session
from chatterscope.plans import registry
from chatterscope.session import fresh_path
from chatterscope.sources import tables


def test_last_batch_wins_and_replay_is_idempotent(spark):
    path = fresh_path(spark, "t")
    schema = "batch int, k string, v bigint"
    first = spark.createDataFrame([(0, "a", 1), (0, "b", 2)], schema)
    second = spark.createDataFrame([(1, "a", 0), (1, "c", 3)], schema)
    for df in (first, second, first, second):
        tables.write_batches(df, path)
        read = tables.read_batches(spark, path)
    assert {r.k: r.v for r in tables.upsert_last_wins(read, ["k"]).collect()} == {"a": 0, "b": 2, "c": 3}
    sums = tables.merge_counters(read, ["k"], ["v"])
    assert {r.k: r.v for r in sums.collect()} == {"a": 1, "b": 2, "c": 3}


def test_compaction_keeps_the_state(spark):
    path, compacted = fresh_path(spark, "t"), fresh_path(spark, "t")
    schema = "batch int, k string, v bigint"
    tables.write_batches(spark.createDataFrame([(0, "a", 1), (1, "a", 5)], schema), path)
    merged = tables.upsert_last_wins(tables.read_batches(spark, path), ["k"])
    tables.compact(merged, compacted, upto=1)
    tables.write_batches(spark.createDataFrame([(2, "b", 7)], schema), compacted)
    state = tables.upsert_last_wins(tables.read_batches(spark, compacted), ["k"])
    assert {r.k: r.v for r in state.collect()} == {"a": 5, "b": 7}


def test_ties_and_maps(spark):
    rows = spark.createDataFrame(
        [(1, 7, "a", {"x": 1}), (1, 9, "a", {"x": 2}), (0, 99, "a", {"x": 3})],
        "batch int, seq int, k string, m map<string,int>",
    )
    last = tables.upsert_last_wins(rows, ["k"], ["batch", "seq"]).collect()
    assert [(r.seq, r.m) for r in last] == [(9, {"x": 2})]


def test_owned_batches_without_rows_are_emptied(spark):
    path = fresh_path(spark, "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "batch int, k string")
    tables.write_batches(rows, path, owned=[1, 2, 3])
    tables.write_batches(rows.where("batch = 2"), path, owned=[1, 2])
    assert {r.k for r in tables.read_batches(spark, path).collect()} == {"b", "c"}
    tables.write_batches(rows.limit(0), path, owned=[2, 3])
    assert tables.read_batches(spark, path, "k string, batch int").count() == 0


def test_set_union(spark):
    pages = spark.createDataFrame(
        [(0, "a", "1", ["x"]), (1, "a", "1", ["hot"]), (0, "b", "2", [])],
        "batch int, title string, id string, linksto array<string>",
    )
    links = spark.createDataFrame(
        [(0, "x", "a"), (1, "hot", "a")] + [(b, "hot", f"p{i}") for b in (0, 1) for i in range(20)],
        "batch int, target string, title string",
    )
    table = tables.upsert_set_union(pages, links)
    assert table.where("title = 'hot'").count() == 21
    rows = {r.title: (r.id, r.linksto, r.referredby) for r in tables.collect_backlinks(table).collect()}
    assert rows == {
        "hot": (None, None, sorted(["a"] + [f"p{i}" for i in range(20)])),
        "a": ("1", ["hot"], None),
        "b": ("2", [], None),
        "x": (None, None, ["a"]),
    }
    assert [r.title for r in tables.collect_backlinks(table, ["x"]).collect()] == ["x"]


@pytest.mark.parametrize("name", ["graph_for_year", "write_adjacency"])
def test_graphs_without_an_edge_are_empty_tables(spark, sf_dir, name):
    folder = fresh_path(spark, "tables")
    for table in ("lineitem", "orders", "part"):
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        (rows.limit(5) if table == "lineitem" else rows).write.parquet(f"{folder}/{table}.parquet")
    df = registry.queries()[name](spark, folder)
    assert df.columns and df.count() == 0


def test_upsert_in_rounds_leaves_no_shuffle_files(spark, sf_dir, monkeypatch):
    from tests.test_ngrams import shuffle_files

    query = registry.queries()["upsert_last_wins"]
    whole = set(query(spark, sf_dir).collect())
    monkeypatch.setattr(session, "ROUND_ROWS", 10_000, raising=False)
    before, folder = shuffle_files(spark), session.shared_folder(spark)
    written = set(os.listdir(folder))
    found = query(spark, sf_dir)
    assert shuffle_files(spark) <= before
    left = {name.partition("-")[0] for name in set(os.listdir(folder)) - written}
    assert left == {"cut"}  # the batch tables of the rounds are gone
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert set(found.collect()) == whole and found.count() == len(whole)
