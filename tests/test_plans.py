"""What the plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from chatterscope.operators import graph as G
from chatterscope.operators import ngrams as N
from chatterscope.plans import fixtures as X
from chatterscope.plans import registry
from chatterscope.plans.activity_queries import events_as_comments
from chatterscope.operators import activity as A
from chatterscope.sources import tables


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def final_part(plan):
    return plan.split("Initial Plan")[0]


QUICK = sorted(set(registry.queries()) - {q for q in registry.queries() if q.startswith("stream_")})


@pytest.mark.parametrize("name", QUICK)
def test_no_python_workers_and_no_cross_joins(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    for word in ("PythonUDF", "EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert word not in plan, word


def test_text_is_tokenized_once_for_totals_and_counts(spark, sf_dir):
    table = N.monthly_table(X.comments(spark, sf_dir))
    plan = final_part(plan_of(table, run=True))
    assert "ReusedExchange" in plan and plan.count("FileScan parquet") == 1


@pytest.mark.parametrize("name", ["top_communities", "ngram_timeseries", "compare_ngrams"])
def test_stored_counts_spare_a_second_scan_of_the_texts(spark, sf_dir, name):
    plan = final_part(plan_of(registry.queries()[name](spark, sf_dir), run=True))
    assert "documents.parquet" not in plan


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    plan = plan_of(N.count_phrases(N.phrases(X.comments(spark, sf_dir), ["month"]), ["month"]))
    assert "partial_count" in plan


def test_scans_read_only_what_is_used(spark, sf_dir):
    plan = plan_of(A.daily_stats(events_as_comments(spark, sf_dir)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    year = X.table(spark, sf_dir, "orders").where(F.col("o_orderkey") == 7).select("o_custkey")
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,7)]" in plan_of(year)


def test_pairs_are_counted_where_they_are_made(spark):
    members = spark.createDataFrame([("u", "a"), ("u", "b")], "author string, community string")
    assert "partial_count" in plan_of(G.edge_weights(members))


@pytest.mark.parametrize("name", ["bucket_totals", "grand_total"])
def test_totals_shuffle_no_phrases(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    assert "Exchange" in plan and "ngram" not in plan


@pytest.mark.parametrize("name", ["prune_fixed", "relative_frequency", "community_rollup"])
def test_pruned_tables_shuffle_no_rare_phrases(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    assert "Exchange" not in plan and "documents.parquet" not in plan


def test_last_rows_of_numbers_are_shuffled_once(spark):
    rows = spark.createDataFrame([(0, "a", 5), (1, "a", 2), (1, "a", 3), (0, "b", None)], "batch int, k string, v bigint")
    last = tables.last_rows(rows, ["k"])
    assert final_part(plan_of(last)).count("Exchange") == 1
    assert {(r.batch, r.k, r.v) for r in last.collect()} == {(1, "a", 3), (0, "b", None)}


def test_totals_of_windows_are_those_of_counts(spark, sf_dir):
    comments = X.comments(spark, sf_dir)
    words = comments.select("month", N.tokenized(comments))
    counts = N.count_phrases(N.phrases(comments, ["month"]), ["month"])
    assert set(N.window_totals(words, ["month"]).collect()) == set(N.totals(counts, ["month"]).collect())


@pytest.mark.parametrize(
    "name", ["drop_stopword_windows", "bucket_totals", "grand_total", "unigram_min_length", "strip_punctuation", "ngram_all_n"]
)
def test_filters_do_not_tokenize_again(spark, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
