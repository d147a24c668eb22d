"""Author graph against brute force."""

from collections import Counter
from itertools import combinations

import pytest

from chatterscope.operators import activity as A
from chatterscope.operators import clustering, followers
from chatterscope.operators import graph as G


def rank(name):
    return (name.lower(), name)


def brute_weights(members):
    groups = {}
    for author, community in members:
        groups.setdefault(author, set()).add(community)
    return Counter(
        pair for g in groups.values() for pair in combinations(sorted(g, key=rank), 2)
    )


def weights(df):
    return {(r.src, r.dst): r.weight for r in df.collect()}


@pytest.mark.parametrize("block", [1, 3, 1000])
@pytest.mark.parametrize("more_than", [0, 2])
def test_edge_weights_with_a_hot_author(spark, block, more_than):
    names = [f"{'aAbB'[i % 4]}{i % 11}" for i in range(44)]
    members = {("hot", n) for n in names}
    members |= {(f"u{i}", names[(i * j) % 44]) for i in range(40) for j in (1, 3, 5)}
    members |= {("single", names[0])}
    df = spark.createDataFrame(sorted(members), "author string, community string")
    expected = {p: w for p, w in brute_weights(members).items() if w > more_than}
    assert weights(G.edge_weights(df, more_than=more_than, block=block)) == expected


def test_every_pair_once_in_canonical_order(spark):
    members = [("u", c) for c in ("b", "B", "a", "C")]
    df = spark.createDataFrame(members, "author string, community string")
    got = sorted((r.src, r.dst) for r in G.co_membership_pairs(df).collect())
    assert got == sorted(combinations(sorted("bBaC", key=rank), 2))


def test_default_limits(spark):
    rows = [("u", "a", 50), ("u", "b", 51), ("v", "b", 60)]
    act = spark.createDataFrame(rows, "author string, community string, comments bigint")
    assert {(r.author, r.community) for r in A.active_memberships(act).collect()} == {("u", "b"), ("v", "b")}
    e = spark.createDataFrame([("a", "b", 5), ("a", "c", 6)], "src string, dst string, weight bigint")
    assert weights(G.prune_edges_min_weight(e)) == {("a", "c"): 6}


def test_system_accounts_and_nulls_are_dropped(spark):
    rows = [("[deleted]", "x"), ("AutoModerator", "x"), (None, "x"), ("u", "AskReddit"), ("u", "reddit.com"), ("u", None), ("u", "x"), ("u", "x")]
    got = A.author_activity(spark.createDataFrame(rows, "author string, community string")).collect()
    assert [(r.author, r.community, r.comments) for r in got] == [("u", "x", 2)]


def edge_frame(spark, rows):
    return spark.createDataFrame(rows, "src string, dst string, weight bigint")


def test_relative_pruning_uses_the_largest_weight_of_src(spark):
    e = edge_frame(spark, [("a", "b", 100), ("a", "c", 20), ("a", "d", 21), ("b", "c", 1), ("a", "reddit.com", 200)])
    kept = weights(G.exclude_nodes(G.prune_edges_relative(e)))
    assert kept == {("a", "b"): 100, ("b", "c"): 1}


def test_hubs_and_isolated(spark):
    rows = [("hub", f"n{i}", 9) for i in range(5)] + [("n0", "n1", 9)]
    e = edge_frame(spark, rows)
    assert {r.node: r.degree for r in G.node_degree(e).collect()}["hub"] == 5
    left = G.drop_hubs(e, below=5)
    assert weights(left) == {("n0", "n1"): 9}
    assert {r.node for r in G.drop_isolated(left).collect()} == {"n0", "n1"}


def test_adjacency_round_trip(spark):
    rows = [("hub", f"n{i}", i + 1) for i in range(9)] + [("n0", "n1", 4)]
    stored = G.adjacency_rows(edge_frame(spark, rows))
    assert weights(G.adjacency_edges(stored)) == {(a, b): w for a, b, w in rows}
    assert {r.node1: r.node2 for r in G.adjacency_map(stored).collect()} == {
        "hub": {f"n{i}": i + 1 for i in range(9)},
        "n0": {"n1": 4},
    }
    assert [r.node1 for r in G.adjacency_map(stored, nodes=["n0"]).collect()] == ["n0"]


def test_undirected_keeps_the_larger_weight(spark):
    e = edge_frame(spark, [("b", "A", 3), ("A", "b", 5), ("c", "d", 1)])
    assert weights(G.undirected(e)) == {("A", "b"): 5, ("c", "d"): 1}


def test_ego_network(spark):
    e = edge_frame(spark, [("a", "b", 1), ("a", "c", 1), ("b", "c", 1), ("c", "d", 1), ("d", "e", 1)])
    assert set(weights(G.ego_network(e, "a"))) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert weights(G.ego_network(e, "nobody")) == {}


def test_two_cliques_become_two_classes(spark):
    rows = [(a, b, 5) for group in ("abcd", "wxyz") for a, b in combinations(group, 2)]
    e = edge_frame(spark, rows + [("d", "w", 1)])
    labels = {r.node: r.community for r in clustering.communities(e, 4).collect()}
    assert len({labels[n] for n in "abcd"}) == 1 and len({labels[n] for n in "wxyz"}) == 1
    assert labels["a"] != labels["w"]
    score = clustering.modularity(e, clustering.communities(e, 4)).first()
    m, inside, ends = 61.0, 30.0, 61.0
    assert score.classes == 2
    assert abs(score.modularity - 2 * (inside / m - (ends / (2 * m)) ** 2)) < 1e-12


def test_follower_walk(spark):
    rows = [(2, 1), (3, 1), (4, 2), (1, 4), (5, 4), (6, 9)]
    e = spark.createDataFrame(rows, "follower bigint, parent bigint")
    got = {r.account: r.hop for r in followers.k_hop_followers(e, 1, 5).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 2, 5: 3}
    influential = followers.influential_followers(e, 1, 3, limits=(1, 2))
    assert {r.account: r.hop for r in influential.collect()} == {2: 1, 4: 2}


def test_daily_stats(spark):
    rows = [("0", "u", "a"), ("10", "u", "b"), ("86400", "v", "a"), ("86401", "w", "a")]
    df = spark.createDataFrame(rows, "created_utc string, author string, community string")
    got = sorted((str(r.date), r.communities, r.comments, r.authors) for r in A.daily_stats(df).collect())
    assert got == [("1970-01-01", 2, 2, 1), ("1970-01-02", 1, 2, 2)]
    series = A.export_series_json(A.stats_series(A.daily_stats(df)))
    docs = {r.metric: r.document for r in series.collect()}
    assert docs["comments"] == "[[0,2],[86400000,2]]"


def test_a_walk_without_a_number_of_hops_ends(spark):
    from chatterscope.operators.followers import k_hop_followers

    rows = [(k, k + 1) for k in range(5)] + [(5, 0), (9, 8)]
    edges = spark.createDataFrame(rows, "parent bigint, follower bigint")
    reached = {r.account: r.hop for r in k_hop_followers(edges, 0, None).collect()}
    assert reached == {k: k for k in range(6)}


def test_classes_settle(spark):
    from chatterscope.operators.clustering import communities

    pair = edge_frame(spark, [("a", "b", 10), ("c", "d", 3), ("d", "e", 3)])
    found = {r.node: r.community for r in communities(pair, 2).collect()}
    assert found["a"] == found["b"] == "a" and len({found[n] for n in "cde"}) == 1


def test_edges_by_overlap_equal_all_pairs_and_need_fewer(spark):
    import random

    from chatterscope.operators import graph as G

    rng = random.Random(4)
    rows = {(y, f"u{rng.randrange(60)}", f"c{int(rng.paretovariate(0.6)) % 40}") for y in (1, 2) for _ in range(900)}
    rows |= {(1, "everywhere", f"c{i}") for i in range(40)} | {(1, "bot", f"C{i}") for i in range(300)}
    members = spark.createDataFrame(sorted(rows), "year long, author string, community string")
    for more_than in (1, 3, 5):
        expected = G.edge_weights(members, ["year"], more_than)
        got = G.overlap_edges(members, more_than, ["year"])
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
        assert expected.count() > 0
        rare = G.overlap_candidates(members, more_than, ["year"])[0]
        paired = rare.agg({"weight": "sum"}).first()[0]
        every = G.edge_weights(members, ["year"]).agg({"weight": "sum"}).first()[0]
        assert paired < every / 2
    assert G.overlap_edges(members.drop("year").distinct().limit(0), 2).count() == 0


def test_most_authors_are_paired_in_place(spark):
    rows = [("a", c) for c in "xYz"] + [("b", c) for c in "vwxYz"] + [("c", "x"), (None, "x"), (None, "v")]
    members = spark.createDataFrame(rows, "author string, community string")
    whole = {("a", p, q) for p, q in ("xY", "xz", "Yz")} | {
        ("b", p, q) for p, q in ("vw", "vx", "vY", "vz", "wx", "wY", "wz", "xY", "xz", "Yz")
    }
    for block in (1, 3, 4, 500):  # all, some and none of the authors are dealt to blocks
        pairs = G.co_membership_pairs(members, block=block)
        got = [(r.author, r.src, r.dst) for r in pairs.collect()]
        assert len(got) == len(whole) and set(got) == whole
    assert "collect_list" in pairs._jdf.queryExecution().optimizedPlan().toString()
