"""Classes of graphs against plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from chatterscope.operators import clustering
from chatterscope.plans import graph_queries


def score(edges, labels):
    """Modularity times the square of twice the weight, a whole number."""
    two_m = 2 * sum(w for _, _, w in edges)
    strength, inside = Counter(), 0
    for a, b, w in edges:
        strength[labels[a]] += w
        strength[labels[b]] += w
        inside += 2 * w * (labels[a] == labels[b])
    return inside * two_m - sum(s * s for s in strength.values())


def partitions(nodes):
    if not nodes:
        yield {}
        return
    for rest in partitions(nodes[1:]):
        for name in [*sorted(set(rest.values())), nodes[0]]:
            yield {nodes[0]: name, **rest}


def graph(n, density, seed):
    rng = random.Random(seed)
    pairs = [(f"n{a}", f"n{b}") for a in range(n) for b in range(a + 1, n)]
    return [(a, b, rng.randint(1, 9)) for a, b in pairs if rng.random() < density] or [("n0", "n1", 1)]


def test_classes_of_small_graphs_are_settled(spark):
    """No node and no whole class can move for a gain; many graphs reach the best of all partitions."""
    graphs = {i: graph(3 + i % 6, 0.3 + 0.1 * (i % 5), i) for i in range(12)}
    rows = [(i, *e) for i, edges in graphs.items() for e in edges]
    edges = spark.createDataFrame(rows, "year long, src string, dst string, weight long")
    found = defaultdict(dict)
    for r in clustering.modularity_classes(edges, ["year"]).collect():
        found[r.year][r.node] = r.community
    best = 0
    for i, own in graphs.items():
        labels = found[i]
        assert set(labels) == {n for e in own for n in e[:2]}
        assert all(labels[name] == name == min(n for n in labels if labels[n] == name) for name in labels.values())
        reached = score(own, labels)
        names = set(labels.values())
        for node in labels:
            assert all(score(own, {**labels, node: c}) <= reached or c == labels[node] for c in [*names, "new"] if _near(own, labels, node, c))
        for a in names:
            for b in names - {a}:
                assert score(own, {n: b if c == a else c for n, c in labels.items()}) <= reached
        most = max(score(own, p) for p in partitions(sorted(labels)))
        assert reached <= most
        best += reached == most
    assert best >= 8


def _near(edges, labels, node, community):
    """Moves between neighbours; the nodes of the last level are classes, so single nodes of merged ones are not tried."""
    alone = sum(c == labels[node] for c in labels.values()) == 1
    return alone and any(labels[b if a == node else a] == community for a, b, _ in edges if node in (a, b))


def test_two_cliques_and_a_bridge(spark):
    edges = [(f"{side}{a}", f"{side}{b}", 5) for side in "xy" for a in range(6) for b in range(a + 1, 6)]
    edges += [("x0", "y0", 1), ("lone1", "lone2", 3)]
    df = spark.createDataFrame(edges, "src string, dst string, weight long")
    labels = {r.node: r.community for r in clustering.modularity_classes(df).collect()}
    assert labels == {n: ("lone1" if n[0] == "l" else f"{n[0]}0") for n in labels}
    assert len(labels) == 14
    again = {r.node: r.community for r in clustering.modularity_classes(df.repartition(3)).collect()}
    assert again == labels
    assert clustering.modularity_classes(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_modularity_is_at_least_that_of_settled_propagation(spark, seed):
    rng = random.Random(seed)
    block = lambda i: i // 12
    edges = [
        (f"n{a:02}", f"n{b:02}", rng.randint(1, 6))
        for a in range(60)
        for b in range(a + 1, 60)
        if rng.random() < (0.5 if block(a) == block(b) else 0.04)
    ]
    df = spark.createDataFrame(edges, "src string, dst string, weight long")
    louvain = {r.node: r.community for r in clustering.modularity_classes(df).collect()}
    spread = {r.node: r.community for r in clustering.communities(df).collect()}
    assert score(edges, louvain) >= score(edges, spread)
    assert 4 <= len(set(louvain.values())) <= 7


def brute_propagation(edges, rounds=5):
    arcs = [*edges, *((b, a, w) for a, b, w in edges)]
    labels = {n: n for a, b, _ in edges for n in (a, b)}
    done = 0
    while True:
        votes = defaultdict(Counter)
        for n, c in labels.items():
            votes[n][c] += 1
        for a, b, w in arcs:
            votes[b][labels[a]] += w
        new = {n: min(v, key=lambda c: (-v[c], c)) for n, v in votes.items()}
        if done >= rounds:
            new = {n: min(c, labels[n]) for n, c in new.items()}
        if new == labels:
            return labels
        labels, done = new, done + 1


def test_settled_communities(spark, sf_dir):
    edges = [tuple(r) for r in graph_queries.edges(spark, sf_dir).collect()]
    found = {r.node: r.community for r in graph_queries.communities_settled(spark, sf_dir).collect()}
    assert found == brute_propagation(edges)


def test_registered_classes(spark, sf_dir):
    edges = graph_queries.published(spark, sf_dir)
    rows = graph_queries.modularity_classes(spark, sf_dir)
    by_year = defaultdict(list)
    for r in edges.collect():
        by_year[r.year].append((r.src, r.dst, r.weight))
    labels = defaultdict(dict)
    for r in rows.collect():
        labels[r.year][r.node] = r.community
    assert set(labels) == set(by_year)
    for year, own in by_year.items():
        assert set(labels[year]) == {n for e in own for n in e[:2]}
    kept = {r.year: r.modularity for r in graph_queries.modularity_settled(spark, sf_dir).collect()}
    for year, own in by_year.items():
        two_m = 2 * sum(w for _, _, w in own)
        assert kept[year] == pytest.approx(score(own, labels[year]) / two_m**2, abs=1e-8)
