"""Community classes of a graph and their modularity."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.operators.graph import endpoints
from chatterscope.session import cut_lineage


def communities(
    edges: DataFrame, rounds: int = 5, also: Sequence[str] = (), settle: bool = True
) -> DataFrame:
    """Weighted label propagation: also, node, community.

    All nodes start with their own name and take, in every round, the label with the largest
    weight among their neighbours and themselves (their own label counts with weight 1, which
    calms oscillation); ties go to the smaller label.  Every round's labels are written, which
    keeps plans short.  They end when no label changes.

    After ``rounds`` of them labels may still swing between neighbours.  ``settle`` goes on with
    rounds in which a node only takes a smaller label, until none changes; as labels only
    become smaller, that ends.  Without it a warning tells when labels still change.
    """
    arcs = edges.select(*also, "src", "dst", "weight").unionByName(
        edges.select(*also, F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    arcs = cut_lineage(arcs)
    labels = endpoints(edges, also).distinct().withColumn("community", F.col("node"))
    done = 0
    while done < rounds or settle:
        heard = arcs.join(labels.withColumnRenamed("node", "src"), [*also, "src"]).select(
            *also, F.col("dst").alias("node"), "community", "weight"
        )
        own = labels.select(*also, "node", "community", F.lit(1).cast("bigint").alias("weight"))
        votes = (
            heard.unionByName(own)
            .groupBy(*also, "node", "community")
            .agg(F.sum("weight").alias("votes"))
        )
        best = F.min(F.struct((-F.col("votes")).alias("rank"), "community"))
        chosen = votes.groupBy(*also, "node").agg(best.alias("best"))
        chosen = chosen.select(*also, "node", F.col("best.community"))
        if done >= rounds:
            before = labels.withColumnRenamed("community", "before")
            smaller = F.least("community", "before").alias("community")
            chosen = chosen.join(before, [*also, "node"]).select(*also, "node", smaller)
        chosen = cut_lineage(chosen)
        moved = chosen.join(labels, [*also, "node", "community"], "left_anti").limit(1).count()
        labels, done = chosen, done + 1
        if not moved:
            return labels
    warnings.warn(f"labels still change after {rounds} rounds", stacklevel=2)
    return labels


def modularity(edges: DataFrame, labels: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Per graph: sum over classes of inside/m - (degree/2m)^2, with weights."""
    ends = edges.select(
        *also, F.explode(F.array("src", "dst")).alias("node"), "src", "dst", "weight"
    )
    strength = (
        ends.groupBy(*also, "node")
        .agg(F.sum("weight").alias("strength"))
        .join(labels, [*also, "node"])
        .groupBy(*also, "community")
        .agg(F.sum("strength").alias("strength"))
    )
    inside = edges
    for end in ("src", "dst"):
        named = labels.select(
            *also, F.col("node").alias(end), F.col("community").alias(f"{end}_class")
        )
        inside = inside.join(named, [*also, end])
    inside = (
        inside.where(F.col("src_class") == F.col("dst_class"))
        .groupBy(*also, F.col("src_class").alias("community"))
        .agg(F.sum("weight").alias("inside"))
    )
    classes = strength.join(inside, [*also, "community"], "left").withColumn(
        "inside", F.coalesce("inside", F.lit(0))
    )
    # all strengths together are 2m
    two_m = F.sum("strength").cast("double")
    return classes.groupBy(*also).agg(
        F.count(F.lit(1)).alias("classes"),
        (
            2 * F.sum("inside") / two_m
            - F.sum(F.col("strength").cast("double") * F.col("strength")) / (two_m * two_m)
        ).alias("modularity"),
    )


def _exact(number: str | Column) -> Column:
    return (F.col(number) if isinstance(number, str) else number).cast("decimal(19,0)")


def _gains(arcs: DataFrame, nodes: DataFrame, also: list[str], turn: int) -> DataFrame:
    """also, node, label, strength, target, gain of the nodes that gain by moving to their best target.

    Weights are whole numbers and so are the gains: modularity gains times half the square of the sum of
    strengths.  Ties go to the smaller target.  A node may also move to a class of its own.
    """
    sums = nodes.groupBy(*also, "label").agg(F.sum("strength").alias("sum"))
    totals = sums.groupBy(*also).agg(F.sum("sum").alias("two_m"))
    state = nodes.join(sums, [*also, "label"]).join(totals, also)
    near = nodes.select(*also, F.col("node").alias("other"), F.col("label").alias("target"))
    votes = (
        arcs.where(F.col("node") != F.col("other"))
        .join(near, [*also, "other"])
        .groupBy(*also, "node", "target")
        .agg(F.sum("weight").alias("votes"))
        .join(sums.withColumnsRenamed({"label": "target", "sum": "joined"}), [*also, "target"])
    )
    none = F.lit(0).cast("bigint")
    alone = F.concat("node", F.lit(f"\x00{turn}")).alias("target")
    votes = votes.unionByName(
        nodes.select(*also, "node", alone, none.alias("votes"), none.alias("joined"))
    )
    k, two_m = _exact("strength"), _exact("two_m")
    go = _exact("votes") * two_m - k * _exact("joined")
    best = votes.join(state, [*also, "node"]).groupBy(
        *also, "node", "label", "strength", "sum", "two_m"
    ).agg(
        F.min(F.when(F.col("target") != F.col("label"), F.struct((-go).alias("cost"), "target"))).alias("best"),
        F.max(F.when(F.col("target") == F.col("label"), F.col("votes"))).alias("own"),
    )
    stay = _exact(F.coalesce("own", none)) * two_m - k * _exact(F.col("sum") - F.col("strength"))
    return best.select(
        *also, "node", "label", "strength", "best.target", (-F.col("best.cost") - stay).alias("gain")
    ).where(F.col("gain") > 0)


def _chosen(gains: DataFrame, also: list[str], turn: int) -> DataFrame:
    """also, node, target of moves that together raise modularity.

    In a turn a class only loses or only takes nodes, by a coin, so that neighbours do not swap; the
    class that the best move leaves loses and the one it goes to takes.  Two moves that leave or
    reach the same class cost each other at most the product of their strengths.  A move is made if its
    gain covers that for all others, or if it is the best of those that leave and reach its classes.
    """
    first = F.min(F.struct((-F.col("gain")).alias("cost"), "node", "label", "target"))
    best = gains.groupBy(*also).agg(first.alias("best"))
    coin = lambda c: F.pmod(F.xxhash64(c, F.lit(turn)), F.lit(2)) == 1
    takes = lambda c: (F.col(c) == F.col("best.target")) | ((F.col(c) != F.col("best.label")) & coin(c))
    fit = gains.join(best, also).where(~takes("label") & takes("target")).drop("best")

    def crowd(end: str) -> DataFrame:
        return fit.groupBy(*also, end).agg(
            F.sum("strength").alias(f"{end}_sum"),
            F.min(F.struct((-F.col("gain")).alias("cost"), "node"))["node"].alias(f"{end}_first"),
        )

    met = fit.join(crowd("label"), [*also, "label"]).join(crowd("target"), [*also, "target"])
    others = _exact(F.col("label_sum") + F.col("target_sum") - 2 * F.col("strength"))
    alone = (F.col("node") == F.col("label_first")) & (F.col("node") == F.col("target_first"))
    return met.where(alone | (F.col("gain") > _exact("strength") * others)).select(*also, "node", "target")


def modularity_classes(edges: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """also, node, community: classes by local moving and contraction, as the published graphs have.

    At first every node is a class.  Nodes move to the neighbouring class that raises modularity most until
    no move raises it; then classes become nodes, their edges are added up, and it starts again, until
    a level moves nothing.  Every turn raises modularity, so it ends.  Gains are exact and ties go by
    name, so results are equal in every run.  A class is named after its smallest node.

    Per turn: two joins of the arcs, which stay where they are, with the nodes, and a written table of
    moves.  Weights are whole numbers below 10^18 in sum.
    """
    keys = list(also) or ["graph"]
    edges = edges.select(*also, "src", "dst", "weight") if also else edges.select(F.lit(0).alias("graph"), "src", "dst", "weight")
    arcs = edges.select(*keys, F.col("src").alias("node"), F.col("dst").alias("other"), "weight")
    arcs = cut_lineage(arcs.unionByName(arcs.select(*keys, F.col("other").alias("node"), F.col("node").alias("other"), "weight")))
    found = arcs.select(*keys, "node").distinct().withColumn("community", F.col("node"))
    turn = 0
    while True:
        nodes = arcs.groupBy(*keys, "node").agg(F.sum("weight").alias("strength"))
        nodes = cut_lineage(nodes.withColumn("label", F.col("node")))
        settled = True
        while True:
            gains = cut_lineage(_gains(arcs, nodes, keys, turn))
            if not gains.limit(1).count():
                break
            settled, moves = False, _chosen(gains, keys, turn)
            moved = nodes.join(moves, [*keys, "node"], "left")
            nodes = cut_lineage(moved.select(*keys, "node", "strength", F.coalesce("target", "label").alias("label")))
            turn += 1
        if settled:
            break
        # classes are named after their smallest node, which no other class can be
        names = nodes.groupBy(*keys, "label").agg(F.min("node").alias("name"))
        named = cut_lineage(nodes.join(names, [*keys, "label"]).select(*keys, "node", "name"))
        found = found.join(named.withColumnRenamed("node", "community"), [*keys, "community"])
        found = cut_lineage(found.select(*keys, "node", F.col("name").alias("community")))
        for end in ("node", "other"):
            ends = named.select(*keys, F.col("node").alias(end), F.col("name").alias(f"{end}_name"))
            arcs = arcs.join(ends, [*keys, end])
        arcs = arcs.groupBy(*keys, F.col("node_name").alias("node"), F.col("other_name").alias("other"))
        arcs = cut_lineage(arcs.agg(F.sum("weight").alias("weight")))
    return found.select(*also, "node", "community")
