"""Communities that share active authors, as an undirected weighted graph.

Edges are rows (src, dst, weight), each pair once, oriented by (lower(name), name).  Key columns
that tell several graphs apart, such as the year, go through every operator as ``also``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterscope import constants as C
from chatterscope.session import cut_lineage

PAIR_BLOCK = 500


def _rank(name: Column) -> Column:
    return F.struct(F.lower(name), name)


def canonical_edge(a: Column, b: Column) -> list[Column]:
    """src and dst of a pair, by full name order."""
    ordered = _rank(a) <= _rank(b)
    return [
        F.when(ordered, a).otherwise(b).alias("src"),
        F.when(ordered, b).otherwise(a).alias("dst"),
    ]


def co_membership_pairs(
    members: DataFrame, also: Sequence[str] = (), block: int = PAIR_BLOCK
) -> DataFrame:
    """Every pair of communities that an author is active in: also, author, src, dst.

    ``members`` holds each (also, author, community) once.  Most authors' communities are gathered and paired in
    place.  Authors with more than ``block`` communities have them dealt to blocks, and each pair of blocks
    is a join key of its own, so no task gets more than about block x block pairs of one author.
    """
    key = [*also, "author"]
    members = members.select(*key, "community").dropna(subset=key)
    sizes = members.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
    # written, so that their number, mostly none, is known before all members are asked for them
    many = cut_lineage(sizes.select(*key, F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    # members are few rows but make many pairs: a fixed number of tasks, which AQE does not merge
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = members.join(many, key, "left_anti").repartition(tasks, *key)
    # in a struct, as a list of values leaves out those that are null
    lists = few.groupBy(*key).agg(F.collect_list(F.struct("community")).alias("all")).where(F.size("all") > 1)
    each = lists.select(*key, "all", F.posexplode("all").alias("at", "a"))
    later = F.slice("all", F.col("at") + 2, F.size("all"))
    near = each.select(*key, F.col("a.community").alias("a"), F.explode(later).alias("c"))
    near = near.select(*key, "a", F.col("c.community").alias("c"))
    near = near.where(~F.col("a").eqNullSafe(F.col("c")))

    dealt = members.join(many, key).withColumn(
        "b", F.pmod(F.xxhash64("community"), F.col("blocks")).cast("int")
    )
    left = dealt.select(
        *key,
        F.col("community").alias("a"),
        F.col("b").alias("i"),
        F.explode(F.sequence("b", F.col("blocks") - 1)).alias("j"),
    ).repartition(tasks, *key, "i", "j")
    right = dealt.select(
        *key,
        F.col("community").alias("c"),
        F.explode(F.sequence(F.lit(0), F.col("b"))).alias("i"),
        F.col("b").alias("j"),
    )
    far = left.join(right, [*key, "i", "j"]).where(
        (F.col("i") < F.col("j")) | (_rank(F.col("a")) < _rank(F.col("c")))
    )
    pairs = near.unionByName(far.select(*key, "a", "c"))
    return pairs.select(*key, *canonical_edge(F.col("a"), F.col("c")))


def edge_weights(
    members: DataFrame, also: Sequence[str] = (), more_than: int = 0, block: int = PAIR_BLOCK
) -> DataFrame:
    """Number of common authors per pair, for pairs with more than ``more_than``.

    A community with that few members cannot be on such an edge and is left out before pairing.
    Pairs are counted in the task that makes them; only partial counts are shuffled.  The members,
    which are few next to the comments, are written once because they are read several times.
    """
    members = cut_lineage(members)
    if more_than > 0:
        key = [*also, "community"]
        large_enough = (
            members.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("members"))
            .where(F.col("members") > more_than)
        )
        members = members.join(large_enough, key, "left_semi")
    edges = (
        co_membership_pairs(members, also, block)
        .groupBy(*also, "src", "dst")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    return prune_edges_min_weight(edges, more_than) if more_than > 0 else edges


def overlap_candidates(
    members: DataFrame, more_than: int, also: Sequence[str] = (), block: int = PAIR_BLOCK
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """also, src, dst, weight of the pairs that can have more than so many common authors, where
    weight counts the common authors that are rare in both; then the rare and the frequent members.

    A community's ``more_than`` authors with most communities are its frequent ones.  Two communities
    with more common authors than that share one that is rare in both.
    """
    key = [*also, "community"]
    spread_ = members.groupBy(*also, "author").agg(F.count(F.lit(1)).alias("communities"))
    first = Window.partitionBy(*key).orderBy(F.col("communities").desc(), "author")
    # the limit is applied in every task before the shuffle: so many rows of a community
    ranked = members.join(spread_, [*also, "author"]).withColumn("place", F.row_number().over(first))
    frequent = cut_lineage(ranked.where(F.col("place") <= more_than).select(*key, "author"))
    rare = cut_lineage(members.join(frequent, [*key, "author"], "left_anti").select(*key, "author"))
    pairs = co_membership_pairs(rare, also, block)
    return pairs.groupBy(*also, "src", "dst").agg(F.count(F.lit(1)).alias("weight")), rare, frequent


def overlap_edges(
    members: DataFrame, more_than: int, also: Sequence[str] = (), block: int = PAIR_BLOCK
) -> DataFrame:
    """Edges with more than so many common authors, equal to ``edge_weights`` with that limit.

    The authors of most communities, who make most pairs, are paired with nothing: only pairs that meet
    in rare authors are counted, and their frequent ones, a fixed number, looked up afterwards.
    """
    key = [*also, "community"]
    members = cut_lineage(members.select(*key, "author"))
    # one row for a community, written, so that its number is known before all members are asked for it
    large_enough = members.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than)
    members = cut_lineage(members.join(cut_lineage(large_enough.select(*key)), key, "left_semi"))
    found, rare, frequent = overlap_candidates(members, more_than, also, block)
    found = cut_lineage(found)
    # frequent authors are asked for only, a fixed number for each community
    asked_for = cut_lineage(frequent.select(*also, "author").distinct())

    def looked_up(end: str, other: str, theirs: DataFrame) -> DataFrame:
        """Pairs once for each frequent author of ``end`` among the other's members."""
        asked = found.drop("weight").join(frequent.withColumnRenamed("community", end), [*also, end])
        there = theirs.join(asked_for, [*also, "author"], "left_semi").withColumnRenamed("community", other)
        return asked.join(there, [*also, other, "author"], "left_semi").select(
            *also, "src", "dst", F.lit(1).cast("bigint").alias("weight")
        )

    every = found.unionByName(looked_up("src", "dst", members)).unionByName(looked_up("dst", "src", rare))
    weights = every.groupBy(*also, "src", "dst").agg(F.sum("weight").alias("weight"))
    return prune_edges_min_weight(weights, more_than)


def prune_edges_min_weight(edges: DataFrame, more_than: int = C.EDGE_AUTHORS) -> DataFrame:
    return edges.where(F.col("weight") > more_than)


def undirected(edges: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Edges given in either direction to one row per pair; the larger weight counts."""
    oriented = edges.select(*also, *canonical_edge(F.col("src"), F.col("dst")), "weight")
    return oriented.groupBy(*also, "src", "dst").agg(F.max("weight").alias("weight"))


def adjacency_rows(edges: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """also, node1, neighbour, weight: one row per edge, whatever a node's degree."""
    return edges.select(
        *also,
        F.col("src").alias("node1"),
        F.col("dst").alias("neighbour"),
        F.col("weight").cast("int").alias("weight"),
    )


def adjacency_map(
    rows: DataFrame, also: Sequence[str] = (), nodes: Sequence[str] | None = None
) -> DataFrame:
    """also, node1, node2 (map of neighbour to weight): one row per node, for the nodes asked for.

    Without ``nodes`` every node's map is built; a map holds all neighbours of its node.
    """
    if nodes is not None:
        rows = rows.where(F.col("node1").isin(list(nodes)))
    entries = F.array_sort(F.collect_list(F.struct("neighbour", "weight")))
    return rows.groupBy(*also, "node1").agg(F.map_from_entries(entries).alias("node2"))


def adjacency_edges(rows: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Adjacency rows back to edges."""
    return rows.select(*also, F.col("node1").alias("src"), F.col("neighbour").alias("dst"), "weight")


def prune_edges_relative(
    edges: DataFrame, also: Sequence[str] = (), share: float = C.RELATIVE_WEIGHT
) -> DataFrame:
    """Keep edges with weight > share * the largest weight of their src."""
    key = [*also, "src"]
    largest = edges.groupBy(*key).agg(F.max("weight").alias("largest"))
    return edges.join(largest, key).where(F.col("weight") > F.col("largest") * share).select(
        *also, "src", "dst", "weight"
    )


def exclude_nodes(edges: DataFrame, names: Sequence[str] = (C.GRAPH_SKIPPED_NODE,)) -> DataFrame:
    return edges.where(~F.col("src").isin(list(names)) & ~F.col("dst").isin(list(names)))


def endpoints(edges: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    return edges.select(*also, F.explode(F.array("src", "dst")).alias("node"))


def node_degree(edges: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    return endpoints(edges, also).groupBy(*also, "node").agg(F.count(F.lit(1)).alias("degree"))


def induced(edges: DataFrame, nodes: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Edges with both ends among the nodes."""
    for end in ("src", "dst"):
        kept = nodes.select(*also, F.col("node").alias(end))
        edges = edges.join(kept, [*also, end], "left_semi")
    return edges


def drop_hubs(
    edges: DataFrame, also: Sequence[str] = (), below: int = C.HUB_DEGREE
) -> DataFrame:
    """The subgraph of nodes with a degree below the limit."""
    return induced(edges, node_degree(edges, also).where(F.col("degree") < below), also)


def drop_isolated(edges: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Nodes that still have an edge."""
    return endpoints(edges, also).distinct()


def prune_edges_absolute(edges: DataFrame, cutoff: int = C.HUB_DEGREE) -> DataFrame:
    return edges.where(F.col("weight") > cutoff)


def edge_weight_range(edges: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    return edges.groupBy(*also).agg(
        F.max("weight").alias("max_weight"), F.min("weight").alias("min_weight")
    )


def graph_by_year(
    edges: DataFrame, below: int = C.HUB_DEGREE, also: Sequence[str] = ("year",)
) -> DataFrame:
    """The published graph of every year: relative pruning, skipped nodes, hubs dropped.

    ``edges`` should be a stored table, as it is read twice; so is the pruned graph.
    """
    pruned = cut_lineage(exclude_nodes(prune_edges_relative(edges, also)))
    return drop_hubs(pruned, also, below)


def ego_network(edges: DataFrame, label: str, also: Sequence[str] = ()) -> DataFrame:
    """A node, its neighbours and all edges among them."""
    touching = edges.where((F.col("src") == label) | (F.col("dst") == label))
    return induced(edges, endpoints(touching, also).distinct(), also)


def export_graph(edges: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """GEXF elements, one text row each: also, kind (node or edge), element."""

    def escaped(name: str) -> Column:
        col = F.col(name)
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            col = F.replace(col, F.lit(char), F.lit(entity))
        return col

    nodes = drop_isolated(edges, also).select(
        *also,
        F.lit("node").alias("kind"),
        F.format_string('<node id="%s" label="%s" />', escaped("node"), escaped("node")).alias(
            "element"
        ),
    )
    links = edges.select(
        *also,
        F.lit("edge").alias("kind"),
        F.format_string(
            '<edge id="%s" source="%s" target="%s" weight="%d" />',
            F.sha2(F.concat_ws("\x01", "src", "dst"), 256),
            escaped("src"),
            escaped("dst"),
            F.col("weight"),
        ).alias("element"),
    )
    return nodes.unionByName(links)
