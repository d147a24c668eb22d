"""Registered queries: author graph, pruning, classes, follower walks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.operators import clustering, followers
from chatterscope.operators import graph as G
from chatterscope.plans import fixtures as X
from chatterscope.plans.catalog import Catalog
from chatterscope.plans.source_queries import FOLLOWERS, follower_edges
from chatterscope.session import cut_lineage, fresh_path
from chatterscope.sources import gexf, tables

CATALOG = Catalog()
query = CATALOG.query

# Members: customers that bought a brand and type in a year (yearly graphs) or at least twice
# (one graph over all years).  Brand#2 plays the node that the published graphs skip.
BOUGHT = """bought AS (
SELECT o_custkey AS author, year(o_orderdate) AS year,
       CASE WHEN p_brand = 'Brand#2' THEN 'reddit.com'
            WHEN p_size % 2 = 0 THEN lower(p_brand) || '/' || p_type
            ELSE p_brand || '/' || p_type END AS community
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
members AS (SELECT author, community FROM bought GROUP BY ALL HAVING count(*) > 1),
yearly AS (SELECT DISTINCT year, author, community FROM bought),
pairs AS (SELECT a.author, a.community AS src, b.community AS dst FROM members a JOIN members b
  ON a.author = b.author AND (lower(a.community), a.community) < (lower(b.community), b.community)),
edges AS (SELECT src, dst, count(*) AS weight FROM pairs GROUP BY ALL),
kept AS (SELECT * FROM edges WHERE weight > 2),
year_edges AS (SELECT a.year, a.community AS src, b.community AS dst, count(*) AS weight
  FROM yearly a JOIN yearly b ON a.author = b.author AND a.year = b.year
   AND (lower(a.community), a.community) < (lower(b.community), b.community) GROUP BY ALL),
year_kept AS (SELECT * FROM year_edges WHERE weight > 3)"""
RELATIVE = f"""WITH {BOUGHT},
largest AS (SELECT year, src, max(weight) AS largest FROM year_kept GROUP BY ALL),
relative AS (SELECT e.* FROM year_kept e JOIN largest USING (year, src) WHERE weight > largest * 0.2::DOUBLE),
excluded AS (SELECT * FROM relative WHERE src <> 'reddit.com' AND dst <> 'reddit.com'),
degree AS (SELECT year, node, count(*) AS degree FROM
  (SELECT year, unnest([src, dst]) AS node FROM excluded) GROUP BY ALL),
small AS (SELECT * FROM degree WHERE degree < 15),
hubless AS (SELECT e.* FROM excluded e SEMI JOIN small s ON e.year = s.year AND e.src = s.node
  SEMI JOIN small d ON e.year = d.year AND e.dst = d.node)"""
HUB_BELOW = 15


def bought(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = X.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    kind = F.concat(F.lit("/"), F.col("p_type"))
    return sold.select(
        F.col("o_custkey").alias("author"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.when(F.col("p_brand") == "Brand#2", "reddit.com")
        .when(F.col("p_size") % 2 == 0, F.concat(F.lower("p_brand"), kind))
        .otherwise(F.concat("p_brand", kind))
        .alias("community"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = bought(spark, sf_dir).groupBy("author", "community").agg(
        F.count(F.lit(1)).alias("comments")
    )
    return counted.where(F.col("comments") > 1).drop("comments")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges as a stored table, as later steps read them more than once."""
    return cut_lineage(G.edge_weights(members(spark, sf_dir), more_than=2))


def year_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    yearly = bought(spark, sf_dir).select("year", "author", "community").distinct()
    return cut_lineage(G.edge_weights(yearly, ["year"], more_than=3))


@query(f"WITH {BOUGHT} SELECT * FROM pairs")
def co_membership_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.co_membership_pairs(members(spark, sf_dir), block=4)


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    "CASE WHEN (lower(p_name), p_name) <= (lower(s_name), s_name) THEN p_name ELSE s_name END AS src, "
    "CASE WHEN (lower(p_name), p_name) <= (lower(s_name), s_name) THEN s_name ELSE p_name END AS dst "
    "FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"
)
def canonical_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part and supplier of each sale as an undirected pair."""
    lines = X.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    parts = X.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    suppliers = X.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    named = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey")
    )
    return named.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *G.canonical_edge(F.col("p_name"), F.col("s_name")),
    )


@query(f"WITH {BOUGHT} SELECT * FROM edges")
def edge_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.edge_weights(members(spark, sf_dir))


@query(f"WITH {BOUGHT} SELECT * FROM kept")
def prune_edges_min_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges(spark, sf_dir)


@query(f"WITH {BOUGHT} SELECT * FROM year_kept")
def edges_by_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of every year, counted only for pairs that share rare authors."""
    yearly = bought(spark, sf_dir).select("year", "author", "community").distinct()
    return G.overlap_edges(yearly, 3, ["year"])


@query(f"WITH {BOUGHT} SELECT year, src AS node1, dst AS neighbour, CAST(weight AS INTEGER) AS weight FROM year_kept")
def adjacency_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = G.adjacency_map(G.adjacency_rows(year_edges(spark, sf_dir), ["year"]), ["year"])
    return maps.select("year", "node1", F.explode("node2").alias("neighbour", "weight"))


@query(f"{RELATIVE} SELECT * FROM relative")
def prune_edges_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.prune_edges_relative(year_edges(spark, sf_dir), ["year"])


def _excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.exclude_nodes(G.prune_edges_relative(year_edges(spark, sf_dir), ["year"]))


@query(f"{RELATIVE} SELECT * FROM excluded")
def exclude_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _excluded(spark, sf_dir)


@query(f"{RELATIVE} SELECT * FROM degree")
def node_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.node_degree(_excluded(spark, sf_dir), ["year"])


@query(f"{RELATIVE} SELECT * FROM hubless")
def drop_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.drop_hubs(_excluded(spark, sf_dir), ["year"], HUB_BELOW)


@query(f"{RELATIVE} SELECT DISTINCT year, unnest([src, dst]) AS node FROM hubless")
def drop_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.drop_isolated(G.drop_hubs(_excluded(spark, sf_dir), ["year"], HUB_BELOW), ["year"])


@query(f"WITH {BOUGHT} SELECT * FROM year_kept WHERE weight > 6")
def prune_edges_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.prune_edges_absolute(year_edges(spark, sf_dir), 6)


@query(
    f"{RELATIVE} SELECT year, max(weight) AS max_weight, min(weight) AS min_weight "
    "FROM excluded GROUP BY year"
)
def edge_weight_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.edge_weight_range(_excluded(spark, sf_dir), ["year"])


@query(
    f"{RELATIVE}, d AS (SELECT year, unnest([src, dst]) AS node FROM hubless), "
    "n AS (SELECT year, count(DISTINCT node) AS nodes FROM d GROUP BY year) "
    "SELECT h.year, any_value(n.nodes) AS nodes, count(*) AS edges, "
    "CAST(sum(weight) AS BIGINT) AS weight FROM hubless h JOIN n ON h.year = n.year GROUP BY h.year"
)
def graph_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the published graph of every year."""
    published = cut_lineage(G.graph_by_year(year_edges(spark, sf_dir), HUB_BELOW))
    nodes = G.drop_isolated(published, ["year"]).groupBy("year").agg(
        F.count(F.lit(1)).alias("nodes")
    )
    sizes = published.groupBy("year").agg(
        F.count(F.lit(1)).alias("edges"), F.sum("weight").alias("weight")
    )
    return nodes.join(sizes, "year")


EGO = "Brand#7/ECONOMY"


@query(
    f"""WITH {BOUGHT},
near AS (SELECT DISTINCT unnest([src, dst]) AS node FROM kept WHERE src = '{EGO}' OR dst = '{EGO}')
SELECT * FROM kept WHERE src IN (SELECT node FROM near) AND dst IN (SELECT node FROM near)"""
)
def ego_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.ego_network(edges(spark, sf_dir), EGO)


def _labels_sql(rounds: int) -> str:
    ctes = [
        BOUGHT,
        "arcs AS (SELECT src, dst, weight FROM kept UNION ALL SELECT dst, src, weight FROM kept)",
        "l0 AS (SELECT DISTINCT src AS node, src AS community FROM arcs)",
    ]
    for i in range(rounds):
        ctes.append(
            f"""l{i + 1} AS (SELECT node, community FROM (
SELECT node, community, row_number() OVER (PARTITION BY node ORDER BY sum(weight) DESC, community) AS r
FROM (SELECT dst AS node, community, weight FROM arcs JOIN l{i} ON arcs.src = l{i}.node
      UNION ALL SELECT node, community, 1 FROM l{i}) GROUP BY node, community) WHERE r = 1)"""
        )
    return "WITH " + ",\n".join(ctes)


ROUNDS = 3


@query(f"{_labels_sql(ROUNDS)} SELECT node, community FROM l{ROUNDS}")
def communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rounds only, which SQL can tell; ``communities_settled`` goes on to the end."""
    return clustering.communities(edges(spark, sf_dir), ROUNDS, settle=False)


@query()
def communities_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.communities(edges(spark, sf_dir))


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published graphs of all years, as a stored table."""
    return cut_lineage(G.graph_by_year(year_edges(spark, sf_dir), HUB_BELOW))


@query()
def modularity_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classes of the published graph of every year."""
    return clustering.modularity_classes(published(spark, sf_dir), ["year"])


@query()
def modularity_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modularity of those classes."""
    graphs = published(spark, sf_dir)
    score = clustering.modularity(graphs, clustering.modularity_classes(graphs, ["year"]), ["year"])
    return score.withColumn("modularity", F.round("modularity", 9))


@query(
    f"""{_labels_sql(ROUNDS)},
s AS (SELECT community, sum(weight) AS strength FROM arcs JOIN l{ROUNDS} ON src = node GROUP BY community),
i AS (SELECT a.community, sum(weight) AS inside FROM kept JOIN l{ROUNDS} a ON src = a.node
      JOIN l{ROUNDS} b ON dst = b.node WHERE a.community = b.community GROUP BY a.community)
SELECT count(*) AS classes, round(sum(2 * coalesce(inside, 0)) / sum(strength)::DOUBLE
       - sum(strength::DOUBLE * strength) / (sum(strength)::DOUBLE * sum(strength)), 9) AS modularity
FROM s LEFT JOIN i USING (community)"""
)
def modularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = edges(spark, sf_dir)
    score = clustering.modularity(kept, clustering.communities(kept, ROUNDS, settle=False))
    return score.withColumn("modularity", F.round("modularity", 9))


@query(
    f"""WITH {FOLLOWERS},
h1 AS (SELECT DISTINCT follower AS account FROM followers WHERE parent = 1 AND follower <> 1),
h2 AS (SELECT DISTINCT follower AS account FROM followers JOIN h1 ON parent = account
       WHERE follower <> 1 AND follower NOT IN (SELECT account FROM h1)),
h3 AS (SELECT DISTINCT follower AS account FROM followers JOIN h2 ON parent = account
       WHERE follower <> 1 AND follower NOT IN (SELECT account FROM h1)
         AND follower NOT IN (SELECT account FROM h2))
SELECT CAST(1 AS BIGINT) AS account, 0 AS hop UNION ALL SELECT account, 1 FROM h1
UNION ALL SELECT account, 2 FROM h2 UNION ALL SELECT account, 3 FROM h3"""
)
def k_hop_followers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return followers.k_hop_followers(cut_lineage(follower_edges(spark, sf_dir)), 1, 3)


@query(
    f"""WITH {FOLLOWERS},
c AS (SELECT parent AS account, count(*) AS followers_count FROM followers GROUP BY parent),
h1 AS (SELECT DISTINCT follower AS account FROM followers WHERE parent = 1 AND follower <> 1
       AND follower IN (SELECT account FROM c WHERE followers_count >= 200)),
h2 AS (SELECT DISTINCT follower AS account FROM followers JOIN h1 ON parent = account
       WHERE follower <> 1 AND follower NOT IN (SELECT account FROM h1)
         AND follower IN (SELECT account FROM c WHERE followers_count >= 100))
SELECT account, 1 AS hop FROM h1 UNION ALL SELECT account, 2 FROM h2"""
)
def influential_followers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return followers.influential_followers(cut_lineage(follower_edges(spark, sf_dir)), 1, 2)


@query(f"{RELATIVE} SELECT src, dst, weight FROM hubless WHERE year = (SELECT max(year) FROM hubless)")
def graph_for_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph of the last year, from a table partitioned by year."""
    path = fresh_path(spark, "yearly-graphs")
    graphs = G.graph_by_year(year_edges(spark, sf_dir), HUB_BELOW)
    tables.write_partitioned(graphs, path, ["year"])
    # with its schema, as no year may have an edge left
    graphs = tables.read_batches(spark, path, graphs.schema)
    last = graphs.agg(F.max("year").cast("bigint").alias("last")).first()["last"]
    return graphs.where(F.col("year") == last).select("src", "dst", "weight")


@query(
    f"WITH {BOUGHT} SELECT 'node' AS kind, '<node id=\"' || n || '\" label=\"' || n || '\" />' AS element "
    "FROM (SELECT DISTINCT unnest([src, dst]) AS n FROM kept) UNION ALL "
    "SELECT 'edge', '<edge id=\"' || sha256(src || chr(1) || dst) || '\" source=\"' || src || "
    "'\" target=\"' || dst || '\" weight=\"' || weight || '\" />' FROM kept"
)
def export_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.export_graph(edges(spark, sf_dir))


@query(
    f"WITH {BOUGHT} SELECT src, dst, weight FROM kept UNION ALL "
    "SELECT DISTINCT unnest([src, dst]), NULL, NULL FROM kept"
)
def scan_gexf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges and (without dst) nodes of a graph file that Spark wrote."""
    path = fresh_path(spark, "graph-file")
    gexf.write_gexf(edges(spark, sf_dir), path)
    nodes = gexf.scan_gexf_nodes(spark, f"{path}/nodes")
    return (
        gexf.scan_gexf_edges(spark, f"{path}/edges")
        .select("src", "dst", "weight")
        .unionByName(nodes.select(F.col("label").alias("src")), allowMissingColumns=True)
    )
