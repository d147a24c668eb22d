"""Graph files: nodes and edges of GEXF XML.

A path that is read is one GEXF file, or a folder of well-formed files with such elements.
``write_gexf`` writes such folders, ``write_document`` one document in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Attributes of GEXF elements; a class is an attvalue for "modularity_class".
NODE_SCHEMA = (
    "_id STRING, _label STRING, "
    "attvalues STRUCT<attvalue: ARRAY<STRUCT<_for: STRING, _value: STRING>>>"
)
EDGE_SCHEMA = "_id STRING, _source STRING, _target STRING, _weight DOUBLE"
CLASS_ATTRIBUTE = "modularity_class"
# The frame of a document, around and between its nodes and edges.
HEAD = (
    '<?xml version="1.0" encoding="UTF-8"?>\n<gexf xmlns="http://www.gexf.net/1.3" version="1.3">\n'
    '<graph defaultedgetype="undirected" mode="static">\n<attributes class="node">'
    f'<attribute id="{CLASS_ATTRIBUTE}" title="Modularity Class" type="string" /></attributes>\n<nodes>'
)
MIDDLE = "</nodes>\n<edges>"
TAIL = "</edges>\n</graph>\n</gexf>"


def _nodes(spark: SparkSession, path: str) -> DataFrame:
    nodes = spark.read.format("xml").option("rowTag", "node").schema(NODE_SCHEMA).load(path)
    classes = F.filter("attvalues.attvalue", lambda a: a["_for"] == CLASS_ATTRIBUTE)
    return nodes.select(
        F.col("_id").alias("id"),
        F.col("_label").alias("label"),
        F.get(classes, F.lit(0))["_value"].alias("class"),
    )


def scan_gexf_nodes(spark: SparkSession, path: str) -> DataFrame:
    """id, label, community (NULL where the file has no classes, or none that are numbers)."""
    return _nodes(spark, path).select("id", "label", F.col("class").try_cast("int").alias("community"))


def scan_gexf_classes(spark: SparkSession, path: str) -> DataFrame:
    """node, community of files whose classes have names."""
    return _nodes(spark, path).select(F.col("id").alias("node"), F.col("class").alias("community"))


def scan_gexf_edges(spark: SparkSession, path: str) -> DataFrame:
    """id, src, dst, weight."""
    edges = spark.read.format("xml").option("rowTag", "edge").schema(EDGE_SCHEMA).load(path)
    return edges.select(
        F.col("_id").alias("id"),
        F.col("_source").alias("src"),
        F.col("_target").alias("dst"),
        F.coalesce("_weight", F.lit(1)).cast("bigint").alias("weight"),
    )


def write_gexf(edges: DataFrame, path: str) -> None:
    """Write ``path``/nodes and ``path``/edges, each part file a well-formed XML document."""

    def write(rows: DataFrame, kind: str) -> None:
        (
            rows.write.format("xml")
            .option("rootTag", f"{kind}s")
            .option("rowTag", kind)
            .save(f"{path}/{kind}s")
        )

    nodes = edges.select(F.explode(F.array("src", "dst")).alias("_id")).distinct()
    write(nodes.withColumn("_label", F.col("_id")), "node")
    write(
        edges.select(
            F.sha2(F.concat_ws("\x01", "src", "dst"), 256).alias("_id"),
            F.col("src").alias("_source"),
            F.col("dst").alias("_target"),
            F.col("weight").alias("_weight"),
        ),
        "edge",
    )


def escaped(text: Column) -> Column:
    """Text as the value of an XML attribute."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;"), ("\t", "&#9;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def write_document(edges: DataFrame, labels: DataFrame, path: str) -> None:
    """One framed document, ``path``, in text parts whose names are in the order of the document.

    ``labels`` (node, community) give nodes their classes; nodes without one have none.  Joined as they are
    (``hadoop fs -getmerge``, ``cat``) the parts are a file that graph programs load.  Elements are ordered
    by a range partitioning, so no task holds the whole graph.
    """
    spark = edges.sparkSession
    names = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    value = F.concat(
        F.lit(f'<attvalues><attvalue for="{CLASS_ATTRIBUTE}" value="'), escaped(F.col("community")), F.lit('" /></attvalues>')
    )
    name = escaped(F.col("node"))
    nodes = names.join(labels.select("node", "community"), "node", "left").select(
        F.lit(1).alias("place"),
        F.col("node").alias("key"),
        F.concat(F.lit('<node id="'), name, F.lit('" label="'), name, F.lit('">'), F.coalesce(value, F.lit("")), F.lit("</node>")).alias("value"),
    )
    key = F.concat_ws("\x01", "src", "dst")
    links = edges.select(
        F.lit(3).alias("place"),
        key.alias("key"),
        F.concat(
            F.lit('<edge id="'), F.sha2(key, 256), F.lit('" source="'), escaped(F.col("src")),
            F.lit('" target="'), escaped(F.col("dst")), F.lit('" weight="'), F.col("weight").cast("string"), F.lit('" />'),
        ).alias("value"),
    )
    frame = spark.createDataFrame([(0, "", HEAD), (2, "", MIDDLE), (4, "", TAIL)], nodes.schema)
    rows = frame.unionByName(nodes).unionByName(links)
    ordered = rows.repartitionByRange("place", "key").sortWithinPartitions("place", "key")
    ordered.select("value").write.text(path)
