"""Comment analytics on Spark: phrase trends, community graphs, page links and search."""
