"""Breadth-first walks over (follower, parent) edges."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope import constants as C
from chatterscope.session import cut_lineage


def follower_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("parent").alias("account")).agg(
        F.count(F.lit(1)).alias("followers_count")
    )


def k_hop_followers(
    edges: DataFrame,
    seed: int,
    hops: int | None,
    counts: DataFrame | None = None,
    limits: tuple[int, int] = (C.INFLUENCE_FIRST, C.INFLUENCE_DEEPER),
) -> DataFrame:
    """Accounts reached from a seed against the direction of following: account, hop.

    Without a number of ``hops`` the walk ends when it reaches no new account.

    With ``counts`` (account, followers_count) the walk goes on only through influential
    accounts: those with at least limits[0] followers at the first hop, limits[1] deeper, and only
    these are returned.
    """
    spark = edges.sparkSession
    visited = spark.createDataFrame([(seed, 0)], "account bigint, hop int")
    frontier = visited
    for hop in itertools.count(1) if hops is None else range(1, hops + 1):
        reached = (
            edges.join(frontier.select(F.col("account").alias("parent")), "parent")
            .select(F.col("follower").alias("account"))
            .distinct()
            .join(visited, "account", "left_anti")
        )
        if counts is not None:
            limit = limits[0] if hop == 1 else limits[1]
            reached = reached.join(
                counts.where(F.col("followers_count") >= limit), "account", "left_semi"
            )
        frontier = cut_lineage(reached.withColumn("hop", F.lit(hop)))
        visited = visited.unionByName(frontier)
        if hops is None and not frontier.limit(1).count():
            return visited
    return visited


def influential_followers(edges: DataFrame, seed: int, hops: int, limits=None) -> DataFrame:
    limits = limits or (C.INFLUENCE_FIRST, C.INFLUENCE_DEEPER)
    reached = k_hop_followers(edges, seed, hops, follower_counts(edges), limits)
    return reached.where(F.col("hop") > 0)
