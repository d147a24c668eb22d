"""Row filters on comments and messages.

List joins carry no broadcast hint: Spark broadcasts a list when its measured size is below the
session's threshold, else it sort-merges and AQE splits communities that hold most rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatterscope import constants as C
from chatterscope.functions import text as T
from chatterscope.session import cut_lineage


def _listed(comments: DataFrame, names: DataFrame, how: str) -> DataFrame:
    listed = names.select(F.lower("name").alias("listed_name"))
    return comments.join(listed, F.lower(comments["community"]) == F.col("listed_name"), how)


def filter_whitelist(comments: DataFrame, names: DataFrame) -> DataFrame:
    return _listed(comments, names, "left_semi")


def filter_blacklist(comments: DataFrame, names: DataFrame) -> DataFrame:
    return _listed(comments, names, "left_anti")


def semi_anti_lists(comments: DataFrame, white: DataFrame, black: DataFrame) -> DataFrame:
    """Listed communities that are not blacklisted; the blacklist wins on overlap."""
    return filter_whitelist(filter_blacklist(comments, black), white)


def filter_system_accounts(
    comments: DataFrame,
    authors: Sequence[str] = C.SYSTEM_AUTHORS,
    communities: Sequence[str] = C.GRAPH_SKIPPED_COMMUNITIES,
) -> DataFrame:
    """Drop system accounts and catch-all communities; rows without author or community go too."""
    return comments.where(
        ~F.col("author").isin(list(authors)) & ~F.col("community").isin(list(communities))
    )


def filter_track_terms(messages: DataFrame, terms: Sequence[str], lang: str = "en") -> DataFrame:
    """Messages with text in the language that hold any tracked term.

    A term of several words is held by a message that has all of them, in any place.
    """
    wanted = [t.lower().split() for t in terms]
    return messages.where(
        F.col("text").isNotNull()
        & (F.col("lang") == lang)
        & T.contains_any(T.tokenize(F.lower("text")), [w for w in wanted if w])
    )


def term_table(terms: DataFrame) -> DataFrame:
    """term, words, key of tracked terms: the words of each, and the one that is in the fewest terms; terms
    without words are left out.

    The words of a term (column term) are what stands between its white space, in lower case.  Terms may also
    come as arrays of tokens (column words), which may be white space themselves; those stay as they are.
    """
    if "words" in terms.columns:
        split, term = F.col("words"), F.col("words")
    else:
        split, term = F.filter(F.split(F.lower("term"), r"\s+"), lambda w: w != ""), F.col("term")
    own = terms.select(term.alias("term"), F.array_distinct(split).alias("words"))
    own = own.where(F.size("words") > 0).distinct()
    each = own.select("term", "words", F.explode("words").alias("word"))
    uses = each.groupBy("word").agg(F.count(F.lit(1)).alias("uses"))
    key = F.min_by("word", F.struct("uses", "word")).alias("key")
    return each.join(uses, "word").groupBy("term", "words").agg(key)


def filter_many_terms(messages: DataFrame, terms: DataFrame, lang: str = "en") -> DataFrame:
    """What filter_track_terms keeps, for terms in a table (see term_table) of any size.

    Distinct tokens meet the terms by key in a join, which Spark broadcasts while the terms are small;
    only terms found by their key have their other words looked for.  Messages are written once.
    """
    own = messages.where(F.col("text").isNotNull() & (F.col("lang") == lang))
    own = cut_lineage(own.withColumn("__row", F.monotonically_increasing_id()))
    found = F.array_distinct(T.tokenize(F.lower("text")))
    tokens = own.select("__row", F.explode(found).alias("token"))
    table = cut_lineage(term_table(terms)).withColumnRenamed("key", "token")
    hits = tokens.join(table, "token").select("__row", "term", "words", F.size("words").alias("n"))
    others = hits.where("n > 1").select("__row", "term", "n", F.explode("words").alias("token"))
    there = others.join(tokens, ["__row", "token"], "left_semi")
    whole = there.groupBy("__row", "term", "n").agg(F.count(F.lit(1)).alias("words")).where("words = n")
    rows = hits.where("n = 1").select("__row").unionByName(whole.select("__row")).distinct()
    return own.join(rows, "__row", "left_semi").drop("__row")
