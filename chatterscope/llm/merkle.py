"""A Merkle manifest of a table of documents, with a proof for every row found by pointer jumping.

1. A row's leaf is the SHA-256 of its fields.  Leaves of a group (a source) are ordered by doc_id; runs of
   FANOUT consecutive nodes become their hash until one is left, the group's root.  Group roots, ordered by
   group, become the root of the manifest in the same way.  Positions come from a range partitioning by
   (group, doc_id, leaf, place of reading) and the sizes of its parts, so that a group of any size, and a
   row repeated any number of times, spreads over many tasks.
2. Every inner node points to its parent and holds the sibling segment of that step: what stands left
   and right of it in its run.  In each round a self-join replaces a node's pointer by its ancestor's
   pointer and appends the ancestor's segment, which doubles the distance, until all pointers end at the
   root; rounds are as many as the logarithm of the height.  Only nodes high enough to be an ancestor at
   the round's distance are joined to.  The leaves of a run share all but their own run's part of the way,
   so they come in the last round: each leaf's segment in its run is put before those of the run.
3. A proof is the list of (left, right) hexadecimal text from the leaf to the root.  Folding a leaf along
   it gives the root again if the leaf is the one that the manifest was made from.

Defined results: a null group is a group of its own and the first; a null doc_id is before all others.  Rows
of one doc_id stand in the order of their leaves; equal rows have equal leaves and stand side by side.
Null and empty fields differ ("-" and "0:").  An empty table has no rows, and the hash of nothing as
root.  A table of one row has that row's leaf as root and an empty proof.  Columns that are not named
as fields are neither hashed nor returned.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatterscope.session import cut_lineage

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NOTHING = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # the SHA-256 of no bytes
#: The tree above the group roots; names of groups begin with 0 or 1.
TOP = ""
STEP = "struct<left:string,right:string>"
_NODE = ["tree", "level", "at"]
_UP = ["up_tree", "up_level", "up_at"]


def hashed(value: Column) -> Column:
    """SHA-256 of a string's UTF-8 bytes, as lower-case hexadecimal text."""
    return F.sha2(value, 256)


def leaf(fields: Sequence[Column]) -> Column:
    """The hash of all fields: each "-" if null, else its size in bytes, ":" and its text."""

    def framed(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return hashed(F.concat(*map(framed, fields)))


def lowered(text: Column) -> Column:
    """A text with only A-Z lower-cased."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def group_name(group: Column) -> Column:
    """Names in the order of groups: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows (a stored table) with `at`, their place in their tree by the order.

    The sorted rows are written, and the rows that each part has of a tree counted and added up.  These
    counts are at most one for each tree and one more for each part.
    """
    key = ["tree", *order, "read"]
    sorted_ = rows.withColumn("read", F.monotonically_increasing_id()).repartitionByRange(*key).sortWithinPartitions(*key)
    sorted_ = cut_lineage(sorted_.withColumn("row", F.monotonically_increasing_id()).drop("read"))
    part = F.shiftright("row", 33)  # where that function puts the part
    sizes = sorted_.groupBy("tree", part.alias("part")).agg(F.min("row").alias("first"), F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("tree").orderBy("part")) - F.col("size")
    starts = cut_lineage(sizes.select("tree", "part", (F.col("first") - before).alias("start")))
    placed = sorted_.withColumn("part", part).join(starts, ["tree", "part"])
    return placed.withColumn("at", F.col("row") - F.col("start")).drop("part", "row", "start")


def _runs(nodes: DataFrame, level: int, value: str, *more: str) -> DataFrame:
    """Runs of FANOUT nodes (tree, at, value): tree, level, at, members in order, digest."""
    member = F.struct(F.pmod("at", F.lit(FANOUT)).alias("slot"), value, *more)
    gathered = nodes.groupBy("tree", F.floor(F.col("at") / FANOUT).alias("at")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    digest = hashed(F.array_join(F.col(f"members.{value}"), ""))
    return gathered.select("tree", F.lit(level).alias("level"), "at", "members", digest.alias("digest"))


def _climb(runs: DataFrame) -> tuple[list[DataFrame], DataFrame, int]:
    """The runs of all higher levels, the last digest of every tree (tree, level, digest) and their height."""
    levels, tops, level = [runs], [], 1
    while True:
        below = levels[-1]
        # a tree goes on if it has a node besides the first
        open_ = cut_lineage(below.filter("at = 1").select("tree"))
        tops.append(below.filter("at = 0").join(open_, "tree", "left_anti").select("tree", "level", "digest"))
        if not open_.limit(1).count():
            break
        level += 1
        up = below.join(open_, "tree", "left_semi").select("tree", "at", "digest")
        levels.append(cut_lineage(_runs(up, level, "digest")))
    every = tops[0]
    for top in tops[1:]:
        every = every.unionByName(top)
    return levels, every, level


def _segment(members: Column, slot: Column, value: str) -> Column:
    """What stands left and right of a slot in its run."""
    joined = lambda first, size: F.array_join(F.transform(F.slice(members, first, size), lambda m: m[value]), "")
    return F.struct(joined(F.lit(1), slot).alias("left"), joined(slot + 2, F.lit(FANOUT)).alias("right"))


def _pointers(runs: DataFrame) -> DataFrame:
    """For every member of runs of inner nodes: itself, its parent, and the segment of that step."""
    spread = runs.select("tree", "level", "at", "members", F.posexplode("members").alias("slot", "own"))
    return spread.select(
        "tree",
        (F.col("level") - 1).alias("level"),
        (F.col("at") * FANOUT + F.col("slot")).alias("at"),
        F.col("tree").alias("up_tree"),
        F.col("level").alias("up_level"),
        F.col("at").alias("up_at"),
        F.lit(None).cast("string").alias("group_root"),
        F.array(_segment(F.col("members"), F.col("slot"), "digest")).alias("steps"),
    )


def jumped(pointers: DataFrame, height: int) -> DataFrame:
    """Every node's steps to the root, by self-joins that double the distance.

    Nodes whose ancestor has no pointer have reached the root and are not joined again, as all of them
    would have one key.
    """
    none = F.array().cast(f"array<{STEP}>")
    closed, far = [], 1
    while far < height:
        every = pointers
        for part in closed:
            every = every.unionByName(part)
        # nodes of groups are at level 1 or more; their ancestors at this distance at that many more
        high = cut_lineage(every.filter((F.col("tree") == TOP) | (F.col("level") > far)))
        ancestors = high.select(
            *(F.col(c).alias(f"up_{c}") for c in _NODE),
            *(F.col(c).alias(f"far_{c}") for c in _UP),
            F.col("group_root").alias("far_root"),
            F.col("steps").alias("far_steps"),
        )
        joined = pointers.join(ancestors, _UP, "left").select(
            *_NODE,
            *(F.coalesce(f"far_{c}", c).alias(c) for c in _UP),
            F.coalesce("group_root", "far_root").alias("group_root"),
            F.concat("steps", F.coalesce("far_steps", none)).alias("steps"),
            F.col("far_up_level").isNull().alias("done"),
        )
        joined = cut_lineage(joined)
        closed.append(joined.filter("done").drop("done"))
        pointers = joined.filter("NOT done").drop("done")
        far *= 2
    for part in closed:
        pointers = pointers.unionByName(part)
    return pointers


def folded(leaf_: Column, steps: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(steps, leaf_, lambda h, s: hashed(F.concat(s["left"], h, s["right"])))


def proof_hash(steps: Column) -> Column:
    """The hash of all siblings, from the leaf's own to those below the root."""
    return hashed(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(leaves: DataFrame, order: Sequence[str] = ("doc_id", "leaf")) -> DataFrame:
    """leaves (tree, leaf, the columns of the order, any others) with group_root, root and steps."""
    others = [c for c in leaves.columns if c not in ("tree", "leaf")]
    spark = leaves.sparkSession
    first = cut_lineage(_runs(ranked(cut_lineage(leaves), order), 1, "leaf", *others))
    levels, tops, height = _climb(first)
    # a group of one leaf has that leaf as its root, not the hash of a run
    single = (F.size("members") == 1) & (F.col("at") == 0)
    alone = first.filter(single).select("tree", F.col("members")[0]["leaf"].alias("lone"))
    tops = tops.join(alone, "tree", "left").select(
        F.lit(TOP).alias("tree"),
        F.col("tree").alias("name"),
        F.when(F.col("lone").isNull(), F.col("level")).otherwise(0).alias("top"),
        F.coalesce("lone", "digest").alias("digest"),
    )
    tops = cut_lineage(ranked(cut_lineage(tops), ["name"]))
    some = [r.digest for r in tops.limit(2).collect()]
    parts = [_pointers(runs) for runs in levels[1:]]
    if len(some) < 2:
        root = some[0] if some else NOTHING
    else:
        base = cut_lineage(_runs(tops, 1, "digest", "name", "top"))
        above, last, more = _climb(base)
        root = last.first().digest
        height += more
        own = F.posexplode("members").alias("slot", "own")
        up = base.select("at", "members", own).select(
            F.col("own.name").alias("tree"),
            F.col("own.top").alias("level"),
            F.lit(0).cast("long").alias("at"),
            F.lit(TOP).alias("up_tree"),
            F.lit(1).alias("up_level"),
            F.col("at").alias("up_at"),
            F.col("own.digest").alias("group_root"),
            F.array(_segment(F.col("members"), F.col("slot"), "digest")).alias("steps"),
        )
        parts += [up, *(_pointers(runs) for runs in above[1:])]
    runs = first.withColumn("level", F.when(single, 0).otherwise(1))
    if parts:
        pointers = parts[0]
        for part in parts[1:]:
            pointers = pointers.unionByName(part)
        ways = jumped(cut_lineage(pointers), height).select(*_NODE, "group_root", F.col("steps").alias("rest"))
        runs = runs.join(ways, _NODE, "left")
    else:
        runs = runs.withColumn("group_root", F.lit(None).cast("string")).withColumn("rest", F.lit(None).cast(f"array<{STEP}>"))
    none = F.array().cast(f"array<{STEP}>")
    spread = runs.select("*", F.posexplode("members").alias("slot", "own"))
    step = F.when(F.col("level") == 0, none).otherwise(F.array(_segment(F.col("members"), F.col("slot"), "leaf")))
    return spread.select(
        "tree",
        "own.leaf",
        *(f"own.{c}" for c in others),
        F.coalesce("group_root", F.lit(root)).alias("group_root"),
        F.lit(root).alias("root"),
        F.concat(step, F.coalesce("rest", none)).alias("steps"),
    )


def leaves_of(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source") -> DataFrame:
    """(tree, doc_id, leaf) of every row."""
    return docs.select(group_name(F.col(group)).alias("tree"), "doc_id", leaf([F.col(c) for c in fields]).alias("leaf"))


def check_copy(docs: DataFrame, change: Column, changed: Column, fields: Sequence[str] = FIELDS, group: str = "source") -> DataFrame:
    """(doc_id, leaf, group_root, root, steps, folded_root, verified): the proofs of docs, folded from the
    leaves of a copy whose text is `changed` where `change` holds."""
    own = [F.col(c) for c in fields]
    copy = [changed if c == "text" else F.col(c) for c in fields]
    leaves = docs.select(
        group_name(F.col(group)).alias("tree"),
        "doc_id",
        leaf(own).alias("leaf"),
        F.when(change, leaf(copy)).alias("copy"),
    )
    found = manifest(leaves)
    again = folded(F.coalesce("copy", "leaf"), F.col("steps"))
    found = found.select("doc_id", "leaf", "group_root", "root", "steps", again.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
