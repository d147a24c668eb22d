"""Tool-call linking: calls with their results, in an order that respects what they need, in DataFrame
operations only.

`link` takes calls (conv_id, seq, call_id, name, arguments, needs), results (conv_id, seq, call_id, content) and
schemas (name, param, kind, required) and returns a row for every call and every result without a call:

* results are hash-joined to calls by (conv_id, call_id), so a long conversation spreads over all tasks;
* arguments are parsed and compared with the schema of the tool: missing, unknown and wrongly typed
  arguments, unknown tools and text that is no JSON object are listed in `errors`;
* `position` numbers the calls of a conversation so that each comes after the calls it needs.  Calls in order
  of seq have that property unless one needs a later one; only conversations with such a call are
  sorted topologically, by rounds that place all calls whose needs are placed.  There are as many rounds as
  the longest chain in such a conversation has calls.  Calls on a cycle, and those that need them, come
  last and have `cyclic` set.  Numbers come from a global sort by ranges, not from a task per conversation;
* `line` is the call in canonical JSON: sorted keys, no white space, arguments as parsed.

Defined results: of several results of a call the first by (seq, content) counts and `n_results` tells their
number.  Of calls with the same id the first by (seq, name, arguments) is linked and others list
"repeated id"; equal rows are all kept, numbered in any order among themselves.  A null conv_id is a
conversation; a null call_id is never linked and never needed; it has seq order.  Null arguments are no JSON
object.  Of several schema rows for an argument the smallest kind counts, and it is required if one says so; an
argument of an unknown kind has a wrong type.  Needs without a call are listed and do not hold a call back.  Other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.session import cut_lineage

#: The JSON type names of schemas and the patterns of Spark's names for parsed values.
KINDS = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "BIGINT|DOUBLE|DECIMAL.*",
    "boolean": "BOOLEAN",
    "array": "ARRAY.*",
    "object": "OBJECT.*",
    "null": "VOID",
}


def _errors(arguments: Column, parsed: Column, spec: Column) -> Column:
    """What is wrong with parsed arguments (a map, or null) under a spec (a map, null for unknown tools)."""
    pattern = F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair))
    wrong = lambda e: F.when(~F.map_contains_key(spec, e["key"]), F.concat(F.lit("unknown argument "), e["key"])).when(
        ~F.coalesce(F.regexp_like(F.schema_of_variant(e["value"]), F.concat(F.lit("^("), pattern[spec[e["key"]]["kind"]], F.lit(")$"))), F.lit(False)),
        F.concat(F.lit("wrong type of "), e["key"]),
    )
    given = F.transform(F.map_entries(parsed), wrong)
    absent = F.transform(
        F.map_entries(spec),
        lambda e: F.when(e["value"]["required"] & ~F.map_contains_key(parsed, e["key"]), F.concat(F.lit("missing "), e["key"])),
    )
    checked = F.array_sort(F.array_compact(F.concat(given, absent)))
    return (
        F.when(parsed.isNull(), F.array(F.lit("no JSON object")))
        .when(spec.isNull(), F.array(F.lit("unknown tool")))
        .otherwise(checked)
    )


def levels(calls: DataFrame) -> DataFrame:
    """(row, level) of calls (row, conv, call_id, seq, needs) that have to wait; level null if on or behind a
    cycle.  Calls of other conversations have no row."""
    named = calls.filter("call_id IS NOT NULL")
    ids = named.groupBy("conv", "call_id").agg(F.min("seq").alias("need_seq"))
    wants = calls.select("row", "conv", "seq", F.explode(F.array_distinct("needs")).alias("need"))
    known = wants.join(ids.withColumnRenamed("call_id", "need"), ["conv", "need"])
    mixed = cut_lineage(known.filter("need_seq >= seq").select("conv").distinct())
    nodes = cut_lineage(calls.join(mixed, "conv", "left_semi").select("row", "conv", "call_id"))
    edges = cut_lineage(known.join(mixed, "conv", "left_semi").select("row", "conv", "need").distinct())
    placed, waiting, level = None, nodes, 0
    while waiting.limit(1).count():
        ready = cut_lineage(waiting.join(edges, "row", "left_anti").withColumn("level", F.lit(level)))
        if not ready.limit(1).count():
            rest = waiting.select("row", F.lit(None).cast("int").alias("level"))
            return rest if placed is None else placed.unionByName(rest)
        done = ready.select("row", "level")
        placed = done if placed is None else placed.unionByName(done)
        waiting = cut_lineage(waiting.join(ready, "row", "left_anti"))
        # an id is placed once all calls that have it are
        open_ids = waiting.select("conv", F.col("call_id").alias("need")).distinct()
        edges = cut_lineage(edges.join(waiting, "row", "left_semi").join(open_ids, ["conv", "need"], "left_semi"))
        level += 1
    if placed is None:
        return nodes.select("row", F.lit(0).alias("level"))
    return placed


def _numbered(rows: DataFrame, keys: list) -> DataFrame:
    """The rows with `position` from 0 in the order of keys within conv, without a task per conv."""
    ordered = rows.repartitionByRange("conv", *keys).sortWithinPartitions("conv", *keys)
    ordered = cut_lineage(ordered.withColumn("at", F.monotonically_increasing_id()))
    slice_ = F.shiftright("at", 33).alias("slice")
    parts = ordered.groupBy("conv", slice_).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # one row for each conversation and slice
    earlier = parts.groupBy("conv").agg(F.collect_list(F.struct("slice", "n")).alias("slices"))
    parts = parts.join(earlier, "conv").withColumn(
        "before",
        F.aggregate("slices", F.lit(0).cast("long"), lambda total, s: total + F.when(s["slice"] < F.col("slice"), s["n"]).otherwise(0)),
    )
    numbered = ordered.withColumn("slice", slice_).join(parts.select("conv", "slice", "first", "before"), ["conv", "slice"])
    return numbered.withColumn("position", F.col("at") - F.col("first") + F.col("before")).drop("at", "slice", "first", "before")


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, position, seq, call_id, name, arguments, errors, cyclic, n_results, result, linked, line)."""
    # a conversation's key that is never null
    conv = F.to_json(F.struct("conv_id"))
    own = calls.select(
        conv.alias("conv"), "conv_id", "seq", "call_id", "name", "arguments", F.coalesce("needs", F.array().cast("array<string>")).alias("needs")
    )
    own = cut_lineage(own.withColumn("row", F.monotonically_increasing_id()))
    found = (
        results.select(conv.alias("conv"), "conv_id", "seq", "call_id", "content")
        .groupBy("conv", "conv_id", "call_id")
        .agg(F.min(F.struct("seq", "content")).alias("r"), F.count("*").alias("n_results"))
    )
    first = (
        own.filter("call_id IS NOT NULL")
        .groupBy("conv", "call_id")
        .agg(F.min(F.struct("seq", "name", "arguments", "row")).alias("c"))
        .select("conv", "call_id", F.col("c.row").alias("row"))
    )
    own = own.join(first.select("row", F.lit(True).alias("leads")), "row", "left")
    keyed = own.withColumn("link_id", F.expr("if(leads, call_id, NULL)"))
    linked = keyed.join(
        found.select("conv", F.col("call_id").alias("link_id"), "r", "n_results").hint("shuffle_hash"), ["conv", "link_id"], "left"
    )
    params = schemas.filter("name IS NOT NULL AND param IS NOT NULL").groupBy("name", "param")
    specs = (
        params.agg(F.min("kind").alias("kind"), F.coalesce(F.max("required"), F.lit(False)).alias("required"))
        .groupBy("name")
        .agg(F.map_from_entries(F.collect_list(F.struct("param", F.struct("kind", "required")))).alias("spec"))
    )
    linked = linked.join(specs, "name", "left")
    parsed = F.expr("try_variant_get(try_parse_json(arguments), '$', 'map<string,variant>')")
    known = first.select("conv", F.col("call_id").alias("need"), F.lit(True).alias("there"))
    lost = (
        own.select("row", "conv", F.explode(F.array_distinct("needs")).alias("need"))
        .join(known, ["conv", "need"], "left_anti")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.concat(F.lit("needs unknown "), "need"))).alias("lost"))
    )
    none = F.array().cast("array<string>")
    linked = (
        linked.join(lost, "row", "left")
        .join(levels(own.select("row", "conv", "call_id", "seq", "needs")).withColumn("sorted", F.lit(True)), "row", "left")
        .withColumn("parsed", parsed)
        .withColumn(
            "errors",
            F.concat(
                _errors(F.col("arguments"), F.col("parsed"), F.col("spec")),
                F.coalesce("lost", none),
                F.when(F.col("call_id").isNotNull() & F.col("leads").isNull(), F.array(F.lit("repeated id"))).otherwise(none),
            ),
        )
        .withColumn("cyclic", F.col("sorted").isNotNull() & F.col("level").isNull())
        .withColumn("level", F.coalesce("level", F.lit(0)))
    )
    ordered = _numbered(linked, ["cyclic", "level", "seq", "call_id", "row"])
    canonical = F.expr("to_json(try_parse_json(arguments))")
    # a JSON string: an array of one without its brackets
    text = lambda c: F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)")
    calls_out = ordered.select(
        "conv_id",
        "position",
        "seq",
        "call_id",
        "name",
        F.when(F.col("parsed").isNotNull(), canonical).alias("arguments"),
        "errors",
        "cyclic",
        F.coalesce("n_results", F.lit(0).cast("long")).alias("n_results"),
        F.col("r.content").alias("result"),
        (F.col("n_results").isNotNull()).alias("linked"),
        F.concat(
            F.lit('{"arguments":'),
            F.when(F.col("parsed").isNotNull(), canonical).otherwise(F.lit("null")),
            F.lit(',"id":'),
            text("call_id"),
            F.lit(',"name":'),
            text("name"),
            F.lit(',"result":'),
            text("r.content"),
            F.lit("}"),
        ).alias("line"),
    )
    lone = found.join(first.select("conv", "call_id"), ["conv", "call_id"], "left_anti").select(
        "conv_id",
        F.lit(None).cast("long").alias("position"),
        F.col("r.seq").alias("seq"),
        "call_id",
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"),
        F.array(F.lit("result without a call")).alias("errors"),
        F.lit(False).alias("cyclic"),
        "n_results",
        F.col("r.content").alias("result"),
        F.lit(False).alias("linked"),
        F.concat(F.lit('{"arguments":null,"id":'), text("call_id"), F.lit(',"name":null,"result":'), text("r.content"), F.lit("}")).alias("line"),
    )
    return calls_out.unionByName(lone)
