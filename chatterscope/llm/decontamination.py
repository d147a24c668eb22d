"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

`build_index` stores one posting (term, doc, pos) for every word of every document.  Postings stay in the
part of the task that read the document (an index partitioned by documents, so nothing is shuffled)
and are sorted by term there, which is what makes them small.

`phrase_matches` takes the windows of the test items.  Each window's terms are ordered by their number of
postings, and the lists of the rarest ones are intersected in turn: the postings of the rarest
term give candidate starts (position less the term's offset in the window), each further list keeps
the starts that have its term at its offset.  Joins are by (term, doc, position), so no frequent word
gathers in one task.  What is left is compared word by word with the texts of the documents it is in; only these
are split into words again.  Postings of further lists and texts are shuffled for a join only if their keys pass a
bit set of those asked for, which loses none, so that texts without a candidate mostly stay in place.  The index
is read twice: for the numbers of postings, and for the postings of the chosen terms of all windows, which
are written; and once more, one column of it, for the documents' sizes.

Terms are 64-bit hashes of words, documents 64-bit hashes of doc_id and text.

Defined results: null and empty texts have no words and no hits, as have test items without words.
Rows equal in doc_id and text are one document and get the same result.  Equal windows of several
items count for each of them; an item_id that is null is left out of the list of items.  Other columns
of both inputs are not used.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.operators import ngrams
from chatterscope.session import cut_lineage

WINDOW = 10
LISTS = 3
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, only A-Z lower-cased."""
    text = F.coalesce(text, F.lit(""))
    lowered = text
    for capital in string.ascii_uppercase:
        lowered = F.replace(lowered, F.lit(capital), F.lit(capital.lower()))
    ascii_only = F.length(text) == F.octet_length(text)
    return F.array_remove(F.split(F.when(ascii_only, F.lower(text)).otherwise(lowered), NO_WORD, -1), "")


def doc_key() -> Column:
    return F.xxhash64("doc_id", "text")


def build_index(docs: DataFrame) -> DataFrame:
    """(term, doc, pos) of all words, written to the shared folder, sorted by term in each part."""
    keyed = docs.select(doc_key().alias("doc"), "text")  # in a select of its own, as texts are else hashed for every word
    posted = keyed.select("doc", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return cut_lineage(posted.select(F.xxhash64("word").alias("term"), "doc", "pos").sortWithinPartitions("term"))


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window, n, words, items): the distinct windows of all items and the ids of their items."""
    w = F.col("w")
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0)))).alias("start")
    split = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    cut = split.select("item_id", "w", start).select("item_id", F.slice(w, F.col("start") + 1, F.lit(size)).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item_id").alias("items")).select(
        F.xxhash64("words").alias("window"), F.size("words").alias("n"), "words", "items"
    )


def _ranked_terms(index: DataFrame, windows: DataFrame, lists: int) -> DataFrame:
    """(window, n, place, term, offset): the rarest terms of the windows all of whose words occur."""
    terms = windows.select("window", "n", F.posexplode("words").alias("offset", "word")).select(
        "window", "n", "offset", F.xxhash64("word").alias("term")
    )
    wanted = cut_lineage(terms.select("term").distinct())
    counts = cut_lineage(index.join(wanted, "term").groupBy("term").agg(F.count("*").alias("postings")))
    by_rarity = (
        terms.join(counts, "term", "left")
        .groupBy("window", "n")
        .agg(
            F.min(F.coalesce("postings", F.lit(0))).alias("least"),
            F.array_sort(F.collect_list(F.struct("postings", "offset", "term"))).alias("terms"),
        )
        .filter("least > 0")
    )
    chosen = by_rarity.select("window", "n", F.posexplode(F.slice("terms", 1, lists)).alias("place", "t"))
    return cut_lineage(chosen.select("window", "n", "place", "t.term", "t.offset"))


def _among(rows: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys are among those of asked, and a few others."""
    bits = ngrams._bits(asked.select(F.xxhash64(*keys).alias("hash")))
    return rows.filter(ngrams._holds(bits, F.xxhash64(*keys)))


def candidates(index: DataFrame, windows: DataFrame, lists: int = LISTS) -> DataFrame:
    """(window, n, doc, start): where the rarest terms of a window stand at their offsets."""
    ranked = _ranked_terms(index, windows, lists)
    chosen = cut_lineage(ranked.select("term").distinct())
    postings = cut_lineage(index.join(chosen, "term", "left_semi"))
    found = None
    for place in range(lists):
        own = ranked.filter(F.col("place") == place).select("window", "n", "term", "offset")
        if found is None:
            found = postings.join(own, "term").select("window", "n", "doc", (F.col("pos") - F.col("offset")).alias("start"))
            found = cut_lineage(found.filter("start >= 0"))
            continue
        listed = postings.join(cut_lineage(own.select("term").distinct()), "term", "left_semi")
        asked = found.join(own, ["window", "n"]).withColumn("pos", F.col("start") + F.col("offset"))
        listed = _among(listed, asked, ["term", "doc", "pos"])
        # candidates grow with the documents, so they are never broadcast
        kept = asked.hint("merge").join(listed, ["term", "doc", "pos"], "left_semi").select("window", "n", "doc", "start")
        # windows of fewer terms than lists were complete before
        short = found.filter(F.col("n") <= place)
        found = cut_lineage(kept.unionByName(short))
    return found


def phrase_matches(docs: DataFrame, index: DataFrame, windows: DataFrame, lists: int = LISTS) -> DataFrame:
    """(doc, window, n, start) of all windows that occur, each once."""
    maybe = candidates(index, windows, lists)
    by_doc = cut_lineage(maybe.groupBy("doc").agg(F.collect_set(F.struct("window", "n", "start")).alias("maybe")))
    own = _among(docs.select(doc_key().alias("doc"), "text"), by_doc, ["doc"])
    own = own.join(by_doc.select("doc"), "doc", "left_semi").dropDuplicates(["doc"])
    split = own.select("doc", words(F.col("text")).alias("words")).join(by_doc, "doc")
    cut = split.select("doc", "words", F.explode("maybe").alias("m")).select(
        "doc", "m.*", F.slice("words", F.col("m.start") + 1, F.col("m.n")).alias("found")
    )
    asked = windows.select("window", F.col("words").alias("asked"))
    return cut.join(asked, "window").filter(F.col("found") == F.col("asked")).select("doc", "window", "n", "start")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW, lists: int = LISTS, index: DataFrame | None = None) -> DataFrame:
    """(doc, doc_id, n_words, n_hit, items): the words that stand in a window of an item, and the
    sorted ids of these items as strings; a row for every row of docs."""
    windows = cut_lineage(item_windows(items, size))
    index = build_index(docs) if index is None else index
    matched = cut_lineage(phrase_matches(docs.select("doc_id", "text"), index, windows, lists))
    place = F.sequence("start", F.col("start") + F.col("n") - 1)
    hit = matched.groupBy("doc").agg(F.size(F.array_distinct(F.flatten(F.collect_list(place)))).cast("long").alias("n_hit"))
    names = (
        matched.select("doc", "window").distinct()
        .join(windows.select("window", F.explode("items").alias("item_id")), "window")
        .groupBy("doc")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    hits = cut_lineage(hit.join(names, "doc", "left"))
    sizes = index.groupBy("doc").agg((F.max("pos") + 1).cast("long").alias("n_words"))
    none, zero = F.array().cast("array<string>"), F.lit(0).cast("long")
    return (
        docs.select(doc_key().alias("doc"), "doc_id")
        .join(sizes, "doc", "left")
        .join(hits, "doc", "left")
        .select("doc", "doc_id", F.coalesce("n_words", zero).alias("n_words"), F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("items", none).alias("items"))
    )


def proximity_matches(index: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """(phrase_id, doc, start, end): where all words of a phrase stand, in any order, in at most
    `within` words around one of its rarest word; of all windows that hold this one and all words, those
    that contain no shorter one.  phrases: phrase_id, text."""
    split = phrases.select("phrase_id", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    terms = cut_lineage(split.select("phrase_id", F.xxhash64("word").alias("term")))
    postings = index.join(cut_lineage(terms.select("term").distinct()), "term", "left_semi")
    counts = cut_lineage(postings.groupBy("term").agg(F.count("*").alias("postings")))
    ranked = terms.join(counts, "term", "left").groupBy("phrase_id").agg(
        F.min_by("term", F.struct(F.coalesce("postings", F.lit(0)), "term")).alias("rarest"), F.count("*").alias("n")
    )
    ranked = cut_lineage(ranked)
    slot = F.floor(F.col("pos") / within)
    centre = (
        index.withColumnRenamed("term", "rarest")
        .join(ranked, "rarest")
        .select("phrase_id", "n", "doc", F.col("pos").alias("at"), F.explode(F.array(slot - 1, slot, slot + 1)).alias("slot"))
    )
    near = centre.join(postings.withColumn("slot", slot), ["doc", "slot"]).join(terms, ["phrase_id", "term"])
    near = cut_lineage(near.filter(F.abs(F.col("pos") - F.col("at")) < within).select("phrase_id", "n", "doc", "at", "term", "pos").distinct())
    # the windows that begin at a posting up to the centre and hold it; of each other word the first posting in it decides
    begins = near.filter("pos <= at").select("phrase_id", "doc", "at", F.col("pos").alias("start")).distinct()
    inside = near.join(begins, ["phrase_id", "doc", "at"]).filter((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + within))
    firsts = inside.groupBy("phrase_id", "n", "doc", "at", "start", "term").agg(F.min("pos").alias("pos"))
    spans = firsts.groupBy("phrase_id", "n", "doc", "at", "start").agg(
        F.count("*").alias("found"), (F.greatest("at", F.max("pos")) + 1).alias("end")
    )
    spans = spans.filter(F.col("found") == F.col("n"))
    # of windows around one centre with one end the shortest
    least = spans.groupBy("phrase_id", "doc", "at", "end").agg(F.max("start").alias("start"))
    return least.select("phrase_id", "doc", "start", "end").distinct()
