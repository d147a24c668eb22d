"""A naive Bayes model of sentence ends, fitted by counting.

An optional replacement of the fixed sentence rule: candidates are punctuation tokens, described
by the word before, the mark, whether that word has one character and whether the next one is
capitalized.  Probabilities are expected-likelihood estimates (one half added to each count).

``mark_sentences`` puts its decisions into texts; ``ngrams.phrases(..., model=...)`` cuts phrases there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.functions import text as T
from chatterscope.session import COMPACT, cut_lineage, cut_rounds, rounds_of

# Marks that are trained on and marks that are classified.
TRAINED_MARKS = (".", "?", "!")
SCORED_MARKS = (",", ".", "?", "!", '"', "(", ")", "[", "]", "{", "}")
FEATURES = ("next_cap", "prevword", "punct", "one_char")
SMALL_FEATURES = ("next_cap", "punct", "one_char")
GAMMA = 0.5
#: Stands for a feature's unseen values in the map of numbers; no value is equal to it.
UNSEEN = "\x00"
#: ``monotonically_increasing_id`` puts the number of the task above so many bits.
TASK_BITS = 33

_TOKEN = r"[\p{L}\p{N}_]+|\n+|[^\p{L}\p{N}_\s]"
#: The same tokens and the white space between them: all of a text.
PART = r"[\p{L}\p{N}_]+|\n+|[ \t\x0B\f\r]+|[^\p{L}\p{N}_ \t\n\x0B\f\r]"
_BLANKS = (" ", "\t", "\x0b", "\f", "\r")


def candidates(documents: DataFrame, marks=TRAINED_MARKS, id: str = "id") -> DataFrame:
    """id, pos, the four features as text, and ends_line: whether a line break follows."""
    tokens = documents.select(
        id, F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(0)).alias("t")
    )
    return _described(tokens.withColumn("pos", F.transform("t", lambda x, i: i)), marks, id)


def _described(tokens: DataFrame, marks, id: str) -> DataFrame:
    """The candidates among tokens (``id``, t, pos, two arrays side by side)."""
    tokens = tokens.select(
        id,
        F.col("t").alias("tok"),
        F.concat(F.array(F.lit(None).cast("string")), "t").alias("prev"),
        F.slice("t", 2, F.size("t")).alias("next"),
        F.slice("t", 3, F.size("t")).alias("after"),
        "pos",
    )
    zipped = F.filter(
        F.arrays_zip("tok", "prev", "next", "after", "pos"), lambda z: z["tok"].isin(list(marks))
    )
    # outer, so that Spark does not compute the arrays once more to test them
    rows = tokens.select(id, F.inline_outer(zipped)).where(F.col("prev").isNotNull())
    ends_line = F.coalesce(F.col("next").startswith("\n"), F.lit(False))
    word = F.coalesce(F.when(ends_line, F.col("after")).otherwise(F.col("next")), F.lit(""))
    first = F.substring(word, 1, 1)
    return rows.select(
        id,
        "pos",
        ((first == F.upper(first)) & (first != F.lower(first))).cast("string").alias("next_cap"),
        F.lower("prev").alias("prevword"),
        F.col("tok").alias("punct"),
        (F.length("prev") == 1).cast("string").alias("one_char"),
        ends_line.alias("ends_line"),
    )


def _log(count: Column, total: Column, bins: Column) -> Column:
    return F.log2((count + GAMMA) / (total + GAMMA * bins))


def boundary_model_fit(labelled: DataFrame, label: str = "ends_line") -> DataFrame:
    """feature, value, true_log, false_log.

    The row with feature ``label`` holds the priors, rows with value NULL what unseen values get.
    """
    pairs = F.array(
        F.struct(F.lit("label").alias("feature"), F.lit("").alias("value")),
        *[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES],
    )
    counts = (
        labelled.select(label, F.inline(pairs))
        .groupBy("feature", "value")
        .agg(
            F.count_if(F.col(label)).alias("trues"),
            F.count_if(~F.col(label)).alias("falses"),
        )
    )
    counts = cut_lineage(counts)  # both its rows and its sizes are used
    # one row per feature
    sizes = counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("bins"),
        F.sum("trues").alias("all_true"),
        F.sum("falses").alias("all_false"),
    )
    unseen = sizes.select(
        "feature", F.lit(None).cast("string").alias("value"), F.lit(0).cast("bigint").alias("trues"),
        F.lit(0).cast("bigint").alias("falses"),
    ).where(F.col("feature") != "label")
    rows = counts.unionByName(unseen).join(F.broadcast(sizes), "feature")
    prior = F.col("feature") == "label"
    both = F.col("all_true") + F.col("all_false")

    def logs(mine: str, total: str) -> Column:
        return F.when(prior, _log(F.col(mine), both, F.lit(2))).otherwise(
            _log(F.col(mine), F.col(total), F.col("bins"))
        )

    return rows.select(
        "feature",
        "value",
        logs("trues", "all_true").alias("true_log"),
        logs("falses", "all_false").alias("false_log"),
    )


def boundary_model_score(found: DataFrame, model: DataFrame) -> DataFrame:
    """Adds true_log, false_log and boundary to candidates.

    Priors, defaults and the values of the small features are about a dozen numbers (two per flag,
    one per trained mark) and come as one map.  Previous words are as many as the vocabulary: they
    are joined without a hint, and AQE splits frequent ones.
    """
    small = model.where((F.col("feature") != "prevword") | F.col("value").isNull())
    logs = F.struct("true_log", "false_log")
    key = F.concat_ws(":", F.col("feature"), F.coalesce("value", F.lit(UNSEEN)))
    known = small.agg(F.map_from_entries(F.collect_list(F.struct(key, logs))).alias("m")).scalar()

    words = model.where((F.col("feature") == "prevword") & F.col("value").isNotNull()).select(
        F.col("value").alias("prevword"),
        F.col("true_log").alias("word_true"),
        F.col("false_log").alias("word_false"),
    )

    def total(side: str) -> Column:
        column = f"{side}_log"
        logs = known["label:"][column]
        for feature in SMALL_FEATURES:
            seen = known[F.concat(F.lit(f"{feature}:"), F.col(feature))]
            logs = logs + F.coalesce(seen[column], known[f"{feature}:{UNSEEN}"][column])
        return logs + F.coalesce(f"word_{side}", known[f"prevword:{UNSEEN}"][column])

    scored = found.join(words, "prevword", "left").select(
        *found.columns, total("true").alias("true_log"), total("false").alias("false_log")
    )
    return scored.withColumn("boundary", F.col("true_log") > F.col("false_log"))


def mark_sentences(texts: DataFrame, model: DataFrame, text: str = "normalized") -> DataFrame:
    """The rows of texts with ``text`` changed: ``BREAK`` in place of each mark that ends a sentence.

    Texts are split once and the parts written.  Only distinct descriptions of candidates are scored;
    those that end a sentence are joined back (a description is shuffled with its candidates only if
    they are too many to be broadcast), and the places of a text's ends are gathered to an array, along which
    its parts are cut.  Large tables are joined with these arrays in rounds of whole files, as the parts are
    shuffled for it if the arrays are too many to be broadcast.
    """
    clean = F.replace(F.replace(F.col(text), F.lit(T.BREAK)), F.lit(T.TAIL))
    parts = texts.withColumn("parts", F.regexp_extract_all(clean, F.lit(PART), F.lit(0))).drop(text)
    parts = cut_lineage(parts.withColumn("row", F.monotonically_increasing_id()), COMPACT)
    numbered = F.transform("parts", lambda x, i: F.struct(x.alias("t"), i.alias("pos")))
    solid = F.filter(numbered, lambda p: ~F.substring(p["t"], 1, 1).isin(*_BLANKS))
    tokens = parts.select("row", solid.alias("s")).select("row", F.col("s.t").alias("t"), F.col("s.pos").alias("pos"))
    found = cut_lineage(_described(tokens, SCORED_MARKS, "row").select("row", "pos", *FEATURES), COMPACT)
    ends = boundary_model_score(found.select(*FEATURES).distinct(), model).where("boundary")
    ends = cut_lineage(ends.select(*FEATURES))
    places = found.join(ends, list(FEATURES), "left_semi").groupBy("row").agg(
        F.array_sort(F.collect_list("pos")).alias("places")
    )
    none = F.array().cast("array<int>")
    before = F.concat(F.array(F.lit(-1)), F.coalesce("places", none))
    after = F.concat(F.coalesce("places", none), F.array(F.size("parts")))
    piece = F.zip_with(
        before, after, lambda a, b: F.array_join(F.slice("parts", a + 2, b - a - 1), "")
    )

    def marked(parts: DataFrame, places: DataFrame) -> DataFrame:
        joined = parts.join(places, "row", "left")
        return joined.withColumn(text, F.array_join(piece, T.BREAK)).drop("parts", "places", "row")

    size = parts.agg(F.sum(F.size("parts")).alias("parts"), F.max("row").alias("row")).first()
    rounds = rounds_of(size["parts"] or 0)
    if rounds == 1:
        return marked(parts, places)
    # the upper bits of a row's number are those of the task that wrote it
    tasks, places = (size["row"] >> TASK_BITS) + 1, cut_lineage(places, COMPACT)
    ends_at = [tasks * r // rounds << TASK_BITS for r in range(rounds + 1)]
    ranges = [F.col("row").between(a, b - 1) for a, b in zip(ends_at, ends_at[1:], strict=False) if a < b]
    return cut_rounds([marked(parts.where(r), places.where(r)) for r in ranges])
