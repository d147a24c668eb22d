"""Registered queries: text functions, phrase counts, totals, pruning, shares, roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.functions import text as T
from chatterscope.functions import time as TM
from chatterscope.operators import ngrams as N
from chatterscope.plans import fixtures as X
from chatterscope.plans.catalog import Catalog

CATALOG = Catalog()
query = CATALOG.query

def _count():
    return F.count(F.lit(1)).alias("cnt")


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.comments(spark, sf_dir).select(
        "id", T.normalize_text(F.col("body")).alias("normalized")
    )


def bucketed(spark: SparkSession, sf_dir: str, grain: str = "month") -> DataFrame:
    return X.comments(spark, sf_dir).withColumn("bucket", TM.bucket_time(F.col("created_utc"), grain))


def community_counts(spark: SparkSession, sf_dir: str, grain: str = "month") -> DataFrame:
    occurrences = N.phrases(bucketed(spark, sf_dir, grain), ["bucket", "community"])
    return N.count_phrases(occurrences, ["bucket", "community"])


def frequent_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bucket, community, n, ngram, cnt, total of the bucket: phrases above the fixed floors, the others not shuffled."""
    return N.frequent_phrases(bucketed(spark, sf_dir), ["bucket", "community"], ["bucket"])


def _words(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return N.tokenized_comments(bucketed(spark, sf_dir), keep)


BUCKETED = (
    X.TOKENS
    + """,
cc AS (SELECT CAST(date_trunc('month', make_timestamp(CAST(created_utc AS BIGINT) * 1000000)) AS DATE) AS bucket,
              community, n, ngram, count(*) AS cnt FROM phrases GROUP BY ALL),
bt AS (SELECT bucket, n, CAST(sum(cnt) AS BIGINT) AS total FROM cc GROUP BY ALL),
gt AS (SELECT n, CAST(sum(cnt) AS BIGINT) AS total FROM cc GROUP BY ALL)"""
)
FLOOR = "cnt > CASE WHEN n = 1 THEN 20 ELSE 3 END"


@query(
    f"WITH {X.COMMENTS} SELECT id, {X.sql_normalize('body')} AS normalized FROM comments"
)
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir)


@query(
    f"WITH {X.COMMENTS}, t AS (SELECT unnest(regexp_extract_all({X.sql_normalize('body')}, "
    f"{X.PLAIN_TOKEN_SQL})) AS token FROM comments) "
    "SELECT token, count(*) AS cnt FROM t GROUP BY token"
)
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _normalized(spark, sf_dir).select(
        F.explode_outer(T.tokenize(F.col("normalized"))).alias("token")
    )
    return tokens.where(F.col("token").isNotNull()).groupBy("token").agg(_count())


@query(
    f"""WITH {X.COMMENTS},
m AS (SELECT id, string_split({X.sql_marked(X.sql_normalize('body'), keep_tail=True)}, chr(1)) AS s FROM comments),
s AS (SELECT id, unnest(s) AS s, generate_subscripts(s, 1) AS raw_pos FROM m),
p AS (SELECT id, s, row_number() OVER (PARTITION BY id ORDER BY raw_pos) AS sentence FROM s WHERE trim(s) <> ''),
t AS (SELECT id, sentence, regexp_extract_all(s, {X.GLUED_TOKEN_SQL}) AS toks FROM p)
SELECT id, sentence, array_to_string(flatten([CASE WHEN starts_with(x, chr(2)) THEN string_split(x[2:], '') ELSE [x] END FOR x IN toks]), ' ') AS tokens FROM t"""
)
def segment_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    sentences = _normalized(spark, sf_dir).select(
        "id", F.posexplode_outer(T.segment_sentences(F.col("normalized")))
    )
    return sentences.where(F.col("col").isNotNull()).select(
        "id",
        (F.col("pos") + 1).cast("bigint").alias("sentence"),
        F.array_join("col", " ").alias("tokens"),
    )


@query(
    f"""WITH {X.TOKENS}
SELECT id, string_agg(replace(tok, chr(1), '|'), ' ' ORDER BY pos) AS tokens FROM kept GROUP BY id"""
)
def strip_punctuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = T.strip_punctuation(T.sentence_tokens(F.col("normalized")))
    joined = F.translate(F.array_join(kept, " "), T.BREAK, "|")
    return N.computed_once(_normalized(spark, sf_dir), ["id"], joined, "tokens").where(F.col("tokens") != "")


@query(
    f"""WITH {X.TOKENS}
SELECT tok AS stop_word, count(*) AS cnt FROM kept WHERE tok IN ({X.STOP_SQL}) GROUP BY tok"""
)
def stopword_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each stop word occurs."""
    tokens = _normalized(spark, sf_dir).select(
        F.explode_outer(T.strip_punctuation(T.sentence_tokens(F.col("normalized")))).alias(
            "stop_word"
        )
    )
    return tokens.where(F.col("stop_word").isin(T.stopword_set())).groupBy("stop_word").agg(_count())


@query(f"WITH {X.TOKENS} SELECT ngram, count(*) AS cnt FROM phrases WHERE n = 2 GROUP BY ngram")
def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = N.phrases(X.comments(spark, sf_dir), [], ns=[2])
    return pairs.groupBy("ngram").agg(_count())


@query(
    f"""WITH {X.TOKENS},
s AS (SELECT id, pos, tok, lead(tok) OVER (PARTITION BY id ORDER BY pos) AS nxt FROM kept)
SELECT id, count(*) AS windows,
       count(*) FILTER (tok NOT IN ({X.STOP_SQL}) AND nxt NOT IN ({X.STOP_SQL})) AS kept_windows
FROM s WHERE tok <> chr(1) AND nxt <> chr(1) GROUP BY id"""
)
def drop_stopword_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word windows per comment, with and without those that touch a stop word."""
    tokens = T.strip_punctuation(T.sentence_tokens(F.col("normalized")))
    split = N.computed_once(_normalized(spark, sf_dir), ["id"], tokens, "tokens")
    words = split.select(
        "id",
        T.phrase_words(F.col("tokens"), stop_words=[]).alias("all_words"),
        T.phrase_words(F.col("tokens")).alias("words"),
    )

    def windows(column: str):
        grams = T.ngrams(F.col(column), 2)
        return F.size(F.filter(grams, lambda g: g.isNotNull())).cast("bigint")

    both = F.struct(windows("all_words").alias("windows"), windows("words").alias("kept_windows"))
    return N.computed_once(words, ["id"], both, "both").select("id", "both.*").where(F.col("windows") > 0)


@query(
    f"""WITH {X.TOKENS}
SELECT id, count(w) AS words, count(*) FILTER (length(w) > 1) AS kept_words
FROM kept GROUP BY id HAVING count(w) > 0"""
)
def unigram_min_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single words per comment before and after the length rule."""
    words = T.phrase_words(T.strip_punctuation(T.sentence_tokens(F.col("normalized"))))
    split = N.computed_once(_normalized(spark, sf_dir), ["id"], words, "words")
    return split.select(
        "id",
        F.size(F.filter("words", lambda w: w.isNotNull())).cast("bigint").alias("words"),
        F.size(F.filter("words", lambda w: T.is_counted(F.lit(1), w)))
        .cast("bigint")
        .alias("kept_words"),
    ).where(F.col("words") > 0)


@query(
    f"WITH {X.MONTHLY} SELECT month, 'allsubreddit' AS community, n, ngram, cnt FROM month_counts"
)
def ngram_count_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = N.count_phrases(N.phrases(X.comments(spark, sf_dir), ["month"]), ["month"])
    return N.label_all(counts)


@query(f"WITH {BUCKETED} SELECT * FROM cc")
def ngram_count_community_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community_counts(spark, sf_dir)


@query(
    f"""WITH {X.TOKENS},
d AS (SELECT CAST(make_timestamp(CAST(created_utc AS BIGINT) * 1000000) AS DATE) AS bucket,
             community, n, ngram, count(*) AS cnt FROM phrases GROUP BY ALL),
g AS (SELECT n, CAST(sum(cnt) AS BIGINT) AS total FROM d GROUP BY n)
SELECT bucket, community, n, ngram, cnt, total, round(cnt / CAST(total AS DOUBLE), 12) AS percentage
FROM d JOIN g USING (n)
WHERE cnt > CASE WHEN n = 1 THEN greatest(20, floor(1e-7 * total)) ELSE greatest(3, floor(5e-8 * total)) END"""
)
def ngram_count_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day and community, n = 1..3, pruned and divided by the total over all days."""
    found = N.frequent_phrases(bucketed(spark, sf_dir, "day"), ["bucket", "community"], adaptive=True)
    return _rounded(N.relative_frequency(found))


@query(f"WITH {X.TOKENS} SELECT id, n, count(*) AS cnt FROM phrases GROUP BY id, n")
def ngram_all_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass over the text for n = 1, 2 and 3."""
    return N.phrases(X.comments(spark, sf_dir), ["id"]).groupBy("id", "n").agg(_count())


@query(f"WITH {BUCKETED} SELECT * FROM bt")
def bucket_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.window_totals(_words(spark, sf_dir, "bucket"), ["bucket"])


@query(f"WITH {BUCKETED} SELECT * FROM gt")
def grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.window_totals(_words(spark, sf_dir))


@query(f"WITH {X.MONTHLY} SELECT * EXCLUDE (percentage) FROM monthly")
def prune_adaptive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.monthly_frequent(X.comments(spark, sf_dir)).drop("percentage")


@query(f"WITH {X.MONTHLY} SELECT month, n, ngram, cnt, total FROM monthly")
def frequent_phrases_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As prune_adaptive; what cannot reach the floor is left out before the shuffle."""
    return N.frequent_phrases(X.comments(spark, sf_dir), ["month"], ["month"], adaptive=True)


@query(f"WITH {BUCKETED} SELECT cc.*, total FROM cc JOIN bt USING (bucket, n) WHERE {FLOOR}")
def frequent_phrases_community(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequent_counts(spark, sf_dir)


@query(f"WITH {BUCKETED} SELECT * FROM cc WHERE {FLOOR}")
def prune_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequent_counts(spark, sf_dir).drop("total")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("percentage", F.round("percentage", 12))


@query(f"WITH {X.MONTHLY} SELECT * REPLACE (round(percentage, 12) AS percentage) FROM monthly")
def relative_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(N.monthly_frequent(X.comments(spark, sf_dir)))


@query(
    f"WITH {BUCKETED}, r AS (SELECT community, n, ngram, CAST(sum(cnt) AS BIGINT) AS cnt FROM cc "
    f"GROUP BY ALL) SELECT r.*, total FROM r JOIN gt USING (n) WHERE {FLOOR}"
)
def community_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.frequent_phrases(X.comments(spark, sf_dir), ["community"])


@query(
    f"WITH {BUCKETED} SELECT community, n, ngram, CAST(sum(cnt) AS BIGINT) AS wcount, "
    f"CAST(sum(total) AS BIGINT) AS total FROM cc JOIN bt USING (bucket, n) WHERE {FLOOR} "
    "GROUP BY ALL"
)
def community_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.added_up(frequent_counts(spark, sf_dir))


@query(
    f"WITH {BUCKETED} SELECT cc.*, total, round(cnt / CAST(total AS DOUBLE), 12) AS percentage "
    f"FROM cc LEFT JOIN bt USING (bucket, n) WHERE {FLOOR}"
)
def join_bucket_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(N.relative_frequency(frequent_counts(spark, sf_dir)))
