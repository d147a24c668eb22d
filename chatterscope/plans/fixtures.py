"""Inputs of the registered queries, derived from the given tables by Spark and, for the SQL
counterparts, by equal CTEs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope import constants as C
from chatterscope.functions import time as TM
from chatterscope.session import spread

# Comments get one of these endings in turn, so that every text rule has something to do.
ENDINGS = (
    "",
    " Visit http://example.com/a_b-c/d.html today &mdash; it's 3.14, (really?)",
    " wait... what &gt;quote&gt text &amp; more &quot;said&quot;",
    " caf\\u00e9 <img src=x> don't stop, mr. x isn't here",
    " [link](https://forum.example.org/r/x) &tilde;5 and &lt; or &a;",
    ' He said "stop it." Then we\'re done {into a bar} --> they\'ve',
    " a=b <> c-d, e,,f; g: h/i _under_score_ x_y 10,000.5",
    "\n\nEdit: thanks e.g. this!!! Not that?! ok",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, author, community, lang, body, month of the source file, created_utc as text."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    month = F.add_months(F.lit(C.FIRST_MONTH).cast("date"), (F.col("doc_id") % 12).cast("int"))
    day = F.date_add(month, (F.col("doc_id") % 28).cast("int"))
    return docs.select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("u"), (F.col("doc_id") % 50).cast("string")).alias("author"),
        F.col("source").alias("community"),
        "lang",
        F.concat("text", _pick((F.col("doc_id") % 8).cast("int"), ENDINGS)).alias("body"),
        month.alias("month"),
        (TM.epoch_millis(day) / 1000).cast("bigint").cast("string").alias("created_utc"),
    )


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


COMMENTS = (
    "comments AS (SELECT doc_id AS id, 'u' || (doc_id % 50) AS author, source AS community, lang, "
    "text || CASE doc_id % 8 "
    + " ".join(f"WHEN {i} THEN {sql_text(e)}" for i, e in enumerate(ENDINGS))
    + " END AS body, "
    "CAST(DATE '2007-10-01' + to_months(CAST(doc_id % 12 AS INTEGER)) AS DATE) AS month, "
    "CAST(CAST(epoch(CAST(DATE '2007-10-01' + to_months(CAST(doc_id % 12 AS INTEGER)) AS DATE) "
    "+ CAST(doc_id % 28 AS INTEGER)) AS BIGINT) AS VARCHAR) AS created_utc "
    "FROM documents)"
)

# --- text rules in SQL, written apart from the column expressions ------------------------------

# The patterns that the lower-cased text is searched for, in this order.
_W = r"\p{L}\p{N}_"
_S = r" \t\n\x0B\f\r"
_SUBS = (
    (
        r"(href=)?[\(\[]?(http?:\/\/)?([\da-z\.-]+)\.([a-z\.]{2,6})[\/\w\.-]*\/?[\)\]]?",
        "URLsub",
    ),
    (r"[\(\[]?(http://(bit\.ly|t\.co|lnkd\.in|tcrn\.ch)\S*)\b[\)\]]?", "shortURLsub"),
    (r"^[0-9]+([,.][0-9]+)?(\n?)\z", r"NUMBERsub\2"),
    ("&gt;?", "<"),
    ("&amp;?", "&"),
    ("&quot;?", "IMGsub"),
    ("&tilde;?", "~"),
    ("&mdash;?", "-"),
    (r"&\w;", "HTMLTags"),
    (r"\\u[0-9a-f]{4}", ""),
    (r"<img([^>]*[^/])>", "IMGsub"),
)


def _replace(expr: str, pattern: str, new: str) -> str:
    return f"regexp_replace({expr}, {sql_text(pattern)}, {new}, 'g')"


def sql_normalize(expr: str) -> str:
    expr = f"lower({expr})"
    for pattern, new in _SUBS:
        expr = _replace(expr, pattern, sql_text(new))
    return expr


def sql_marked(expr: str, keep_tail: bool = False) -> str:
    """Sentence breaks as chr(1); closing runs after chr(2) when kept."""
    tail, end = (r"chr(2) || '\2' || chr(1)", r"chr(2) || '\1' || chr(1)")
    expr = f"rtrim(replace(replace({expr}, chr(1), ''), chr(2), ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    run = r"""[.?!][.?!']*["'\)\]]*"""
    expr = _replace(
        expr,
        rf"([{_W}]'?[{_W}]'?)({run})[{_S}]+",
        r"'\1' || " + (tail if keep_tail else "chr(1)"),
    )
    expr = _replace(expr, rf"({run})\z", end if keep_tail else "chr(1)")
    expr = _replace(expr, rf"([{_W}]+'*)\z", r"' \1'")
    return f"replace({expr}, '''', '')"


PLAIN_TOKEN_SQL = sql_text(rf"[{_W}]+|[{_S}]+|,+|[{{}}\-<>=]+|[^{_W}{_S}']")
GLUED_TOKEN_SQL = sql_text(
    r"\x01|\x02[^\x01\x02]+"
    rf"|[^{_S}\"#$%&()*+,\-/:;<=>@\[\\\]^`{{|}}~\x01\x02]+"
    r"|,+|[{}\-<>=]+|[\"#$%&()*+/:;@\[\\\]^`|~]"
)
STOP_SQL = ", ".join(
    sql_text(w) for w in [*C.ENGLISH_STOP_WORDS, *"abcdefghijklmnopqrstuvwxyz"]
)
PUNCTUATION_SQL = sql_text(C.PUNCTUATION)

# kept: one row per token that is not punctuation; w is NULL for breaks and stop words
PHRASES = f"""
lists AS (SELECT * EXCLUDE (t), regexp_extract_all(t, {GLUED_TOKEN_SQL}) AS toks FROM marked),
toks AS (SELECT * EXCLUDE (toks), unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM lists),
kept AS (SELECT *, CASE WHEN tok = chr(1) OR tok IN ({STOP_SQL}) THEN NULL ELSE tok END AS w
         FROM toks WHERE NOT contains({PUNCTUATION_SQL}, tok)),
wide AS (SELECT *, lead(w, 1) OVER d AS w2, lead(w, 2) OVER d AS w3 FROM kept
         WINDOW d AS (PARTITION BY id ORDER BY pos)),
phrases AS (
  SELECT id, author, community, month, created_utc, 1 AS n, w AS ngram FROM wide WHERE length(w) > 1
  UNION ALL
  SELECT id, author, community, month, created_utc, 2, w || ' ' || w2 FROM wide
  WHERE w IS NOT NULL AND w2 IS NOT NULL
  UNION ALL
  SELECT id, author, community, month, created_utc, 3, w || ' ' || w2 || ' ' || w3 FROM wide
  WHERE w IS NOT NULL AND w2 IS NOT NULL AND w3 IS NOT NULL)"""
TOKENS = (
    COMMENTS
    + f""",
marked AS (SELECT id, author, community, month, created_utc, {sql_marked(sql_normalize('body'))} AS t FROM comments),"""
    + PHRASES
)

MONTHLY = (
    TOKENS
    + """,
month_counts AS (SELECT month, n, ngram, count(*) AS cnt FROM phrases GROUP BY ALL),
month_totals AS (SELECT month, n, CAST(sum(cnt) AS BIGINT) AS total FROM month_counts GROUP BY ALL),
monthly AS (
  SELECT month, 'allsubreddit' AS community, ngram, n, cnt, total,
         CAST(cnt AS DOUBLE) / total AS percentage
  FROM month_counts JOIN month_totals USING (month, n)
  WHERE cnt > CASE WHEN n = 1 THEN greatest(20, floor(1e-7 * total))
                   ELSE greatest(3, floor(5e-8 * total)) END)"""
)
