"""Registered queries: full-text search, sentence-end model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.operators import boundary as BD
from chatterscope.operators import ngrams as N
from chatterscope.operators import search as S
from chatterscope.plans import fixtures as X
from chatterscope.plans.catalog import Catalog
from chatterscope.session import cut_lineage, cut_rounds, fresh_path, spread

CATALOG = Catalog()
query = CATALOG.query

ASKED = "the reading of thou"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = X.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return spread(docs)


@query(
    f"""WITH w AS (SELECT doc_id AS id, regexp_extract_all(lower(text), {X.sql_text(S.WORD)}) AS words FROM documents),
st AS (SELECT count(*) AS n, avg(len(words)) AS avg_length FROM w),
p AS (SELECT id, length, term, count(*) AS tf FROM
      (SELECT id, len(words) AS length, unnest(words) AS term FROM w) GROUP BY ALL),
h AS (SELECT * FROM p WHERE term IN ('the', 'reading', 'of', 'thou')),
d AS (SELECT term, count(*) AS df FROM h GROUP BY term)
SELECT id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf::DOUBLE * 2.2::DOUBLE
       / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / avg_length))), 9) AS score
FROM h JOIN d USING (term), st GROUP BY id ORDER BY score DESC, id LIMIT 80"""
)
def text_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts are read once, for a stored index; the search reads only that."""
    docs = documents(spark, sf_dir)
    path = fresh_path(spark, "postings")
    S.write_postings(S.postings(docs), path)
    index = spark.read.parquet(path)
    return S.text_match(index, S.index_stats(index, docs.select("id")), ASKED)


@query("SELECT doc_id AS id, text FROM documents ORDER BY doc_id LIMIT 80")
def match_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = X.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return S.match_all(docs)


def _candidates_sql(name: str, marks: tuple[str, ...], context: str = "ctx") -> str:
    listed = ", ".join(X.sql_text(m) for m in marks)
    return f"""{name} AS (SELECT doc_id AS id, CAST(pos - 1 AS INTEGER) AS pos,
  CASE WHEN first = upper(first) AND first <> lower(first) THEN 'true' ELSE 'false' END AS next_cap,
  lower(prev) AS prevword, tok AS punct,
  CASE WHEN length(prev) = 1 THEN 'true' ELSE 'false' END AS one_char, ends_line
FROM (SELECT *, substring(coalesce(CASE WHEN ends_line THEN after ELSE nxt END, ''), 1, 1) AS first
      FROM (SELECT *, coalesce(starts_with(nxt, chr(10)), false) AS ends_line FROM {context}))
WHERE tok IN ({listed}) AND prev IS NOT NULL)"""


MODEL = rf"""WITH tk AS (SELECT doc_id, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|\n+|[^\p{{L}}\p{{N}}_\s]') AS toks FROM documents),
tr AS (SELECT doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM tk),
ctx AS (SELECT *, lag(tok) OVER d AS prev, lead(tok) OVER d AS nxt, lead(tok, 2) OVER d AS after
        FROM tr WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
{_candidates_sql("trained", BD.TRAINED_MARKS)},
fv AS (SELECT ends_line, 'label' AS feature, '' AS value FROM trained
  UNION ALL SELECT ends_line, 'next_cap', next_cap FROM trained
  UNION ALL SELECT ends_line, 'prevword', prevword FROM trained
  UNION ALL SELECT ends_line, 'punct', punct FROM trained
  UNION ALL SELECT ends_line, 'one_char', one_char FROM trained),
fc AS (SELECT feature, value, count(*) FILTER (ends_line) AS trues, count(*) FILTER (NOT ends_line) AS falses FROM fv GROUP BY ALL),
fs AS (SELECT feature, count(*) AS bins, sum(trues)::DOUBLE AS all_true, sum(falses)::DOUBLE AS all_false FROM fc GROUP BY ALL),
rows_ AS (SELECT * FROM fc UNION ALL SELECT feature, NULL, 0, 0 FROM fs WHERE feature <> 'label'),
model AS (SELECT feature, value,
  CASE WHEN feature = 'label' THEN log2((trues + 0.5::DOUBLE) / (all_true + all_false + 1)) ELSE log2((trues + 0.5::DOUBLE) / (all_true + 0.5::DOUBLE * bins)) END AS true_log,
  CASE WHEN feature = 'label' THEN log2((falses + 0.5::DOUBLE) / (all_true + all_false + 1)) ELSE log2((falses + 0.5::DOUBLE) / (all_false + 0.5::DOUBLE * bins)) END AS false_log
  FROM rows_ JOIN fs USING (feature))"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in ("true_log", "false_log")})


@query(
    f"{MODEL} SELECT feature, value, round(true_log, 9) AS true_log, round(false_log, 9) AS false_log FROM model"
)
def boundary_model_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(BD.boundary_model_fit(BD.candidates(documents(spark, sf_dir))))


def _side(side: str) -> str:
    terms = [f"(SELECT {side}_log FROM model WHERE feature = 'label')"]
    for f in BD.FEATURES:
        terms.append(
            f"coalesce({f}_m.{side}_log, (SELECT {side}_log FROM model WHERE feature = '{f}' AND value IS NULL))"
        )
    return "round(" + " + ".join(terms) + f", 9) AS {side}_log"


_JOINS = " ".join(
    f"LEFT JOIN model {f}_m ON {f}_m.feature = '{f}' AND {f}_m.value = s.{f}" for f in BD.FEATURES
)


@query(
    f"{MODEL}, {_candidates_sql('scored', BD.SCORED_MARKS)}, "
    f"r AS (SELECT id, pos, punct, {_side('true')}, {_side('false')} FROM scored s {_JOINS}) "
    "SELECT *, true_log > false_log AS boundary FROM r"
)
def boundary_model_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = cut_lineage(BD.boundary_model_fit(BD.candidates(docs)))
    scored = BD.boundary_model_score(BD.candidates(docs, BD.SCORED_MARKS), model)
    return _rounded(scored).select("id", "pos", "punct", "true_log", "false_log", "boundary")


@query(
    rf"""{MODEL}, {X.COMMENTS},
np AS (SELECT id, regexp_extract_all(replace(replace({X.sql_normalize('body')}, chr(1), ''), chr(2), ''), {X.sql_text(BD.PART)}) AS parts FROM comments),
part AS (SELECT id, unnest(parts) AS tok, generate_subscripts(parts, 1) AS pos FROM np),
solid AS (SELECT id AS doc_id, pos, tok, lag(tok) OVER d AS prev, lead(tok) OVER d AS nxt, lead(tok, 2) OVER d AS after
  FROM part WHERE NOT regexp_matches(tok, '^[ 	]') WINDOW d AS (PARTITION BY id ORDER BY pos)),
{_candidates_sql("scored", BD.SCORED_MARKS, "solid")},
ends AS (SELECT id, pos + 1 AS pos FROM (SELECT id, pos, {_side('true')}, {_side('false')} FROM scored s {_JOINS}) WHERE true_log > false_log),
joined AS (SELECT part.id, replace(string_agg(CASE WHEN ends.id IS NULL THEN tok ELSE chr(1) END, '' ORDER BY part.pos), '''', '') AS t
  FROM part LEFT JOIN ends USING (id, pos) GROUP BY part.id),
marked AS (SELECT id, author, community, month, created_utc, t FROM joined JOIN comments USING (id)),{X.PHRASES}
SELECT month, n, ngram, count(*) AS cnt FROM phrases GROUP BY ALL"""
)
def phrases_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrase counts by month, with sentences that end where the model says."""
    model = cut_lineage(BD.boundary_model_fit(BD.candidates(documents(spark, sf_dir))))
    return cut_rounds(N.phrase_rounds(X.comments(spark, sf_dir), ["month"], model=model))
