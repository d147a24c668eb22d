"""From raw documents to clean, encoded ones: stages over the table of documents.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but the last return the
columns of documents.  Rows with null or empty texts are clean: the classifier gives them the score of no
words, each is a class of its own, and nothing in them repeats or hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm import decontamination, near_duplicates, piece_bpe, sentence_spans, toxicity
from chatterscope.llm.queries import table, tokenizer, toxicity_model
from chatterscope.session import cut_lineage


def _beside(docs: DataFrame, *made: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with other names for columns that an operator would replace, and their own names."""
    own = {f"__own_{c}": c for c in made if c in docs.columns}
    return docs.withColumnsRenamed({c: renamed for renamed, c in own.items()}), own


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose score reaches the threshold of their language."""
    plain, own = _beside(docs, "score", "rejected")
    scored = toxicity.rejected(plain, toxicity_model(spark, docs, sf_dir)).filter(~F.col("rejected"))
    return scored.drop("score", "rejected").withColumnsRenamed(own).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every class of near copies; of rows equal in doc_id and text any one."""
    return near_duplicates.keep_first(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the sentences of passages that stand in an earlier place."""
    plain, own = _beside(docs, "n_sentences", "n_removed")
    cleaned = sentence_spans.dedup_spans(plain).drop("n_sentences", "n_removed")
    cleaned = cleaned.withColumnsRenamed(own).select(docs.columns)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    hit = found.filter("n_hit > 0").select(F.col("doc").alias("__doc")).distinct()
    keyed = docs.withColumn("__doc", decontamination.doc_key())
    return keyed.join(hit, "__doc", "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document and the text that they decode to."""
    return piece_bpe.encode_decode(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("sentence_spans", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("piece_bpe", encode),
]
#: No SQL: the stages train a classifier, draw weighted samples and merge by ranks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
