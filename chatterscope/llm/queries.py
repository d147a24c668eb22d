"""The registered queries of this subpackage, with equivalent SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.llm import (
    decontamination,
    kneser_ney,
    merkle,
    near_duplicates,
    piece_bpe,
    sentence_spans,
    spelling,
    sql,
    token_counts,
    token_files,
    tool_calls,
    toxicity,
    warc,
    winnowing,
)
from chatterscope.plans.catalog import Catalog

CATALOG = Catalog()
TOKEN_LIMIT = 4096


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@CATALOG.query()
def op3_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, tokenizer("piece_bpe_32k.model"))
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


@CATALOG.query()
def op10_piece_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = piece_bpe.encode_decode(docs, tokenizer("piece_bpe_32k.model"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@CATALOG.query(
    r"""
    WITH doc AS (
        SELECT doc_id, hash(doc_id, text) AS key,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    item AS (
        SELECT item_id,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    cut AS (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS i FROM item WHERE len(w) > 0),
    win AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + 10], ' ') AS s FROM cut),
    size AS (SELECT DISTINCT n FROM win),
    gram AS (
        SELECT key, n, i, array_to_string(w[i + 1 : i + n], ' ') AS s
        FROM (SELECT key, n, w, unnest(range(len(w) - n + 1)) AS i FROM doc, size WHERE len(w) >= n)),
    hit AS (SELECT DISTINCT gram.key, gram.n, gram.i, win.item_id FROM gram JOIN win USING (n, s)),
    covered AS (SELECT key, count(DISTINCT p) AS n_hit FROM (SELECT key, unnest(range(i, i + n)) AS p FROM hit) GROUP BY key),
    names AS (
        SELECT key, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT key, item_id::VARCHAR AS id FROM hit) GROUP BY key)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc LEFT JOIN covered USING (key) LEFT JOIN names USING (key)
    """
)
def op1_decontamination(spark, sf_dir):
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@CATALOG.query()
def op5_sentence_spans(spark, sf_dir):
    cleaned = sentence_spans.dedup_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_sentences", "n_removed", "text")


@CATALOG.query()
def op6_near_duplicates(spark, sf_dir):
    found = near_duplicates.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_copies")


TOXICITY_FOLDS = 3


def toxicity_model(spark, docs, sf_dir):
    """Fitted on the labels of the rows that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.fit(docs, labels.filter(toxicity.fold(F.col("doc_id"), TOXICITY_FOLDS) != 1))


@CATALOG.query()
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = toxicity.rejected(docs, toxicity_model(spark, docs, sf_dir))
    held_out = F.coalesce(toxicity.fold(F.col("doc_id"), TOXICITY_FOLDS) == 1, F.lit(False))
    return found.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "rejected",
    )


@CATALOG.query()
def op9_kneser_ney(spark, sf_dir):
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(True))
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "text")
    scored = kneser_ney.score(docs, kneser_ney.train(docs.filter("NOT held_out")))
    return scored.drop("text")


@CATALOG.query()
def op4_winnowing(spark, sf_dir):
    return winnowing.compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


@CATALOG.query()
def op7_token_files(spark, sf_dir):
    folder = token_files.written(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=0)
    return token_files.read(spark, folder).select(
        "doc_id", "start", F.col("n_ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


#: The tools that turns of conversations are taken to call.
TOOLS = [
    ("search", "query", "string", True),
    ("search", "words", "integer", True),
    ("search", "exact", "boolean", False),
    ("translate", "query", "string", True),
    ("translate", "words", "integer", False),
]


def calls_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results in conversations without tools: each turn of a user or system calls a tool with
    its text, and an assistant's turn is the result of the turn before it.

    The length of a text chooses tool, faults in the arguments, and the turn needed: one of the two
    neighbours in the same eight turns.
    """
    n, t = F.length("text"), F.col("turn")
    arguments = F.to_json(
        F.struct(
            F.when(n % 13 == 0, F.lit("any")).alias("tone"),
            F.col("text").alias("query"),
            F.when(n % 7 == 0, None).when(n % 11 == 0, n.cast("string")).alias("words_"),
            F.when((n % 7 != 0) & (n % 11 != 0), n).alias("words"),
        )
    )
    arguments = F.regexp_replace(arguments, '"words_":', '"words":')
    needed = F.when((n % 5 == 0) & (t % 8 < 6), t + 2).when(t % 8 >= 2, t - 2)
    calls = turns.filter("NOT role <=> 'assistant'").select(
        "conv_id",
        t.cast("long").alias("seq"),
        F.concat(F.lit("c"), t).alias("call_id"),
        F.when(F.col("role") == "system", F.lit("configure")).when(n % 2 == 0, F.lit("search")).otherwise(F.lit("translate")).alias("name"),
        arguments.alias("arguments"),
        F.array_compact(F.array(F.concat(F.lit("c"), needed))).alias("needs"),
    )
    results = turns.filter("role = 'assistant'").select(
        "conv_id", t.cast("long").alias("seq"), F.concat(F.lit("c"), t - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results


@CATALOG.query()
def op8_tool_calls(spark, sf_dir):
    calls, results = calls_of(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(TOOLS, "name string, param string, kind string, required boolean")
    return tool_calls.link(calls, results, schemas)


@CATALOG.query(sql.spelling())
def op11_spelling_variants(spark, sf_dir):
    found = spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"), spelling.SLIP)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@CATALOG.query(sql.merkle())
def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = merkle.check_copy(docs, changed, merkle.lowered(F.col("text")))
    return found.select(
        "doc_id",
        "leaf",
        F.col("group_root").alias("subroot"),
        "root",
        merkle.proof_hash(F.col("steps")).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


@CATALOG.query(sql.WARC)
def op13_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.encode("html", "utf-8").alias("payload"))
    found = warc.round_trip(pages)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
