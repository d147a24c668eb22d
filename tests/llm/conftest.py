import pytest
from pyspark.sql import functions as F

#: Rows with nulls, empty and repeated texts, equal ids, and columns whose names the operators use.
ODD = [
    (1, "Hello world, this is a test. It has some words in it."),
    (1, "Hello world, this is a test. It has some words in it."),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, "naïve café 日本語 😀 <s> ▁x"),
    (5, "another text with the same id"),
    (None, "a text without an id"),
    (7, "a" * 5000),
    (8, "one two three four five six seven eight nine ten eleven twelve " * 300),
]
CLASHING = ["ids", "decoded", "n_tokens", "n_bytes", "score", "rejected", "n_removed", "n_sentences", "hashes", "positions", "base_score", "key", "doc", "words", "label"]


@pytest.fixture(scope="session")
def odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    return docs.withColumns({c: F.lit("x") for c in CLASHING}).withColumn("lang", F.lit(None).cast("string"))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
