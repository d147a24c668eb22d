"""Text rules on literal rows."""

import pytest
from pyspark.sql import functions as F

from chatterscope.functions import text as T


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Hello WORLD", "hello world"),
        ("see http://a.com/b now", "see URLsub now"),
        ("see https://a.com/b", "see https://URLsub"),
        ("wait... what", "URLsub what"),
        ("e.g. this", "URLsub this"),
        ("(www.x.org/a-b.html)", "URLsub"),
        ("xhref=foo.com y", "xURLsub y"),
        ("xhttp://foo.com", "xURLsub"),
        ("3.14", "NUMBERsub"),
        ("42", "NUMBERsub"),
        ("1,5\n", "NUMBERsub\n"),
        ("42 is it", "42 is it"),
        ("a &gt; b &gt c", "a < b < c"),
        ("a &lt; b", "a &lt; b"),
        ("q &amp; a &quot;x&quot;", "q & a IMGsubxIMGsub"),
        ("&tilde;5 &mdash; &a;", "~5 - HTMLTags"),
        ("caf\\u00e9", "caf"),
        ("x <img src=y> z", "x IMGsub z"),
        ("x <img src=y/> z", "x <img src=y/> z"),
        ("", ""),
    ],
)
def test_normalize(spark, text, expected):
    assert one(spark, text, T.normalize_text(F.col("t"))) == expected


def test_tokenize(spark):
    got = one(spark, "don't,, go {a}--b!? _x", T.tokenize(F.col("t")))
    assert got == ["don", "t", ",,", " ", "go", " ", "{", "a", "}--", "b", "!", "?", " ", "_x"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("x doesn't pay 3.14, (really?)", [["x", "doesnt", "pay", "3.14", ",", "(", "really", "?", ")"]]),
        ("it is done. so what? yes", [["it", "is", "done", "."], ["so", "what", "?"], ["yes"]]),
        ("a x. b stays", [["a", "x.", "b", "stays"]]),
        ("they can't", [["they", "can", "t"]]),
        ("they can't.", [["they", "cant", "."]]),
        ('he said "stop it." then left', [["he", "said", '"', "stop", "it", ".", '"'], ["then", "left"]]),
        ("café déjà-vu", [["café", "déjà", "-", "vu"]]),
        ("no way!!  ", [["no", "way", "!", "!"]]),
        ("   ", []),
    ],
)
def test_segment(spark, text, expected):
    assert one(spark, text, T.segment_sentences(F.col("t"))) == expected


def test_strip_punctuation_is_a_substring_test(spark):
    rows = spark.createDataFrame([([".", "()", "--", "<", "#", "?!", "a", ","],)], "t array<string>")
    got = rows.select(T.strip_punctuation(F.col("t")).alias("x")).first()["x"]
    assert got == ["--", "<", "#", "a"]


def test_control_characters_are_no_breaks(spark):
    got = one(spark, "one\x01 two\x02 three", T.sentence_tokens(F.col("t")))
    assert got == ["one", "two", "three"]


def test_null_text(spark):
    assert one(spark, None, T.normalize_text(F.col("t"))) is None
    assert one(spark, None, T.sentence_tokens(F.col("t"))) is None


def test_long_words_stay_linear(spark):
    text = "a" * 200_000 + "." + "b-" * 100_000 + " end."
    assert one(spark, text, F.size(T.sentence_tokens(T.normalize_text(F.col("t"))))) > 1


def test_stopword_set():
    words = T.stopword_set()
    assert {"the", "a", "z", "don"} <= set(words) and len(words) == len(set(words))
