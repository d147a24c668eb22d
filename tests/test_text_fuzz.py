"""Column expressions and their SQL counterparts agree on random mixtures of awkward pieces."""

import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from chatterscope.functions import text as T
from chatterscope.plans import fixtures as X

PIECES = (
    "a ab The x. Mr. 3.14 http:// https:// htt:// href= xhref= ( [ ] ) a.com b-c.org/x_y w.w.w.net "
    "... .. . ? ! ?! ' '' \" , ,, ; : / &amp; &gt &lt; &quot; &tilde; &mdash; &a; &ab; \\u00e9 "
    "\\u00E9 \\uzz <img {src}> <img\tx/> <img> _ __a - -- é É ß 日本 — … { } = <> 1,000 10.5 t.co/abc "
    "bit.ly http://bit.ly/x # @me % * + ~ ` ^ $ | \\ don't can't. it's, end"
).replace("{src}", "src=x").split(" ")
SPACES = [" ", "  ", "\n", "\t", "\n\n", "\x0b", "\r\n", "", "", "", ""]


def texts(count=4000):
    rng = random.Random(7)
    for _ in range(count):
        parts = []
        for _ in range(rng.randint(0, 14)):
            parts += [rng.choice(PIECES), rng.choice(SPACES)]
        yield rng.choice(SPACES) + "".join(parts)


def test_spark_and_sql_agree(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "id bigint, t string")
    normal = df.select("id", T.normalize_text(F.col("t")).alias("n"))
    got = normal.select(
        "id",
        "n",
        T.tokenize(F.col("n")).alias("plain"),
        T.sentence_tokens(F.col("n")).alias("tokens"),
        T.segment_sentences(F.col("n")).alias("sentences"),
    ).orderBy("id")
    con = duckdb.connect()
    con.register("input", pd.DataFrame(rows, columns=["id", "t"]))
    tail = X.sql_marked("n", keep_tail=True)
    sql = f"""WITH a AS (SELECT id, {X.sql_normalize('t')} AS n FROM input)
    SELECT id, n, regexp_extract_all(n, {X.PLAIN_TOKEN_SQL}),
           regexp_extract_all({X.sql_marked('n')}, {X.GLUED_TOKEN_SQL}),
           [flatten([CASE WHEN starts_with(x, chr(2)) THEN string_split(x[2:], '') ELSE [x] END
                     FOR x IN regexp_extract_all(s, {X.GLUED_TOKEN_SQL})])
            FOR s IN string_split({tail}, chr(1)) IF trim(s) <> '']
    FROM a ORDER BY id"""
    wrong = [
        (rows[r.id][1], tuple(r)[1:], e[1:])
        for r, e in zip(got.collect(), con.execute(sql).fetchall())
        if list(r)[1:] != [list(v) if isinstance(v, (list, tuple)) else v for v in e[1:]]
    ]
    assert not wrong, (len(wrong), wrong[:5])
