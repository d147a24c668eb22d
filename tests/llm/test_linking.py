"""Decontamination, tool calls and the pipeline."""

import collections
import glob
import json
import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chatterscope.llm import decontamination, queries, tool_calls


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(docs, items, size):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[k : k + size])].add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((doc_id, len(w), len(hit), sorted(str(x) for x in found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("lists", [1, 2, 3, 10])
def test_hits_equal_brute_force(spark, lists):
    rng = random.Random(lists)
    text = lambda n: " ".join(rng.choices(["the", "of", "A", "bb", "Çé", "x1"], k=n)) + rng.choice([".", "", "!!"])
    items = [(k, text(rng.choice([0, 1, 2, 5, 8]))) for k in range(12)] + [(77, None), (3, "the of zz")]
    docs = [(k, text(rng.choice([0, 1, 4, 60]))) for k in range(60)] + [(5, None), (5, ""), (None, text(9)), (9, "-- Ça ** A.bb")]
    found = decontamination.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        size=4,
        lists=lists,
    )
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=repr)
    assert got == brute_hits(docs, items, 4)
    assert any(r[2] for r in got)


def test_decontamination_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, "seven eight nine"), (1, "seven eight nine"), (None, "Hello"), (2, None), (3, "...")], "item_id long, text string")
    got = decontamination.decontaminate(odd, items.withColumn("words", F.lit(1)))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()), key=repr) == [
        (i, n, h, [x for x in names if x != "None"]) for i, n, h, names in brute_hits(
            [(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()], 10)
    ]
    assert decontamination.decontaminate(none, items).count() == 0
    assert decontamination.decontaminate(odd, items.limit(0)).filter("n_hit > 0").count() == 0


def test_texts_without_candidates_are_not_shuffled(spark, monkeypatch):
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randint(0, 300)}" for _ in range(n))
    items = [(k, text(14)) for k in range(5)]
    docs = [(i, f"{text(40)} {items[i // 400][1] if i % 400 == 0 else text(3)} {text(40)}") for i in range(2000)]
    seen, among = {}, decontamination._among

    def counted(rows, asked, keys):
        kept = among(rows, asked, keys)
        seen.setdefault(tuple(keys), []).append((rows.count(), kept.count()))
        return kept

    monkeypatch.setattr(decontamination, "_among", counted)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = decontamination.decontaminate(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in found.filter("n_hit > 0").collect()} == set(range(0, 2000, 400))
    (texts, kept), = seen["doc",]
    assert texts == 2000 and 5 <= kept <= 400
    assert len(seen["term", "doc", "pos"]) == 2 and all(kept < rows / 2 for rows, kept in seen["term", "doc", "pos"])


def test_texts_are_hashed_once_a_document(odd, monkeypatch):
    monkeypatch.setattr(decontamination, "cut_lineage", lambda df: df)
    plan = decontamination.build_index(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate posexplode") < plan.index("xxhash64(doc_id") and plan.count("split(") == 1


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x x blue green"), (2, "blue x x x x x x red green"), (3, "green red blue"), (4, "red blue")], "doc_id long, text string")
    phrases = spark.createDataFrame([(1, "red blue green"), (2, "nothing red")], "phrase_id long, text string")
    keys = {r.k: r.doc_id for r in docs.select("doc_id", decontamination.doc_key().alias("k")).collect()}
    got = decontamination.proximity_matches(decontamination.build_index(docs), phrases, 5).collect()
    assert {(r.phrase_id, keys[r.doc], r.start, r.end) for r in got} == {(1, 1, 0, 5), (1, 3, 0, 3)}


def brute_windows(docs, phrase, within):
    """(doc_id, start, end): the least windows with all words, around each of the rarest word."""
    wanted = set(words(phrase))
    counts = collections.Counter(w for _, text in docs for w in words(text) if w in wanted)
    (rarest, n), (_, more) = sorted(counts.items(), key=lambda x: x[1])[:2]
    assert n < more and set(counts) == wanted
    out = set()
    for doc_id, text in docs:
        w = words(text)
        for at in (k for k, x in enumerate(w) if x == rarest):
            all_ = [(s, e) for s in range(max(0, at - within + 1), at + 1) for e in range(at + 1, min(len(w), s + within) + 1) if wanted <= set(w[s:e])]
            out |= {(doc_id, s, e) for s, e in all_ if not any((s, e) != (x, y) and s <= x and y <= e for x, y in all_)}
    return out


def test_proximity_against_brute_force(spark):
    rng = random.Random(5)
    docs = [(0, " ".join("x x x x x x x x b x a x x b c".split()))]
    docs += [(k, " ".join(rng.choices(["a", "b", "c", "d", "x", "y"], [2, 5, 4, 3, 6, 6], k=rng.randint(0, 80)))) for k in range(1, 40)]
    phrases = [(1, "a b c"), (2, "d b"), (3, "d c b a"), (4, "C")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    keys = {r.k: r.doc_id for r in frame.select("doc_id", decontamination.doc_key().alias("k")).collect()}
    index, asked = decontamination.build_index(frame), spark.createDataFrame(phrases, "phrase_id long, text string")
    for within in (2, 5, 9):
        got = [(r.phrase_id, keys[r.doc], r.start, r.end) for r in decontamination.proximity_matches(index, asked, within).collect()]
        want = {(i, *x) for i, text in phrases[:3] for x in brute_windows(docs, text, within)}
        want |= {(4, d, k, k + 1) for d, text in docs for k, x in enumerate(text.split()) if x == "c"}
        assert len(got) == len(set(got)) and set(got) == want
        assert within < 5 or any(x[:2] == (1, 0) for x in got)


def test_decontamination_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got = queries.op1_decontamination(spark, sf_dir)
    result = con.execute(queries.CATALOG.sql["op1_decontamination"])
    names = [d[0] for d in result.description]
    want = sorted(tuple(r[names.index(c)] for c in got.columns) for r in result.fetchall())
    assert sorted(map(tuple, got.collect())) == want


SCHEMAS = [("f", "a", "integer", True), ("f", "b", "string", False), ("f", "c", "number", False), ("f", "d", "array", False), ("g", "x", "object", True), ("f", "a", "string", False)]


def brute_link(calls, results):
    """position, errors, cyclic of every call, by Kahn's rounds and json."""
    schemas = collections.defaultdict(dict)
    for name, param, kind, required in sorted(SCHEMAS):
        old = schemas[name].get(param)
        schemas[name][param] = (min(kind, old[0]), required or old[1]) if old else (kind, required)
    kinds = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}
    out = {}
    by_conv = collections.defaultdict(list)
    for c in calls:
        by_conv[c[0]].append(c)
    for conv, own in by_conv.items():
        first = {}
        for c in sorted((c for c in own if c[2] is not None), key=lambda c: (c[1], c[3], c[4] or "")):
            first.setdefault(c[2], c)
        low = {i: c[1] for i, c in first.items()}
        needs = {id(c): {n for n in c[5] or [] if n in first} for c in own}
        level = {id(c): 0 for c in own}
        if any(low[n] >= c[1] for c in own for n in needs[id(c)]):
            level, k = {}, 0
            while True:
                waiting = [c for c in own if id(c) not in level]
                open_ = {c[2] for c in waiting}
                ready = [c for c in waiting if not needs[id(c)] & open_]
                if not ready:
                    break
                level.update({id(c): k for c in ready})
                k += 1
        order = sorted(own, key=lambda c: (id(c) not in level, level.get(id(c), 0), c[1], c[2] is not None, c[2] or ""))
        for place, c in enumerate(order):
            try:
                args = json.loads(c[4])
                assert isinstance(args, dict)
            except Exception:
                args = None
            spec, errors = schemas.get(c[3]), []
            if args is None:
                errors = ["no JSON object"]
            elif spec is None:
                errors = ["unknown tool"]
            else:
                errors += [f"unknown argument {k}" for k in args if k not in spec]
                errors += [f"wrong type of {k}" for k, v in args.items() if k in spec and (not isinstance(v, kinds[spec[k][0]]) or isinstance(v, bool))]
                errors += [f"missing {k}" for k, (_, required) in spec.items() if required and k not in args]
                errors = sorted(errors)
            errors += sorted(f"needs unknown {n}" for n in set(c[5] or []) if n not in first)
            if c[2] is not None and first[c[2]] is not c:
                errors.append("repeated id")
            answers = sorted(r for r in results if (r[0], r[2]) == (conv, c[2])) if c[2] is not None and first[c[2]] is c else []
            line = json.dumps(
                {"arguments": args, "id": c[2], "name": c[3], "result": answers[0][3] if answers else None},
                sort_keys=True, separators=(",", ":"), ensure_ascii=False,
            )
            out[conv, place] = (c[1], c[2], errors, id(c) not in level, len(answers), line)
    return out


def test_linking_equals_brute_force(spark):
    rng = random.Random(6)
    texts = ['{"a":1}', '{"b":"é\\n\\"q\\"","a":2}', '{"c":1.5,"a":"1"}', "{}", "[1]", "broken {", None, '{"d":[1,{"z":1,"y":null}],"a":3}', '{"x":{"k":1}}', '{"e":true,"a":4}']
    calls, results = [], []
    for conv in range(30):
        n = rng.choice([1, 3, 8, 15])
        for seq in range(n):
            forward = rng.random() < 0.1
            needs = rng.choice([None, [], [f"c{rng.randrange(n) if forward else rng.randrange(seq + 1) - 1}" for _ in range(rng.randint(1, 2))]])
            calls.append((conv, seq, None if rng.random() < 0.03 else f"c{seq}", rng.choice(["f", "f", "g", "h"]), rng.choice(texts), needs))
            if rng.random() < 0.6:
                results.append((conv, seq + 1, f"c{seq}", rng.choice(['say "hi"\n', "", "ok"])))
                if rng.random() < 0.2:
                    results.append((conv, seq + 2, f"c{seq}", "late"))
    calls.append((1, 40, "c0", "f", '{"a":1}', []))  # a repeated id
    results += [(2, 1, "lost", "x"), (None, 1, None, None)]
    found = tool_calls.link(
        spark.createDataFrame(calls, "conv_id long, seq long, call_id string, name string, arguments string, needs array<string>").repartition(3),
        spark.createDataFrame(results, "conv_id long, seq long, call_id string, content string"),
        spark.createDataFrame(SCHEMAS, "name string, param string, kind string, required boolean"),
    ).collect()
    got = {(r.conv_id, r.position): (r.seq, r.call_id, r.errors, r.cyclic, r.n_results, r.line) for r in found if r.position is not None}
    assert got == brute_link(calls, results)
    assert any(v[3] for v in got.values())
    called = {(c[0], c[2]) for c in calls if c[2]}
    lone = {(r[0], r[2]) for r in results} - called
    assert {(r.conv_id, r.call_id) for r in found if r.position is None} == lone


def test_calls_of_conversations(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = queries.op8_tool_calls(spark, sf_dir).collect()
    assert len([r for r in rows if r.position is not None]) == turns.filter("role <> 'assistant'").count()
    assert sum(r.n_results for r in rows) == turns.filter("role = 'assistant'").count()
    assert all(json.loads(r.line)["id"] == r.call_id for r in rows)
    none = turns.limit(0)
    schemas = spark.createDataFrame([], "name string, param string, kind string, required boolean")
    assert tool_calls.link(*queries.calls_of(none), schemas).count() == 0


def test_pipeline(spark, sf_dir, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("bcdfghklm", k=6))
    sentence = lambda n=10: " ".join(word() for _ in range(n)) + "."
    page = lambda: " ".join(sentence() for _ in range(12))
    base, passage, item = page(), " ".join(sentence() for _ in range(6)), sentence(14)
    docs = [(i, f"{page()} {'scum ' if i % 4 == 0 else ''}{page()}", "en") for i in range(300)]
    docs += [(1000, base, "en"), (1001, base.replace(base.split()[30], "changed"), "en"), (1002, base, "fr")]
    docs += [(1003, f"{page()} {passage} {page()}", "en"), (1004, f"{page()} {passage} {page()}", "en")]
    docs += [(1005, f"{page()} {item} {page()}", "en"), (1006, None, "en"), (1007, "", None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "sentence_spans", "decontamination", "piece_bpe"]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    clean = {i for i in range(300) if i % 4}
    assert len(clean & set(got)) >= 0.99 * len(clean)
    assert len(set(range(300)) & set(got) - clean) <= 2
    assert {i for i in got if i >= 1000} == {1000, 1003, 1004, 1006, 1007}
    assert passage in got[1003].text and passage not in got[1004].text
    texts = dict((d[0], d[1]) for d in docs)
    assert all(r.text == texts[i] for i, r in got.items() if i != 1004)
    assert all(r.decoded == (r.text or "") and r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())
