from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from urndraw.llm import langid


def slow_predict(rows, text):
    """The same score from plain counters."""
    languages = sorted({lang for _, _, lang in rows if lang is not None})
    counts = {}
    for _, t, lang in rows:
        for word in langid.words_of(t or ""):
            counts.setdefault((lang, 0), Counter())[word] += 1
            for n in langid.ORDERS:
                counts.setdefault((lang, n), Counter()).update(langid.grams(word, n))
    known = {n: set().union(*(counts.get((lang, n), {}) for lang in languages)) for n in (0, *langid.ORDERS)}

    def logs(n, gram):
        found = [math.log((counts.get((lang, n), Counter())[gram] + 0.5) / (sum(counts.get((lang, n), Counter()).values()) + 1)) for lang in languages]
        return [x - sum(found) / len(found) for x in found]

    words = langid.words_of(text or "")
    if not words or not languages:
        return "und", 0.0
    total = [0.0] * len(languages)
    for word in words:
        parts = [logs(0, word)] if word in known[0] else next(
            ([logs(n, g) for g in langid.grams(word, n) if g in known[n]] for n in langid.ORDERS if any(g in known[n] for g in langid.grams(word, n))), [])
        for p in parts:
            total = [a + b / len(parts) for a, b in zip(total, p)]
    total = [x / math.sqrt(len(words)) for x in total]
    shares = [math.exp(x - max(total)) for x in total]
    best = shares.index(max(shares))
    return languages[best], shares[best] / sum(shares)


ROWS = [
    (1, "the house of the king", "en"), (2, "the tree and the sea", "en"), (3, "das haus und der baum", "de"),
    (4, "der könig und die see", "de"), (5, None, "en"), (6, "", "de"), (None, "nobody", "xx"), (7, "no label", None),
]


def test_predictions_equal_counters(spark):
    table = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").withColumn("score", F.lit("own")).withColumn("n", F.lit(2))
    model = langid.train(table)
    assert model.languages == ["de", "en"]
    texts = [None, "", "123 !!", "the baum", "thehouse", "königin zzz", "qqq", "The KING " * 5000, "²"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(asked, model).collect()}
    learned = [r for r in ROWS if r[0] is not None and r[2] is not None]
    for i, t in enumerate(texts):
        lang, score = slow_predict(learned, t) if t != "²" else ("und", 0.0)
        assert got[i][0] == lang and got[i][1] == pytest.approx(score, abs=1e-9), t
    kept = langid.with_language(table, model)
    assert kept.columns == ["doc_id", "text", "lang", "n", "lang_pred", "score"] and kept.count() == len(ROWS)


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.train(empty)
    assert langid.predict(empty, model).count() == 0
    assert langid.predict(spark.createDataFrame([(1, "word")], "doc_id long, text string"), model).first()[1:] == ("und", 0.0)


def test_held_out_accuracy(spark):
    from urndraw.llm.queries import QUERIES

    found = QUERIES["op6_langid"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.where("held_out").join(docs, "doc_id").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
    assert found.count() == 1000
