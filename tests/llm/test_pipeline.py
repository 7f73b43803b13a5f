from __future__ import annotations

import random

import public_tokenizers
from pyspark.sql import functions as F
from test_linededup import slow as slow_lines
from test_packing import PLAIN
from test_similar import slow_set

import corpus_pipeline
from urndraw.llm import langid, pii

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    rng = random.Random(7)
    words = {"en": "the house tree and sea with that king".split(), "de": "das haus der baum und see mit könig".split()}
    out = [(0, None, "en"), (1, "", "de"), (2, "12 !! 34", "en"), (3, "the tree", None)]
    for d in range(4, 80):
        lang = rng.choice(["en", "de"])
        lines = [" ".join(rng.choices(words[lang], k=rng.randint(3, 30))) + f" w{rng.randrange(10**6)}" for _ in range(rng.randint(1, 6))]
        out.append((d, "\n".join(lines), lang))
    for d in range(80, 100):
        text = out[rng.randrange(4, 80)][1]
        out.append((d, text + rng.choice(["", "", "\nthe end of joe@mail.example.com", " +1 (168) 555-5254"]), "en"))
    out += [(100, "one house", "en"), (101, "one house", "en"), (101, "one house", "en"), (None, "tree and sea", "en"), (None, "tree and sea", "en")]
    return out


def test_stages_equal_brute_force(spark):
    docs = spark.createDataFrame([(*r, "src", len(r[1] or "")) for r in rows()], COLUMNS)
    stages = dict(corpus_pipeline.STAGES)
    before = [(r.doc_id, r.text) for r in docs.collect()]
    table = stages["language"](spark, docs, "")
    kept = [(r.doc_id, r.text) for r in table.collect()]
    assert table.columns == docs.columns
    assert sorted(kept, key=str) == sorted(((d, t) for d, t in before if t and langid.words_of(t)), key=str)

    table = stages["lines"](spark, spark.createDataFrame(table.collect(), docs.schema), "")
    want = [(d, t) for d, t, n, gone in slow_lines(kept, 2) if not gone or gone < n]
    kept = [(r.doc_id, r.text) for r in table.collect()]
    assert sorted(kept, key=str) == sorted(want, key=str) and all(r.n_chars == len(r.text) for r in table.collect())

    table = stages["near_copies"](spark, spark.createDataFrame(table.collect(), docs.schema), "")
    want = slow_kept(kept)
    kept = [(r.doc_id, r.text) for r in table.collect()]
    assert sorted((d is None, d or 0) for d, _ in kept) == sorted((d is None, d or 0) for d, _ in want)

    table = stages["personal_data"](spark, spark.createDataFrame(table.collect(), docs.schema), "")
    for r in table.collect():
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
    assert table.count() == len(kept)
    kept = [(r.doc_id, r.text) for r in table.collect()]

    packed = stages["packing"](spark, spark.createDataFrame(table.collect(), docs.schema), "").collect()
    total = sum(len(e.ids) + 1 for e in PLAIN.encode_batch([t for _, t in kept], add_special_tokens=False))
    assert sum(r.length for r in packed) == total
    assert public_tokenizers and len({(r.sequence_id, r.offset) for r in packed}) == len(packed)


def slow_kept(kept):
    """The first row, null ids last, of each component of pairs with Jaccard of 0.8 or more."""
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0))
    sets, first = [slow_set(t) for _, t in ordered], list(range(len(ordered)))
    for i in range(len(ordered)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((first[i], first[j]))
                first = [a if f == b else f for f in first]
    return [r for i, r in enumerate(ordered) if first[i] == i]


def test_run_on_the_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.agg(F.max("length")).first()[0] <= 1024
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert ids <= set(docs)
    assert len({docs[d] for d in ids}) == len(ids)  # no exact copy is left


def test_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
