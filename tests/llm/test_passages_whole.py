from __future__ import annotations

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from urndraw.llm import passages
from urndraw.llm.queries import QUERIES

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


def query(spark, tmp_path, docs):
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(os.path.join(str(tmp_path), "documents.parquet"))
    return {r.doc_id: r for r in QUERIES["op9_passages"](spark, str(tmp_path)).collect()}


def spliced(spark, size, n, seed):
    """Pairs of documents that share ``size`` words of real prose, each with its own words around them, and real lines kept."""
    rng = random.Random(seed)
    texts = [r.text for r in spark.read.parquet(DOCUMENTS).where(F.length("text").between(2000, 20000)).orderBy("doc_id").limit(400).collect()]
    out = []
    for _ in range(n):
        text = rng.choice(texts)
        words = list(re.finditer(r"[^\W_]+", text))
        if len(words) < size + 2:
            continue
        at = rng.randrange(len(words) - size)
        part = text[words[at].start():words[at + size - 1].end()]
        out.append((part, *[" ".join(f"own{rng.randrange(10**9)}" for _ in range(rng.randint(1, 30))) for _ in range(4)]))
    return out


@pytest.mark.parametrize("size", [52, 80, 150])
def test_every_real_passage_keeps_twenty_words_in_common(spark, size):
    for part, a, b, c, d in spliced(spark, size, 1000, size):
        seen = {u[0] for u in passages.all_units(f"{a} {part} {b}")}
        marked = [{"at": i, "start": s, "end": e, "words": n} for i, (u, s, e, n) in enumerate(passages.all_units(f"{c} {part} {d}")) if u in seen]
        assert list(passages.stretches(marked, passages.PASSAGE)), part


def test_query_finds_passages_of_fifty_two_words(spark, tmp_path):
    pairs = spliced(spark, 52, 150, 1)
    docs = [x for k, (part, a, b, c, d) in enumerate(pairs) for x in ((2 * k, f"{a} {part} {b}"), (2 * k + 1, f"{c} {part} {d}"))]
    got = query(spark, tmp_path, docs)
    assert all(got[2 * k + 1].n_removed for k in range(len(pairs)))


def test_no_unit_of_a_line_is_longer_than_the_window(spark):
    rng = random.Random(8)
    for _ in range(50):
        text = " ".join(rng.choices("for que los the of and sea".split(), k=rng.randint(1, 400)))
        found = passages.all_units(text)
        assert sum(u[3] for u in found) == len(text.split()) and max(u[3] for u in found) <= 2 * passages.AMONG


def test_values_between_repeated_labels_stay(spark, tmp_path):
    labels = ["please enter the family name as it stands in your passport", "please state the whole amount that you would like to receive",
              "please tell us the place of birth as the register has it", "please sign with the name that the office knows you by"]
    docs = [(d, "\n".join(x for i, label in enumerate(labels) for x in (label, f"value{d} {i}"))) for d in range(6)]
    docs += [(-2, "value4 0\nvalue5 2"), (-1, "value5 1\nvalue4 3")]
    got = query(spark, tmp_path, docs)
    for d in range(6):
        assert [got[d].text.count(f"value{d} {i}") for i in range(4)] == [1] * 4
