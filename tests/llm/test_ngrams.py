from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from urndraw.llm import ngrams
from urndraw.llm.queries import QUERIES

U = np.uint64


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 1 << 40), st.integers(0, (1 << 63) - 1)), max_size=200),
       st.lists(st.integers(0, (1 << 63) - 1), max_size=30))
def test_elias_fano_equals_a_sorted_array(values, others):
    values = np.array(sorted(values), U)
    coded = ngrams.EliasFano.of(values)
    assert coded.at(np.arange(len(values))).tolist() == values.tolist()
    asked = np.array([*values.tolist(), *[v + 1 for v in values.tolist()], *others], U)
    place, same = coded.successor(asked)
    assert place.tolist() == np.searchsorted(values, asked).tolist()
    assert same.tolist() == np.isin(asked, values).tolist()


@settings(max_examples=200, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 12), st.integers(0, 30))))
def test_a_level_finds_what_it_holds_also_as_a_mapped_file(grams):
    listed = sorted(grams)
    context, word = (np.array([g[i] for g in listed], U) for i in (0, 1))
    level = ngrams.Level.of(context, word, np.arange(len(listed)))
    every = [(c, w) for c in range(14) for w in range(32)]
    places = {g: i for i, g in enumerate(listed)}
    for one in (level, ngrams.Level.view(level.buffer())):
        found = one.find(np.array([c for c, _ in every], U), np.array([w for _, w in every], U))
        assert found.tolist() == [places.get(g, -1) for g in every]
        assert one.steps.tolist() == list(range(len(listed)))


def test_a_level_mapped_from_a_file(tmp_path):
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 40, 20_000, dtype=np.uint64))
    context, word = keys >> U(28), keys & U((1 << 28) - 1)
    level = ngrams.Level.of(context, word, np.ones(len(keys)))
    (tmp_path / "level").write_bytes(level.buffer())
    mapped = ngrams.Level.view(np.memmap(tmp_path / "level", np.uint8, "r"))
    assert mapped.find(context, word).tolist() == list(range(len(keys)))
    assert (mapped.find(context, word + U(1 << 29)) == -1).all()
    assert len(level.buffer()) < 0.6 * 16 * len(keys)


def tokens_of(text) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "\n"]


def brute(rows, train, order, prior):
    learned = [tokens_of(t) for (i, t) in rows if train(i)]
    count = Counter(w for words in learned for w in words)
    total, kinds = sum(count.values()), len(count)
    grams = Counter()
    for words in learned:
        marked = [" ", *words]
        for n in range(1, order + 1):
            grams.update(tuple(marked[i:i + n]) for i in range(len(marked) - n + 1))
    out = []
    for i, text in rows:
        words = tokens_of(text)
        marked = [" ", *words]
        base = score = 0.0
        for at in range(1, len(marked)):
            p = (count[marked[at]] + 1) / (total + kinds + 1)
            base += math.log10(p)
            for n in range(2, order + 1):
                if at - n + 1 < 0:
                    break
                context = tuple(marked[at - n + 1:at])
                if grams[context]:
                    c = grams[(*context, marked[at])]
                    own = ngrams.probability_of(ngrams.step_of(np.array([c / (grams[context] + prior)])))[0] if c else 0.0
                    p = own + prior / (grams[context] + prior) * p
            score += math.log10(p)
        out.append((i, train(i), len(words), sum(count[w] > 0 for w in words), total, base, score))
    return out


def same(found, expected):
    key = lambda r: (str(r[0]), r[2], r[6])
    found, expected = sorted(map(tuple, found), key=key), sorted(expected, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for a, b in zip(found, expected):
        assert a[5:] == pytest.approx(b[5:], rel=1e-10)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_awkward_texts_equal_brute_force(spark, order):
    rows = [(1, "a b a b c"), (2, "A\tB\x0bc d"), (3, None), (4, ""), (5, "b a b a b"), (5, "b a b a b"), (None, "x a b"), (6, "w" * 70_000 + " a b"),
            (7, "a " * 3000), (8, "Ä ä \x1c\x85 a"), (9, "never seen words here"), (10, "a b never")]
    train = lambda i: i is not None and i < 9
    docs = spark.createDataFrame([(i, t, 0, "s") for i, t in rows], "doc_id long, text string, block long, words string").repartition(4)
    found = ngrams.score(docs, F.col("doc_id") < 9, order=order, slice_tokens=700, chars=3000)
    same(found.collect(), brute(rows, train, order, ngrams.PRIOR))


def test_whole_small_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    train = lambda i: crc32(str(i).encode()) % 7 != 2
    found = QUERIES["op12_ngrams"](spark, "/root/testdata/sf0.001").collect()
    expected = brute(rows, train, ngrams.ORDER, ngrams.PRIOR)
    same([(r[0], not r[1], *r[2:]) for r in found], expected)
    # on documents that were not learned from, the model does better than the base
    held = [r for r in expected if not r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_no_training_rows_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: tuple(r)[1:] for r in ngrams.score(docs, F.lit(False)).collect()}
    assert found == {1: (False, 3, 0, 0, 0.0, 0.0), 2: (False, 1, 0, 0, 0.0, 0.0)}
    assert ngrams.score(docs.limit(0)).collect() == []
