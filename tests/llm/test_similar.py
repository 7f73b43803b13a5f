from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from urndraw.llm import similar

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def slow_set(text):
    words = (text or "").lower().split()
    size = min(5, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def slow_kept(docs):
    """Ids that stay: the lowest of each component of pairs with Jaccard of 0.8 or more."""
    docs = sorted(docs)
    sets, first = [slow_set(t) for _, t in docs], list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((first[i], first[j]))
                first = [a if f == b else f for f in first]
    return [d for i, (d, _) in enumerate(docs) if first[i] == i]


def changed(rng, text, edits):
    words = text.split(" ")
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rng = random.Random(4)
    docs = [(0, None), (1, ""), (2, "one two"), (3, "One  two"), (4, "one two three")]
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(40, 300))) for _ in range(30)]
    docs += [(10 + i, t) for i, t in enumerate(base)]
    for d in range(50, 200):
        text = rng.choice(base)
        docs.append((d, changed(rng, text, rng.randint(0, 1 + len(text.split()) // 30))))
    return docs + [(d, changed(rng, base[0], 1)) for d in range(200, 300)]


def test_stage_equals_all_pairs(spark):
    docs = corpus()
    table = spark.createDataFrame([(d, t, "en", "src", len(t or "")) for d, t in docs] + [(10, docs[5][1], "en", "src", 1)], COLUMNS)
    got = dict(corpus_pipeline.STAGES)["near_copies"](spark, table, "").collect()
    assert sorted(r.doc_id for r in got) == slow_kept(docs)
    assert {r.doc_id: r.text for r in got}.items() <= dict(docs).items()


def test_copies_with_a_few_changed_words_go_from_the_pipeline(spark):
    rng = random.Random(5)
    docs, stages = [], dict(corpus_pipeline.STAGES)
    for d in range(0, 40, 2):
        text = " ".join(f"w{rng.randrange(3000)}" for _ in range(120))
        docs += [(d, text, "en", "src", 1), (d + 1, changed(rng, text, 2), "en", "src", 1)]
    table = spark.createDataFrame(docs, COLUMNS)
    for name in [n for n, _ in corpus_pipeline.STAGES if n == "near_copies"]:
        table = stages[name](spark, table, "")
    assert sorted(r.doc_id for r in table.collect()) == list(range(0, 40, 2))


def test_groups_without_a_common_centre(spark):
    # one node is near two that are not near each other
    words = [f"w{i}" for i in range(104)]
    texts = [" ".join(words), " ".join(words[:90]), " ".join(words[14:])]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in similar.one_of_each(table).collect()] == slow_kept(list(enumerate(texts)))


@pytest.mark.parametrize("leaves", [4, 40])
def test_large_roots_are_joined_in_parts(spark, monkeypatch, leaves):
    monkeypatch.setattr(similar, "LEAVES", leaves)
    docs = corpus()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in similar.one_of_each(table).collect()) == slow_kept(docs)


@pytest.mark.parametrize("leaves, nearest, weight", [(4, 8, 1 << 21), (2048, 1, 600)])
def test_no_link_between_different_texts_is_lost(spark, monkeypatch, leaves, nearest, weight):
    # chains: neighbours are similar, all others only share roots, so no text is a centre and the closest partners may all fail
    monkeypatch.setattr(similar, "LEAVES", leaves)
    monkeypatch.setattr(similar, "NEAREST", nearest)
    monkeypatch.setattr(similar, "SHINGLES", weight)
    rng = random.Random(8)
    docs = []
    for chain in range(6):
        words = [f"c{chain}w{rng.randrange(10**6)}" for _ in range(420)]
        docs += [" ".join(words[at:at + 100]) for at in range(0, 320, rng.choice([7, 9, 10]))]
        docs += [changed(rng, " ".join(words[:100]), rng.randint(4, 7)) for _ in range(12)]
    rng.shuffle(docs)
    docs = list(enumerate(docs))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(r.doc_id for r in similar.one_of_each(table).collect()) == slow_kept(docs)


def test_sets_are_compared_whole():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 40, 60)
    sets = [np.unique(rng.choice(base, rng.integers(1, 60) if i % 2 else 200)) for i in range(40)]
    a, b = np.triu_indices(40, 1)
    want = [5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j])) for i, j in zip(a, b)]
    got = similar.similar_pairs(similar.pa.array([[0], *sets, [0]], similar.pa.list_(similar.pa.int64()))[1:-1], a, b)
    assert any(want) and got.tolist() == want


def test_close_pairs_and_spanning_forest():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    prints = base[rng.integers(0, 6, 120)]
    for i in range(60):
        for bit in rng.integers(0, 64, rng.integers(0, 12)):
            prints[i] ^= np.uint64(1) << np.uint64(bit)
    trie = rng.integers(0, 2, 120)
    a, b, bits = similar.close_pairs(trie, prints)
    low = (1 << similar.WALKED) - 1
    want = {(i, j): int(prints[i] ^ prints[j]).bit_count() for i in range(120) for j in range(i + 1, 120) if trie[i] == trie[j]}
    want = {p: n for p, n in want.items() if n <= similar.BUDGET and int((prints[p[0]] ^ prints[p[1]])).__and__(low).bit_count() <= similar.WALK_BUDGET}
    assert dict(zip(zip(a.tolist(), b.tolist()), bits.tolist())) == want and len(a) == len(want)
    links, component = similar.spanning(120, a, b, bits)
    first = list(range(120))
    for (i, j), _ in sorted(want.items(), key=lambda x: (x[1], x[0])):
        x, y = sorted((first[i], first[j]))
        first = [x if f == y else f for f in first]
    assert component.tolist() == first and len(links) == 120 - len(set(first))


def jobs_of(spark, table):
    spark.sparkContext.setJobGroup("similar", "similar")
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("similar"))
    similar.links(table, similar.stored(similar.signatures(table), "similar")).collect()
    after = set(spark.sparkContext.statusTracker().getJobIdsForGroup("similar"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(after - before)


def test_the_number_of_steps_does_not_depend_on_the_rows(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").repartition(8)
    few, many = similar.stored(documents.where("doc_id < 1000"), "similar"), similar.stored(documents, "similar")
    # adaptive execution runs each exchange as a job; loops would add tens of them
    assert abs(jobs_of(spark, few) - jobs_of(spark, many)) <= 6


def test_columns_of_the_input_are_kept_whatever_their_names(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "a", 7, "r", 1), (2, text + " more", "b", 8, "s", 2), (None, None, None, None, None, None), (3, "x " * 30_000, "c", 9, "t", 3)]
    table = spark.createDataFrame(rows, "doc_id long, text string, __id string, __version long, row string, `node` long")
    got = similar.one_of_each(table)
    assert got.columns == table.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted((r for r in rows if r[0] != 2), key=str)


def test_empty_table(spark):
    assert similar.one_of_each(spark.createDataFrame([], "doc_id long, text string")).count() == 0
