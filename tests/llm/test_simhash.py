from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from urndraw.llm import simhash


def slow_fingerprint(text):
    words, word = [], ""
    for ch in text or "":
        if ch in " \t\n\x0b\x0c\r":
            words += [word] * bool(word)
            word = ""
        else:
            word += ch.lower() if ch.isascii() else ch
    words += [word] * bool(word)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    prints = [slow_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    first = {g: min((d for (d, _), h in zip(rows, group) if h == g and d is not None), default=None) for g in group}
    return sorted(((d, f"{p:016x}", first[g]) for (d, _), p, g in zip(rows, prints, group)), key=str)


@pytest.mark.parametrize("text", ["", " \n\t", "One", "One two", "A\x1cb C", "Ä b Ä c", "x y z x y z", "w " * 70000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_trie_join_equals_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = base[:, None] ^ (np.uint64(1) << rng.integers(0, 64, (40, 12), dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, (40, 12), dtype=np.uint64))
    values = np.unique(np.r_[base, near.ravel(), np.uint64(0), np.uint64(2**64 - 1)])
    got = {(int(a), int(b)) for x, y in simhash.trie_pairs(values, 3, 64) for a, b in zip(x, y)}
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    assert got == set(zip(*np.nonzero(np.triu(apart <= 3, 1))))


def documents():
    random.seed(4)
    words = [f"w{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, "  \n"), (3, "one two"), (3, "one two"), (None, "one two"), (4, "ONE two")]
    for d in range(10, 60, 5):
        text = random.choices(words, k=400)
        for k in range(5):
            copy = list(text)
            copy[random.randrange(400)] = "changed"
            rows.append((d + k, " ".join(copy if k else text)))
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit(1)).withColumn("path", F.lit("x"))
    got = simhash.near_duplicates(docs).withColumn("h", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))
    assert sorted(((r.doc_id, r.h, r.component_id) for r in got.collect()), key=str) == slow_components(rows)


def test_divided_tries_find_the_same_links(spark):
    rng = np.random.default_rng(5)
    centre = np.uint64(0x0F0F_F0F0_1234_5678)
    values = np.unique(centre ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)))
    prints = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint long")
    got = simhash.links(prints, leaves=64, rows_per_group=1000).collect()
    at = {int(v): i for i, v in enumerate(values.view(np.int64))}
    for r in got:
        assert bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 3 * len(values)  # a chain of links
    found = simhash.forest(len(values), iter([(np.array([at[r.a] for r in got]), np.array([at[r.b] for r in got]))]))
    assert (found == simhash.forest(len(values), simhash.trie_pairs(values, 3, 64))).all()


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
