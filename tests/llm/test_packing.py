from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from urndraw.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
ENCODER = packing.ChunkTokens(PATH, limit=50)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab .,'s\n\t 1é<|endoftext|>\x1c\xa0　ß中"), max_size=30), max_size=5))
def test_chunked_ids_equal_the_library(texts):
    texts = [*texts, "a <|endoftext|> b<|endoftext|>c", " a  b", "it's it 's"]
    want = [np.array(e.ids, np.uint32).tobytes() for e in PLAIN.encode_batch(texts, add_special_tokens=False)]
    assert ENCODER.encode(texts) == want


def slow_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plan_equals_piecewise_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 64, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.choice([1, 20, 400]))] + [3] * rng.choice([0, 50])
    used, spans = Counter(), {}
    for length, rank, count, window, offset in packing.best_fit_plan(Counter(lengths), capacity):
        for k in range(count):
            spans.setdefault(window + k, []).append((offset, length))
            used[length, rank + k] += 1
    assert used == Counter((n, k) for n, c in Counter(lengths).items() for k in range(c))
    for pieces in spans.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
    assert sorted(capacity - sum(n for _, n in p) for p in spans.values()) == slow_best_fit(lengths, capacity)


def check(rows, docs, capacity):
    ids = {d: np.r_[np.array(PLAIN.encode(t or "", add_special_tokens=False).ids, np.uint32), np.uint32(0)] for d, t in docs}
    covered, windows = {}, {}
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length].astype(np.uint32)
        assert r.length == len(part) >= 1 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
        covered.setdefault(r.doc_id, []).append((r.start, r.length))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, x in ids.items():
        at = 0
        for start, length in sorted(covered[d]):
            assert start == at
            at += length
        assert at == len(x)
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(windows) == set(range(len(windows)))


def test_packing(spark):
    rng = random.Random(1)
    docs = [(0, None), (1, ""), (2, "a" * 30000), (3, " x  y ")]
    docs += [(d, " ".join(rng.choices(["tree", "line", "of", "Blue", "x.\ny"], k=rng.randint(1, 200)))) for d in range(4, 300)]
    docs += [(d, "the same text again") for d in range(300, 500)]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("slot", F.lit("x")).withColumn("n", F.lit(1))
    cut = packing.pieces(table, PATH, capacity=64).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    check(packing.assign(cut, capacity=64, slot_rows=50).collect(), docs, 64)


def test_repeated_rows_and_empty_table(spark):
    docs = [(1, "one two")] * 3 + [(None, "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    rows = packing.assign(packing.pieces(table, PATH)).collect()
    assert sorted(r.offset for r in rows) == [0, 3, 6, 9] or len({(r.sequence_id, r.offset) for r in rows}) == 4
    assert packing.assign(packing.pieces(table.limit(0), PATH)).count() == 0
