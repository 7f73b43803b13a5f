from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from urndraw.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
CODEC = bpe.TextCodec(PATH, limit=200)


def equal(text):
    ids, decoded = CODEC.encode(text)
    want = PLAIN.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert decoded == PLAIN.decode(want, skip_special_tokens=False) == CODEC.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    equal(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("thanerouingS's. \n12!?éßçİΣ"), max_size=80))
def test_word_like_text(text):
    equal(text)


@pytest.mark.parametrize("text", [
    "", " ", "<|endoftext|>", "a<|startoftext|><|endoftext|> b", "<|endoftext|", "a" * 5000, "ΣΑΣ İstanbul ﬁ ①²½",
    "\x1c\x85\xa0　x", "日本語 हिन्दी 😀", "é ́x", "it's we'LL 'S",
])
def test_cases(text):
    equal(text)


def test_other_merge_order():
    # "ab" and "bc" compete; the rank decides, also inside longer words and for runs of one letter
    merges = [("b", "c"), ("a", "b"), ("a", "a"), ("aa", "aa"), ("ab", "c"), ("c", "a")]
    vocab = {t: i for i, t in enumerate(["a", "b", "c", "bc", "ab", "aa", "aaaa", "abc", "ca"])}
    codec = bpe.PrefixBpe(vocab, merges, None)

    def slow(word):
        parts = list(word)
        for left, right in merges:
            at = 0
            while at < len(parts) - 1:
                if (parts[at], parts[at + 1]) == (left, right):
                    parts[at:at + 2] = [left + right]
                at += 1
        return [vocab[p] for p in parts]

    random.seed(1)
    for _ in range(2000):
        word = "".join(random.choices("abc", k=random.randint(1, 12)))
        assert codec.encode(word) == slow(word)


def test_round_trip_rows(spark):
    docs = [(1, None), (2, ""), (3, "The  Tree"), (3, "The  Tree"), (None, "x")]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("ids", F.lit(1))
    got = bpe.round_trip(table, PATH).collect()
    for r, (d, t) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)), docs):
        ids = PLAIN.encode(t or "", add_special_tokens=False).ids
        assert (r.doc_id, bytes(r.ids), r.decoded) == (d, np.array(ids, "<u4").tobytes(), PLAIN.decode(ids, skip_special_tokens=False))
    assert bpe.round_trip(table.limit(0), PATH).count() == 0


def test_digests(spark):
    from urndraw.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op3_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for d in docs:
        ids = PLAIN.encode(d.text, add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(PLAIN.decode(ids, skip_special_tokens=False).encode()).hexdigest()
