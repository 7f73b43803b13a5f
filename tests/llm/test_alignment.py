from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from urndraw.llm import alignment
from urndraw.llm.queries import QUERIES

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    """The two libraries as they are: lists of (id, bytes) of a whole text."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(BYTE)
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=PIECE)
    letters = {letter: byte for byte, letter in alignment.byte_letters().items()}

    def both(text):
        a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        return a, b

    return both


def brute(rows, sides):
    """Every document aligned token by token, with counts over all of them."""
    found, count = [], Counter()
    for doc_id, text in rows:
        a, b = sides(text) if text else ([], [])
        spelt = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in a) != spelt or b"".join(t for _, t in b) != spelt:
            found.append((doc_id, 0, 0, [], "", 0))
            continue
        places = []
        for side in (a, b):
            at, listed = 0, []
            for i, data in side:
                listed.append((i, at, at + len(data)))
                at += len(data)
            places.append(listed)
        links = [(x[0], y[0]) for x in places[0] for y in places[1] if x[1] < y[2] and y[1] < x[2]] if len(a) < 400 else list(swept(*places))
        count.update(links)
        ends = sorted({x[2] for x in places[0]} & {y[2] for y in places[1]})
        groups, low = [], 0
        p = q = 0
        for end in ends:
            left, right = [], []
            while p < len(a) and places[0][p][2] <= end:
                left.append(str(places[0][p][0]))
                p += 1
            while q < len(b) and places[1][q][2] <= end:
                right.append(str(places[1][q][0]))
                q += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        found.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest(), len(groups)))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted(((d, a, b, g, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), sha)
                   for d, a, b, links, sha, g in found), key=str)


def swept(first, second):
    q = 0
    for i, low, high in first:
        while second[q][2] <= low:
            q += 1
        r = q
        while r < len(second) and second[r][1] < high:
            yield i, second[r][0]
            r += 1


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*alignment.RESULT).collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=20), st.data())
def test_coalescing_equals_comparing_all(sizes, data):
    a = np.cumsum(sizes)
    inner = data.draw(st.sets(st.integers(1, int(a[-1]))))
    b = np.array(sorted(inner | {int(a[-1])}))
    a_group, b_group, a_link, b_link = alignment.coalesce(a, b)
    a_start, b_start = np.r_[0, a[:-1]], np.r_[0, b[:-1]]
    assert list(zip(a_link, b_link)) == [(i, j) for i in range(len(a)) for j in range(len(b)) if a_start[i] < b[j] and b_start[j] < a[i]]
    both = sorted(set(a) & set(b))
    assert a_group.tolist() == np.searchsorted(both, a).tolist() and b_group.tolist() == np.searchsorted(both, b).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab'sé \n\t ▁<>|0.́中😀\x00　\r"), max_size=24))
def test_units_give_what_the_whole_text_gives(text):
    pairing = alignment.pairing_of(BYTE, PIECE)
    whole = alignment.Block(pairing)
    block = alignment.Block(pairing)
    block.add([1], [text])
    pairing.cuts = False
    try:
        whole.add([1], [text])
    finally:
        pairing.cuts = True
    assert block.digests == whole.digests
    left, right = block.row(0), whole.row(0)
    for name in ("n_a", "n_b", "n_groups", "n_links", "pairs", "times"):
        assert left.column(name).to_pylist() == right.column(name).to_pylist()


def test_awkward_texts_equal_brute_force(spark, sides):
    texts = ["", None, " ", "\n", "a", " lead", "tail ", "two  spaces", "tab\t x", "<|endoftext|> </s> <s>x", "a▁b", "café é", "中文 字",
             "line\nbreak\n\n twice", "x" * 3000, "the the the " * 300, "don't we'll 3.14", "😀 smile", "a b", "é", "a\x00b"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, "a"), (None, "no id")]
    docs = spark.createDataFrame([(i, t, 1, "p") for i, t in rows], "doc_id long, text string, block long, pairs string").repartition(3)
    assert rows_of(alignment.align(docs, BYTE, PIECE, chars=2000)) == brute(rows, sides)


def test_whole_small_table_equals_brute_force(spark, sides):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], sides)
    assert rows_of(QUERIES["op13_alignment"](spark, "/root/testdata/sf0.001")) == expected


def test_texts_without_tokens(spark):
    docs = spark.createDataFrame([(1, None), (2, "▁")], "doc_id long, text string")
    assert rows_of(alignment.align(docs, BYTE, PIECE)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), BYTE, PIECE).collect() == []
