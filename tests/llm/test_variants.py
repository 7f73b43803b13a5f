from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from urndraw.llm import variants
from urndraw.llm.queries import QUERIES


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(rows: list[tuple], least: int = 6, times: int = 5, every: int = 199) -> dict[str, int]:
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'null' if doc_id is None else doc_id}:{word}".encode())
            if every and h % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= least:
                found[word] += 1
    return {w: n for w, n in found.items() if n >= times}


def brute(words: dict[str, int], times: int = 5) -> dict[str, tuple]:
    forms, near = {}, {}
    for w, n in words.items():
        close = [v for v in words if one_edit(w, v)]
        near[w] = len(close)
        best = min(close, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= times * n else None

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return {w: (forms[w], root(w), n, near[w], words[forms[w]] if forms[w] else None) for w, n in words.items()}


def rows_of(df) -> dict[str, tuple]:
    listed = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r["word"] for r in listed}) == len(listed)
    return {r["word"]: tuple(r)[1:] for r in listed}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", min_size=2, max_size=7), min_size=1, max_size=14, unique=True))
def test_each_pair_one_edit_apart_is_found_once(words):
    found = Counter()
    for longest in range(2, 10):
        first = longest // 2
        for front in (True, False):
            groups = {}
            for w in words:
                if len(w) in (longest, longest - 1):
                    half = w[:first] if front else w[len(w) - (longest - first):]
                    groups.setdefault(half, []).append(w)
            for half, members in groups.items():
                for i, many, best in variants.near_in_index(longest, front, half, members):
                    assert one_edit(members[i], members[best])
                    found[members[i]] += many
    assert dict(found) == {w: n for w in words if (n := sum(one_edit(w, v) for v in words))}


def test_words_are_runs_of_the_letters_named():
    assert variants.runs("AbÉÿ cĀd € x×y 1z😀".encode("utf-16", "surrogatepass").decode("utf-16")) == [
        b"ab\xc9\xff", b"c", b"d", b"x\xd7y", b"z"]


def test_whole_small_table_equals_brute_force(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = counted([tuple(r) for r in documents.select("doc_id", "text").collect()])
    found = rows_of(QUERIES["op11_variants"](spark, "/root/testdata/sf0.001"))
    assert found == brute(words)


def test_chains_ties_and_planted_damage(spark):
    texts = [(i, "Common common " * 40 + "commen " * 6 + "commén commin commix " * 1) for i in range(40)]
    texts += [(None, "commen"), (7, None), (8, ""), (9, "x" * 50_000 + " " + "y" * 50_000), (9, "Āā 12345")]
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in texts], "doc_id long, text string, word string, n string")
    words = counted(texts, times=1, every=7)
    assert rows_of(variants.variants(docs, least_times=1, times=3, every=7)) == brute(words, 3)
    plain = spark.createDataFrame([("abcdef", 1), ("abcdeg", 10), ("abcdeh", 10), ("abcdegg", 200)], "word string, n long")
    assert rows_of(variants.group_variants(plain)) == {
        "abcdef": ("abcdeg", "abcdegg", 1, 2, 10), "abcdeg": ("abcdegg", "abcdegg", 10, 3, 200), "abcdeh": (None, "abcdeh", 10, 2, None),
        "abcdegg": (None, "abcdegg", 200, 1, None)}


def test_empty_table_and_forms_that_could_go_in_circles(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert variants.variants(docs).collect() == []
    with pytest.raises(ValueError):
        variants.group_variants(docs, 1)
