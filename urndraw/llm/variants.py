"""Spelling variants: words one edit apart, found with bit-sliced position indexes, and the form each rarer word follows.

A bit-sliced index holds, for every position and letter, the set of words with that letter there as the bits of one integer.
A query goes through its letters once and keeps four such sets: words without an error so far, and words with one error
behind them, which are a replaced letter (same positions), a letter only the word has (positions shifted up) or a letter only
the query has (shifted down). Every step is a few operations on whole integers, so all words of an index advance together.

Spark deals the words out so that any two words one edit apart share an index: the error is in one half of the longer word,
so the other half is equal. A word of m letters enters under its first and last half as a longer word (m letters) and as a
shorter one (of m + 1 letters), four rows in all. An index is as large as the number of words with one half in common, which
is bounded by the letters of the other half, and returns one row for a word, never pairs.

Defined cases: null text has no words; repeated rows count each; null ids count as the text ``null``; ties between forms go to
the word that is smaller by code points; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urndraw.llm.common import stored, text_or_empty

#: Different words a task counts before it hands them on.
WORDS = 400_000
#: Rows of halves that one task call takes, on average.
HALVES = 100_000
#: One letter each: A-Z as a-z, a-z, U+00C0 to U+00FF; any other byte of the one-byte form separates words.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str, least: int = 1) -> list[bytes]:
    """The runs of letters with at least ``least`` of them, one byte for a letter (all letters are below U+0100)."""
    return [w for w in text.encode("latin-1", "replace").translate(LETTERS).split() if len(w) >= least]


def damaged(run: bytes, seed: int, every: int) -> bytes:
    """The run without one letter if ``every`` divides its hash, which starts from ``seed``; else the run."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if every and h % every == 0:
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return run


def word_counts(docs: DataFrame, least_letters: int = 6, least_times: int = 5, every: int = 199, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """(word, n): words of ``least_letters`` or more that occur ``least_times`` or more over all rows.

    ``every`` names the planted damage: a run loses a letter where that number divides its hash with the id; 0 for none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter[bytes] = Counter()

        def handed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in counted], pa.string()), pa.array(list(counted.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = runs(text, least_letters)
                counted.update(words)
                if every:
                    seed = crc32(name.encode() + b":")
                    for word in set(words):
                        other = damaged(word, seed, every)
                        if other != word:
                            times = words.count(word)
                            counted[word] -= times
                            if len(other) >= least_letters:
                                counted[other] += times
                if len(counted) > WORDS:
                    yield handed_on()
                    counted.clear()
        yield handed_on()

    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("null")).alias("name"), text_or_empty(text_column).alias("text"))
    found = rows.mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= max(1, least_times))


class BitIndex:
    """The words of one index, as what is left of them without the half they share; the longest have ``longest`` letters.

    Words are numbered in the order given, so the lowest bit of a set is the first of them.
    """

    def __init__(self, rests: list[str], longest: int) -> None:
        sliced: dict[tuple[int, str], int] = {}
        self.long = self.short = 0
        for i, rest in enumerate(rests):
            bit = 1 << i
            for place in enumerate(rest):
                sliced[place] = sliced.get(place, 0) | bit
            if len(rest) == longest:
                self.long |= bit
            else:
                self.short |= bit
        self.sliced, self.longest = sliced, longest

    def near(self, query: str) -> int:
        """The words that differ from ``query`` by exactly one edit; of two shorter words none, they meet elsewhere."""
        get = self.sliced.get
        none = self.long | self.short  # words without an error so far
        if len(query) == self.longest:
            replaced = fewer = 0
            for i, letter in enumerate(query):
                here = get((i, letter), 0)
                fewer = (fewer & get((i - 1, letter), 0)) | none
                replaced = (replaced & here) | (none & ~here)
                none &= here
            return (replaced & self.long) | (fewer & self.short)
        more = 0
        for i, letter in enumerate(query):
            more = (more | none) & get((i + 1, letter), 0)
            none &= get((i, letter), 0)
        return (more | none) & self.long


def near_in_index(longest: int, front: bool, half: str, words: list[str]) -> Iterator[tuple[int, int, int]]:
    """(word, number of words near it, the first of them) by position in ``words``, which share ``half`` at the front or back
    and have ``longest`` letters or one fewer. A pair that shares both halves belongs to the front."""
    cut = len(half)
    rests = [w[cut:] if front else w[:len(w) - cut] for w in words]
    index = BitIndex(rests, longest - cut)
    at = {} if front else {rest: i for i, rest in enumerate(rests)}
    for i, rest in enumerate(rests):
        near = index.near(rest)
        if near and not front:
            # the front halves are equal too: the shorter rest and the next letter are the longer rest
            twin = at.get(rest + half[0]) if len(rest) < index.longest else at.get(rest[:-1]) if rest.endswith(half[0]) else None
            if twin is not None:
                near &= ~(1 << twin)
        if near:
            yield i, near.bit_count(), (near & -near).bit_length() - 1


def near_words(words: DataFrame, halves: int = HALVES) -> DataFrame:
    """(word, n_near, best_n, best): for words (word, n) with words one edit away, their number and the most frequent one.

    Words are distinct and have two letters or more. ``words`` should be stored.
    """
    size = F.char_length("word")

    def entry(longest, front: bool):
        first = F.floor(longest / 2).cast("int")
        half = F.left("word", first) if front else F.right("word", longest - first)
        return F.struct(longest.alias("longest"), F.lit(front).alias("front"), half.alias("half"))

    entries = F.array(*[entry(size + more, front) for more in (0, 1) for front in (True, False)])
    rows = words.select("word", "n", F.explode(entries).alias("e")).select("word", "n", "e.*")
    slots = max(1, 4 * words.count() // halves)
    slot = F.pmod(F.xxhash64("longest", "front", "half"), F.lit(slots)).alias("slot")

    def run(table: pa.Table) -> pa.Table:
        listed = sorted(
            zip(*(table.column(c).to_pylist() for c in ("longest", "front", "half", "n", "word"))),
            key=lambda r: (r[0], r[1], r[2], -r[3], r[4]))
        out = []
        for (longest, front, half), group in groupby(listed, key=lambda r: r[:3]):
            members = list(group)
            if len(members) > 1:
                for i, many, first in near_in_index(longest, front, half, [m[4] for m in members]):
                    out.append((members[i][4], many, members[first][3], members[first][4]))
        columns = list(zip(*out)) or [[], [], [], []]
        return pa.table([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                         pa.array(columns[3], pa.string())], ["word", "n_near", "best_n", "best"])

    found = rows.select("word", "n", "longest", "front", "half", slot).groupBy("slot").applyInArrow(
        run, "word string, n_near long, best_n long, best string")
    # the lowest of (-n, word) is the most frequent one, ties by code points
    first = F.min(F.struct((-F.col("best_n")).alias("least"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select(
        "word", "n_near", (-F.col("first.least")).alias("best_n"), F.col("first.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where following forms ends. Every round doubles the steps; as a form is several times
    as frequent as its word, no chain is longer than the logarithm of the counts."""
    at = stored(forms.select("word", F.col("form").alias("root")), "variants")
    while True:
        ahead = at.select(F.col("word").alias("of"), F.col("root").alias("next"))
        step = at.join(ahead, at["root"] == ahead["of"], "left")
        at = stored(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variants")
        if at.where("moved").limit(1).count() == 0:
            return at.select("word", "root")


def group_variants(words: DataFrame, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for (word, n): the form of a word is its near word of largest n, if that is at
    least ``times`` its own; root is where the forms end. ``times`` is 2 or more, so forms never go in circles."""
    if times < 2:
        raise ValueError("a form has to be more frequent than its word")
    near = near_words(words)
    found = words.join(near, "word", "left")
    has = F.col("best_n") >= times * F.col("n")
    found = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "variants")
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, least_letters: int = 6, least_times: int = 5, times: int = 5, every: int = 199,
             id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The variants among all words of ``docs``."""
    return group_variants(stored(word_counts(docs, least_letters, least_times, every, id_column, text_column), "variants"), times)
