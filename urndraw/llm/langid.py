"""Language identification by words first, then shorter and shorter character n-grams.

A known word scores each language by the log of its frequency there. An unseen word is scored by its character n-grams
of the greatest length of which any is known (word edges count as characters), by the mean of their log frequencies.
A text's score is the share its language takes among all, from the sum over its words, damped by the root
of their number so that long texts stay comparable.

The model is fitted on about ``sample_rows`` labelled rows, chosen by a hash of id and text, and keeps the ``entries`` most
frequent words and n-grams: both bounds are parameters, and nothing else about the work depends on size. Prediction reads
every text whole.

Defined cases: null text and text without a letter give ``und`` and score 0, and so does everything if no row has
a label; rows with a null id or null label are not learned from; ties between languages go to the first by name; repeated
rows are predicted each on its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urndraw.llm.common import hashed_share, text_or_empty

ORDERS = (4, 3, 2, 1)
#: Labelled documents that are learned from, the same number for each language.
SAMPLE_ROWS = 4000
UNKNOWN = "und"
#: Unseen words whose scores a task keeps.
UNSEEN = 100_000

_words = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[str]:
    return _words(text.lower())


def grams(word: str, order: int) -> list[str]:
    edged = f"<{word}>"
    return [edged[i:i + order] for i in range(len(edged) - order + 1)]


@dataclass
class Model:
    languages: list[str]
    #: (order, text) with order 0 for words, and the log frequencies by language.
    entries: dict[tuple[int, str], int]
    logs: np.ndarray
    unseen: dict[str, np.ndarray] = field(default_factory=dict, repr=False)

    @staticmethod
    def of(rows: list[tuple[int, str, str, int]], totals: dict[tuple[int, str], int]) -> Model:
        """From (order, text, language, count) and the sums over (order, language) of everything counted."""
        languages = sorted({language for _, language in totals})
        entries: dict[tuple[int, str], int] = {}
        for order, text, _, _ in rows:
            entries.setdefault((order, text), len(entries))
        counts = np.zeros((len(entries), len(languages)))
        column = {language: i for i, language in enumerate(languages)}
        for order, text, language, n in rows:
            counts[entries[order, text], column[language]] += n
        sums = np.array([[totals.get((order, language), 0) for language in languages] for order, _ in entries]).reshape(counts.shape)
        logs = np.log((counts + 0.5) / (sums + 1.0))
        return Model(languages, entries, logs - logs.mean(axis=1, keepdims=True) if len(languages) else logs)

    def word(self, word: str) -> np.ndarray:
        at = self.entries.get((0, word))
        if at is not None:
            return self.logs[at]
        for order in ORDERS:
            known = [self.entries[order, g] for g in grams(word, order) if (order, g) in self.entries]
            if known:
                return self.logs[known].mean(axis=0)
        return np.zeros(len(self.languages))

    def predict(self, text: str) -> tuple[str, float]:
        words = words_of(text)
        if not self.languages or not any(w.isalpha() or any(map(str.isalpha, w)) for w in words):
            return UNKNOWN, 0.0
        if len(self.unseen) > UNSEEN:
            self.unseen.clear()
        total = np.zeros(len(self.languages))
        known, at = self.unseen, []
        for word, n in Counter(words).items():
            entry = self.entries.get((0, word))
            if entry is not None:
                at += [entry] * n
                continue
            scores = known.get(word)
            if scores is None:
                scores = known[word] = self.word(word)
            total += n * scores
        total = (total + self.logs[at].sum(axis=0)) / np.sqrt(len(words))
        shares = np.exp(total - total.max())
        best = int(shares.argmax())
        return self.languages[best], float(shares[best] / shares.sum())


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "lang") -> Model:
    """Fit on the rows of ``docs`` with an id and a label, about ``sample_rows`` of them in equal shares for the labels, so that
    a rare language is learned as well as a frequent one; the caller leaves out what must not be seen. Every word and n-gram of these
    rows is kept."""
    rows = docs.select(F.col(id_column).cast("string").alias("id"), F.col(label_column).cast("string").alias("lang"),
                       text_or_empty(text_column).alias("text")).where("id is not null and lang is not null")
    # one row for each language
    totals = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()
    if sum(r["n"] for r in totals) > sample_rows:
        wanted = max(1, sample_rows // len(totals))
        rows = rows.where(reduce(lambda found, r: found | ((F.col("lang") == r["lang"]) & hashed_share(r["n"], wanted, "id", "text")), totals, F.lit(False)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, int], Counter] = {}
            for language, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                found = Counter(words_of(text))
                counts.setdefault((language, 0), Counter()).update(found)
                for order in ORDERS:
                    mine = counts.setdefault((language, order), Counter())
                    for word, n in found.items():
                        for gram in grams(word, order):
                            mine[gram] += n
            flat = [(lang, order, gram, n) for (lang, order), c in counts.items() for gram, n in c.items()]
            lang, order, gram, n = zip(*flat) if flat else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(order, pa.int32()), pa.array(gram, pa.string()), pa.array(n, pa.int64())],
                ["lang", "order", "gram", "n"])

    counted = rows.mapInArrow(count, "lang string, order int, gram string, n long").groupBy("order", "gram", "lang").agg(F.sum("n").alias("n"))
    # words of one language are told apart by their order, not by how many there are of them
    per_gram = counted.groupBy("order", "gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    kept = per_gram.select("order", "gram", F.map_keys("by").alias("langs"), F.map_values("by").alias("counts")).toArrow()
    sums = counted.groupBy("order", "lang").agg(F.sum("n").alias("n")).collect()
    columns = (kept.column(c).to_pylist() for c in ("order", "gram", "langs", "counts"))
    rows = [(order, gram, lang, n) for order, gram, langs, counts in zip(*columns) for lang, n in zip(langs, counts)]
    return Model.of(rows, {(r["order"], r["lang"]): r["n"] for r in sums})


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row; ``model`` is sent to the executors once, as large as the words of its labelled sample."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                found = [sent.value.predict(t) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    ["doc_id", "lang_pred", "score"])
        finally:
            sent.value.unseen.clear()  # the worker lives on, with other work

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def with_language(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with two more columns, lang_pred and score (the input's own columns of these names are replaced)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept), "lang_pred string, score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                found = [sent.value.predict(t or "") for t in batch.column(kept.index(text_column)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    [*kept, "lang_pred", "score"])
        finally:
            sent.value.unseen.clear()  # the worker lives on, with other work

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def held_out(id_column: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))
