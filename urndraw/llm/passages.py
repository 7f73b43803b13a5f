"""Repeated passages, by hashing normalised units of text and keeping the earliest occurrence of each.

A unit is a line; a line is divided further after words that a hash of the word itself picks (about one in ``every``), so that a
passage that starts in the middle of a line falls into the same units as its copies, apart from its two ends. Units are
normalised to lower-case letters and digits. Units of fewer than ``least`` words are too common to say anything: they are not
hashed, and go with the units around them. A unit's digest is grouped over all documents and its lowest (doc_id, position)
is kept. What is removed is every stretch of neighbouring units that all occurred earlier and that has ``passage`` words or
more, so that chance repeats of single units leave a document as it is. Offsets of what goes and of what stays count code points
of the original text.

With ``among``, as the query has it, a line is cut instead before the pair of words with the smallest hash of every ``among``
neighbouring pairs, so no unit of a long line is longer than that and copies are cut alike but for their ends. Every unit is numbered and
has a digest, and a short one's takes in the unit before it: a stretch holds nothing that did not occur earlier. Both ends
together lose 2 * (among + 1) + least - 2 words at most, so a passage of 52 words with the same lines always has 20 left.

Defined cases: null text has no units and stays null; null ids rank first; rows equal in id and text are one document listed
more than once and are all treated alike; repeats inside one document count like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urndraw.llm.common import keyed, later_occurrences, stored, text_or_empty

EVERY, LEAST, PASSAGE = 6, 4, 20
#: Pairs of words among which the one with the smallest hash cuts; what the query takes.
AMONG = 14

_word = re.compile(r"[^\W_]+|\n")
#: Words whose digest a Python worker keeps.
WORDS = 500_000
_ends: dict[tuple[str, int], bool] = {}
_hashes: dict[str, int] = {}


def ends_unit(word: str, every: int) -> bool:
    """Whether a unit ends after this word, as its own hash has it."""
    found = _ends.get((word, every))
    if found is None:
        import xxhash

        if len(_ends) > WORDS:
            _ends.clear()
        found = _ends[word, every] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 7) % every == 0
    return found


def units(text: str, every: int = EVERY, least: int = LEAST) -> list[tuple[int, int, int, int]]:
    """(digest, start, end, words) of each unit that has ``least`` words or more."""
    import xxhash

    out: list[tuple[int, int, int, int]] = []
    words: list[str] = []
    start = end = 0
    # lower-casing a letter may make two of it, so words are found first and changed afterwards
    for m in _word.finditer(text):
        word = m[0]
        if word != "\n":
            if not words:
                start = m.start()
            end = m.end()
            word = word.lower()
            words.append(word)
            if not ends_unit(word, every):
                continue
        if len(words) >= least:
            digest = xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))
            out.append((digest - (1 << 63), start, end, len(words)))
        if words:
            words = []
    if len(words) >= least:
        out.append((xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")) - (1 << 63), start, end, len(words)))
    return out


def all_units(text: str, among: int = AMONG, least: int = LEAST) -> list[tuple[int, int, int, int]]:
    """(digest, start, end, words) of every unit: each line, cut before the pair of words whose hash is the smallest of ``among``
    neighbouring pairs. The digest of a unit of fewer than ``least`` words takes in the unit before it, on an earlier line too."""
    import xxhash

    words, starts, ends, lines, line = [], [], [], [], 0
    for m in _word.finditer(text):
        word = m[0]
        if word == "\n":
            line += 1
            continue
        words.append(word.lower())
        starts.append(m.start())
        ends.append(m.end())
        lines.append(line)
    if not words:
        return []
    of = np.array(lines)
    cut = np.r_[True, of[1:] != of[:-1]]
    if len(words) > among:
        hashes = np.fromiter((hash_of(w) for w in words), np.uint64, len(words))
        pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
        pairs ^= pairs >> np.uint64(29)
        pairs *= np.uint64(0xBF58476D1CE4E5B9)
        whole = np.flatnonzero(of[among:] == of[:len(of) - among])  # windows within one line
        for at in range(0, len(whole), 1 << 16):
            some = whole[at:at + (1 << 16)]
            seen = np.lib.stride_tricks.sliding_window_view(pairs, among)[some, ::-1]
            cut[some + among - 1 - seen.argmin(axis=1)] = True  # the rightmost of equal ones
    edges = [*np.flatnonzero(cut).tolist(), len(words)]
    out, before = [], ""
    for a, b in zip(edges, edges[1:]):
        unit = " ".join(words[a:b])
        digest = xxhash.xxh3_64_intdigest((unit if b - a >= least else f"{before}\n{unit}").encode("utf-8", "surrogatepass"))
        out.append((digest - (1 << 63), starts[a], ends[b - 1], b - a))
        before = unit
    return out


def hash_of(word: str) -> int:
    found = _hashes.get(word)
    if found is None:
        import xxhash

        if len(_hashes) > WORDS:
            _hashes.clear()
        found = _hashes[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 7)
    return found


def hashed_units(docs: DataFrame, every: int = EVERY, least: int = LEAST, id_column: str = "doc_id", text_column: str = "text",
                 among: int | None = None) -> DataFrame:
    """(doc_id, version, at, digest, start, end, words): one row per unit, numbered within its document."""
    schema = "doc_id long, version long, at int, digest long, start int, end int, words int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [units(t, every, least) if among is None else all_units(t, among, least) for t in batch.column(2).to_pylist()]
            of = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
            digests, starts, ends, words = zip(*(u for f in found for u in f)) if len(of) else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of), batch.column(1).take(of), pa.array([i for f in found for i in range(len(f))], pa.int32()),
                 pa.array(digests, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(words, pa.int32())],
                ["doc_id", "version", "at", "digest", "start", "end", "words"])

    return keyed(docs, id_column, text_column).mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, every: int = EVERY, least: int = LEAST, passage: int = PASSAGE, id_column: str = "doc_id",
                   text_column: str = "text", among: int | None = None) -> DataFrame:
    """(doc_id, version, removed): the repeated stretches of each document that has any, as an array of (start, end)."""
    found = stored(hashed_units(docs, every, least, id_column, text_column, among), "passages")
    both = later_occurrences(found, "digest", ["doc_id", "version", "at"]).groupBy("doc_id", "version").agg(
        F.collect_set(F.struct("at", "start", "end", "words")).alias("units"))  # bounded by the document's text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for marked in batch.column(2).to_pylist():
                spans.append([{"start": a, "end": b} for a, b in stretches(marked, passage)])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)], ["doc_id", "version", "removed"])

    return both.mapInArrow(run, "doc_id long, version long, removed array<struct<start:int,end:int>>").where("size(removed) > 0")


def stretches(marked: list[dict], passage: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring units with ``passage`` words or more."""
    run: list[dict] = []
    for unit in [*sorted(marked, key=lambda u: u["at"]), None]:
        if run and (unit is None or unit["at"] != run[-1]["at"] + 1):
            if sum(u["words"] for u in run) >= passage:
                yield run[0]["start"], run[-1]["end"]
            run = []
        run.append(unit)


def dedup_passages(docs: DataFrame, every: int = EVERY, least: int = LEAST, passage: int = PASSAGE, id_column: str = "doc_id",
                   text_column: str = "text", among: int | None = None) -> DataFrame:
    """(doc_id, text, removed, kept) for every row: the text without repeats, and arrays of (start, end) in the original."""
    spans = stored(repeated_spans(docs, every, least, passage, id_column, text_column, among), "passages")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text_column)).alias("version"),
                       F.col(text_column).cast("string").alias("text"))
    same = rows["doc_id"].eqNullSafe(spans["doc_id"]) & (rows["version"] == spans["version"])
    # by sorting at every size, so that the need for disk grows evenly with the input
    joined = rows.join(spans.hint("merge"), same, "left").select(rows["doc_id"], "text", "removed")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone, kept = [], [], []
            for text, removed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                cuts = sorted((s["start"], s["end"]) for s in removed or [])
                edges = [0, *(x for cut in cuts for x in cut), len(text or "")]
                stay = [(a, b) for a, b in zip(edges[::2], edges[1::2]) if b > a]
                texts.append(text if not cuts else "".join(text[a:b] for a, b in stay))
                gone.append([{"start": a, "end": b} for a, b in cuts])
                kept.append([{"start": a, "end": b} for a, b in stay])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(gone, kind), pa.array(kept, kind)], ["doc_id", "text", "removed", "kept"])

    span = "array<struct<start:int,end:int>>"
    return joined.mapInArrow(run, f"doc_id long, text string, removed {span}, kept {span}")
