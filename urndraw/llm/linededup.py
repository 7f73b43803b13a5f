"""Repeated runs of lines, found by winnowing over line hashes.

Blank lines aside, every ``window`` neighbouring lines have a smallest line hash, and that line's position is a fingerprint of
the document: any run of ``window`` lines or more that stands twice has a fingerprint in common at the same place. Fingerprints
that stand at two positions or more are joined to their windows, which extend a match from the fingerprint to both sides;
a window that occurred earlier is a match, and neighbouring matches make up the whole run. A line of ``long`` words or more is a
window by itself, whatever stands beside it. What is deleted is every line of every run of ``window`` lines or more, and every
long line, that occurred at a lower (doc_id, position).

Windows of equal content meet by their digest, never by pairs, so a passage in a third of all documents costs one row for
each of its windows.

Defined cases: lines are compared without white space around them, and case and inner spaces count; blank lines between two
deleted lines of one match go with them; null text stays null; null ids rank first; rows equal in id and text are one document
listed more than once and are all treated alike; shorter repeats and single short lines stay; an empty table stays empty; columns of
the input are carried along whatever their names, but for n_lines and n_removed, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urndraw.llm.common import keyed, later_occurrences, stored, text_or_empty

WINDOW, LONG = 2, 20
BLANKS = " \t\r\f\v"


def filled_lines(text: str) -> tuple[list[str], list[int]]:
    """All lines, and the numbers of those that are not blank."""
    lines = text.split("\n")
    return lines, [i for i, line in enumerate(lines) if line.strip(BLANKS)]


def winnowed(text: str, window: int, long: int = LONG) -> list[tuple[bytes, int, bytes, int, int]]:
    """(fingerprint, its position, digest of the window, the window's first position and number of lines), positions among filled lines."""
    import xxhash

    lines, filled = filled_lines(text)
    bare = [lines[i].strip(BLANKS).encode("utf-8", "surrogatepass") for i in filled]
    hashes = [xxhash.xxh3_128_digest(line) for line in bare]
    out = []
    for at in range(len(hashes) - window + 1):
        part = hashes[at:at + window]
        least = min(part)
        place = at + window - 1 - part[::-1].index(least)  # the rightmost of equal ones
        out.append((least, place, xxhash.xxh3_128_digest(b"".join(part)), at, window))
    if window > 1:
        out += [(h, at, h, at, 1) for at, (line, h) in enumerate(zip(bare, hashes)) if len(line) >= 2 * long - 1 and len(line.split()) >= long]
    return out


def without(text: str, starts: list[dict]) -> tuple[str, int]:
    """The text without the windows given by their first filled line and number of lines, and how many filled lines went."""
    lines, filled = filled_lines(text)
    gone: set[int] = set()
    for start in starts:
        gone.update(range(filled[start["at"]], filled[start["at"] + start["n"] - 1] + 1))
    return "\n".join(line for i, line in enumerate(lines) if i not in gone), sum(i in gone for i in filled)


def repeated_windows(docs: DataFrame, window: int = WINDOW, long: int = LONG, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, version, starts): the matches of each document that occurred earlier, by their first filled line and number of lines."""
    schema = "doc_id long, version long, print binary, place int, digest binary, at int, n int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnowed(t, window, long) for t in batch.column(2).to_pylist()]
            of = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
            prints, places, digests, starts, sizes = zip(*(x for f in found for x in f)) if len(of) else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of), batch.column(1).take(of), pa.array(prints, pa.binary()), pa.array(places, pa.int32()),
                 pa.array(digests, pa.binary()), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32())],
                ["doc_id", "version", "print", "place", "digest", "at", "n"])

    windows = stored(keyed(docs, id_column, text_column).mapInArrow(run, schema), "linededup")
    place = F.struct("doc_id", "version", "place")
    shared = windows.groupBy("print").agg(F.min(place).alias("a"), F.max(place).alias("b")).where(~F.col("a").eqNullSafe(F.col("b")))
    extended = windows.join(stored(shared.select("print"), "linededup"), "print", "left_semi").select("doc_id", "version", "digest", "at", "n")
    later = later_occurrences(stored(extended, "linededup"), "digest", ["doc_id", "version", "at"])
    return later.groupBy("doc_id", "version").agg(F.collect_set(F.struct("at", "n")).alias("starts"))


def dedup_lines(docs: DataFrame, window: int = WINDOW, long: int = LONG, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with its text column shortened, and the counts n_lines and n_removed of filled lines.

    Columns of the input with the names n_lines and n_removed are replaced.
    """
    marks = stored(repeated_windows(docs, window, long, id_column, text_column), "linededup")
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    at = names.index(text_column)
    plain = docs.select(*[F.col(f"`{c}`") for c in names])
    packed = plain.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.xxhash64(text_or_empty(f"`{text_column}`")).alias("version"))
    same = packed["doc_id"].eqNullSafe(marks["doc_id"]) & (packed["version"] == marks["version"])
    # by sorting at every size, so that the need for disk grows evenly with the input
    joined = packed.join(marks.hint("merge"), same, "left").select("row", "starts")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, gone = [], [], []
            values = batch.column(0).flatten()
            for text, starts in zip(values[at].to_pylist(), batch.column(1).to_pylist()):
                kept, n = (text, 0) if not starts else without(text, starts)
                texts.append(kept)
                totals.append(0 if text is None else len(filled_lines(text)[1]))
                gone.append(n)
            columns = [c if i != at else pa.array(texts, pa.string()) for i, c in enumerate(values)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(totals, pa.int64()), pa.array(gone, pa.int64())], [*names, "n_lines", "n_removed"])

    return joined.mapInArrow(run, fields + ", n_lines long, n_removed long")
