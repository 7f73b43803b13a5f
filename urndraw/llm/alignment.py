"""Two tokenizers over the same texts: groups of tokens that end together, and how often each two ids overlap.

Interval coalescing: the byte intervals of all tokens of both sides are sorted by start, a running maximum of their ends is
kept, and a group ends where the next start has reached that maximum; within a group every overlap of an interval of one side
with one of the other is a link.

Both tokenizers always end a token where plain letters are followed by a space or a line break, so texts are cut there and
each different unit is encoded and aligned once in a block of documents, many of them in one go; a document is the sequence
of its units. Text next to other white space or rarer letters is not cut.

Spark's part: one pass writes a row for each block with its units, its documents and its different pairs of ids; the pairs are
counted over all blocks (combined before the shuffle, some hundred thousand pairs a block whatever its number of links), the
best count of each id of the second side is a broadcast of at most one number for each id of its vocabulary, and the counts
return to the blocks, where documents are summed up.

Defined cases: null and empty texts, and texts whose tokens do not spell a space and the text on both sides, have no tokens:
zeros and an empty digest. Repeated rows and null ids are documents like any other. An empty table gives no rows. Other
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urndraw.llm.blocks import CHARS, ends_to_sums, packed, spread, unpacked
from urndraw.llm.bpe import byte_letters
from urndraw.llm.common import stored
from urndraw.llm.packing import PLAIN_BELOW, tokens_of

#: Different units after which a task forgets those it knows.
UNITS = 600_000
#: Units that are encoded together.
TOGETHER = 4096
#: A pair of ids is one number, the id of the first side above this many bits of the second.
PAIR_BITS = 20
#: Letters behind which a text may be cut.
PLAIN = r"!-~¡-ɏ"
_ONLY_PLAIN = re.compile(f"[ \n{PLAIN}]*").fullmatch
_UNITS = re.compile("[ \n]*[^ \n]+|[ \n]+").findall
_CUT = re.compile(f"(?<=[{PLAIN}])(?=[ \n])")


def units_of(text: str) -> list[str]:
    """``text``, cut before every space or line break that follows a plain letter."""
    return _UNITS(text) if _ONLY_PLAIN(text) else _CUT.split(text)


def coalesce(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a_group, b_group, a_link, b_link): the group of each token, and the index pairs of tokens that overlap, in order.

    Tokens are given by their ends; every one has a byte or more, and both sides end at the same place.
    """
    ends = np.concatenate([a_ends, b_ends])
    starts = np.concatenate([np.r_[0, a_ends[:-1]], np.r_[0, b_ends[:-1]]])
    order = np.lexsort((ends, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.r_[False, starts[order][1:] >= reached[:-1]]
    group = np.empty(len(ends), np.int64)
    group[order] = np.cumsum(breaks)
    # a token of the first side overlaps those of the second that end behind its start and start before its end
    first = np.searchsorted(b_ends, starts[:len(a_ends)], side="right")
    last = np.searchsorted(starts[len(a_ends):], a_ends, side="left")
    return group[:len(a_ends)], group[len(a_ends):], np.repeat(np.arange(len(a_ends)), last - first), spread(first, last - first)


class Pairing:
    """The two tokenizers: a byte-level BPE file read by ``tokenizers`` and a piece model read by ``sentencepiece``."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(byte_path)
        self.exact.encode_special_tokens = True
        self.exact.no_truncation()
        self.exact.no_padding()
        self.fast = tokens_of(byte_path).fast
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        vocabulary = self.exact.get_vocab(with_added_tokens=True)
        self.a_size = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.a_size[i] = sum(1 if c in byte_of else len(c.encode()) for c in token)
        self.pieces = SentencePieceProcessor(model_file=piece_path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.b_size = np.array([len(b) for b in self.b_bytes])
        # where a piece goes on from a letter to a space or holds a line break, texts can not be cut
        self.cuts = not any("▁" in p.lstrip("▁") or "\n" in p for p in names)

    def _a_ids(self, text: str) -> np.ndarray:
        plain = max(text) < PLAIN_BELOW
        return np.array(self.fast(text) if plain else self.exact.encode(text, add_special_tokens=False).ids, np.int64)

    def _encoded(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides for a text that starts with a space; none if they do not spell it."""
        a, b = self._a_ids(text), self.pieces.encode(text[1:], num_threads=1)
        data = text.encode()
        if b"".join([self.b_bytes[i] for i in b]) != data or self.a_size[a].sum() != len(data):
            return None
        return a, np.array(b, np.int64)

    def units(self, units: list[str]) -> tuple[list[str | None], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For units as they follow each other in texts: each one's groups as text (none if it is not spelt), its numbers of
        tokens of both sides, of groups and of links, and the pairs of all links, one unit after the other."""
        lead = " a"  # so that each unit, also one that starts with a line break, stands in a text
        text = lead + "".join(units)
        found = self._encoded(text)
        if found is None:
            if len(units) == 1:
                none = np.zeros(1, np.int64)
                return [None], none, none, none, none, np.zeros(0, np.int64)
            half = len(units) // 2
            left, right = self.units(units[:half]), self.units(units[half:])
            return (left[0] + right[0], *[np.concatenate(both) for both in zip(left[1:], right[1:])])
        a, b = found
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        stops = np.cumsum([len(lead), *[len(u.encode()) for u in units]])
        a_stop, b_stop = np.searchsorted(a_ends, stops), np.searchsorted(b_ends, stops)
        if (a_ends[a_stop] != stops).any() or (b_ends[b_stop] != stops).any():
            raise ValueError("a token goes over the end of a unit")
        a_group, b_group, a_link, b_link = coalesce(a_ends, b_ends)
        groups = a_group[-1] + 1
        a_first, b_first = np.searchsorted(a_group, np.arange(groups + 1)).tolist(), np.searchsorted(b_group, np.arange(groups + 1)).tolist()
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        written = [
            a_text[p] + "|" + b_text[r] if q - p == 1 == s - r else ",".join(a_text[p:q]) + "|" + ",".join(b_text[r:s])
            for p, q, r, s in zip(a_first, a_first[1:], b_first, b_first[1:])]
        by_unit = a_group[a_stop] + 1
        told = [";".join(written[p:q]) for p, q in zip(by_unit.tolist(), by_unit[1:].tolist())]
        pairs = (a[a_link] << PAIR_BITS) | b[b_link]
        links = np.searchsorted(a_link, a_stop, side="right")
        return told, np.diff(a_stop), np.diff(b_stop), np.diff(by_unit), np.diff(links), pairs[links[0]:]


class Block:
    """Documents of one block: each different unit once, and the units of each document."""

    def __init__(self, pairing: Pairing) -> None:
        self.pairing, self.index = pairing, {}
        self.told: list[str | None] = []
        self.counts: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.start()

    def start(self) -> None:
        if len(self.told) > UNITS:
            self.index, self.told, self.counts, self.pairs = {}, [], [], []
        self.ids, self.digests, self.sequences, self.chars = [], [], [], 0

    def learn(self, units: list[str]) -> None:
        new = [u for u in dict.fromkeys(units) if u not in self.index]
        # units that end in white space or start with a rare letter are no neighbours of others
        alone = [u for u in new if len(u) > 1000 or not re.fullmatch(f"[{PLAIN}]", u[-1]) or u[0] not in " \n"]
        apart = set(alone)
        together = [u for u in new if u not in apart]
        for some in [*[together[at:at + TOGETHER] for at in range(0, len(together), TOGETHER)], *[[u] for u in alone]]:
            told, *counts, pairs = self.pairing.units(some)
            for unit in some:
                self.index[unit] = len(self.index)
            self.told += told
            self.counts.append(np.stack(counts))
            self.pairs.append(pairs)

    def add(self, names: list[int | None], texts: list[str | None]) -> None:
        split = []
        for text in texts:
            split.append([] if not text else units_of(" " + text) if self.pairing.cuts else [" " + text])
            self.chars += len(text or "")
        self.learn([u for units in split for u in units])
        for name, units in zip(names, split):
            at = list(map(self.index.__getitem__, units))
            told = list(map(self.told.__getitem__, at))
            if None in told:
                at, told = [], []
            self.ids.append(name)
            self.digests.append(hashlib.sha256(";".join(told).encode()).hexdigest() if told else "")
            self.sequences.append(np.array(at, np.int32))

    def row(self, number: int) -> pa.RecordBatch:
        """The block as one row: its documents, and its different pairs of ids with the number of their links."""
        lengths = np.array([len(s) for s in self.sequences], np.int64)
        seen, units = np.unique(np.concatenate([np.zeros(0, np.int32), *self.sequences]), return_inverse=True)
        if len(seen):
            counts, every = np.concatenate(self.counts, axis=1), np.concatenate(self.pairs)
        else:
            counts, every = np.zeros((4, 0), np.int64), np.zeros(0, np.int64)
        links = counts[3][seen]
        pairs, at = np.unique(every[spread((np.cumsum(counts[3]) - counts[3])[seen], links)], return_inverse=True)
        times = np.bincount(units, minlength=len(seen))
        together = np.bincount(at, weights=np.repeat(times, links), minlength=len(pairs)).astype(np.int64)
        sums = [ends_to_sums(c[seen][units], lengths) for c in counts]
        body = [pa.array([packed(v)], pa.binary()) for v in (
            lengths.astype(np.int32), units.astype(np.int32), links.astype(np.int32), at.astype(np.int32))]
        listed = [pa.array([list(self.ids)], pa.list_(pa.int64())), pa.array([self.digests], pa.list_(pa.string()))]
        listed += [pa.array([s], pa.list_(pa.int64())) for s in sums]
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *listed, *body, pa.array([pairs], pa.list_(pa.int64())), pa.array([together], pa.list_(pa.int64()))],
            BLOCK_NAMES)


BLOCK_NAMES = ["block", "doc_ids", "digests", "n_a", "n_b", "n_groups", "n_links", "lengths", "units", "links", "places", "pairs", "times"]
BLOCK_SCHEMA = ("block long, doc_ids array<long>, digests array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, "
                "n_links array<long>, lengths binary, units binary, links binary, places binary, pairs array<long>, times array<long>")
RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
_PAIRINGS: dict[tuple[str, str], Pairing] = {}


def pairing_of(byte_path: str, piece_path: str) -> Pairing:
    """The one pairing of the two files in this Python worker."""
    key = (byte_path, piece_path)
    if key not in _PAIRINGS:
        _PAIRINGS[key] = Pairing(byte_path, piece_path)
    return _PAIRINGS[key]


def blocks(docs: DataFrame, byte_path: str, piece_path: str, chars: int = CHARS, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """One row for each block of documents; store it, its numbers hold for one run of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, made, task = Block(pairing_of(byte_path, piece_path)), 0, TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                block.add(part.column(0).to_pylist(), part.column(1).to_pylist())
                if block.chars >= chars or len(block.told) > UNITS:
                    yield block.row((task << 32) | made)
                    made += 1
                    block.start()
        if block.ids:
            yield block.row((task << 32) | made)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, BLOCK_SCHEMA)


def pair_counts(made: DataFrame) -> DataFrame:
    """(pair, n, best): how many links hold each pair of ids, and whether no pair with its second id has more."""
    counted = made.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(
        F.sum("p.times").alias("n"))
    counted = stored(counted, "alignment")
    second = F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1).alias("second")
    # one row for each id of the second vocabulary at most, which bounds the broadcast
    most = counted.groupBy(second).agg(F.max("n").alias("most"))
    return counted.select("pair", "n", second).join(F.broadcast(most), "second").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _summed(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a block with the counts of their links."""
    tables = []
    places, n, best = (right.column(c).to_numpy() for c in ("place", "n", "best"))
    counts, wins = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    counts[places], wins[places] = n, best
    for row in left.to_batches(max_chunksize=1):
        value = {c: row.column(c)[0] for c in BLOCK_NAMES if c not in ("block", "pairs", "times")}
        lengths, units, links, at = (unpacked(value[c].as_py(), np.int32).astype(np.int64) for c in ("lengths", "units", "links", "places"))
        summed = [ends_to_sums(ends_to_sums(v[at], links)[units], lengths) for v in (wins, counts)]
        kept = [value[c].values for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
        tables.append(pa.table([*kept, *map(pa.array, summed), value["digests"].values], RESULT))
    return pa.concat_tables(tables) if tables else pa.table(
        [pa.array([], pa.int64())] * 7 + [pa.array([], pa.string())], RESULT)


def align(docs: DataFrame, byte_path: str, piece_path: str, chars: int = CHARS, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row for each row of ``docs``."""
    made = stored(blocks(docs, byte_path, piece_path, chars, id_column, text_column), "alignment")
    counts = pair_counts(made)
    asked = made.select(F.col("block").alias("asker"), F.posexplode("pairs").alias("place", "pair"))
    told = asked.join(counts, "pair").select("asker", "place", "n", F.col("best").cast("int").alias("best"))
    bodies = made.drop("pairs", "times")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return bodies.groupBy("block").cogroup(told.groupBy("asker")).applyInArrow(_summed, schema)
