"""Packing token sequences into windows by best fit decreasing.

Documents longer than a window are first cut into full windows; what is left of each document, shorter than a
window, goes whole into the open window with the least room that still holds it, longest pieces first. A segment
tree over the remaining capacities finds that window.

Pieces of one length are alike, so the plan is made on the histogram of lengths (at most ``capacity`` rows, whatever
the input) and says which ranks of a length go into which windows; every piece then finds its place by its rank among
the pieces of its length. Ranks are counted in two steps, in slots of a hash of the id and then over the slots,
so that a length that a third of all documents have is no single task.

Defined cases: null text counts as empty, and an empty document is one piece that holds the end id alone; rows that
repeat are packed each on its own; pieces equal in id, start and text may swap places. Null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urndraw.llm.bpe import byte_letters
from urndraw.llm.common import stored, text_or_empty

#: Distinct chunks of text whose ids a task keeps; beyond it the task starts afresh.
CHUNKS = 500_000
#: The split of this vocabulary's byte-level pre-tokeniser.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Chunks of letters below this are encoded by the faster of two libraries, which agree on them.
PLAIN_BELOW = "\u0180"
#: Pieces that are numbered in one slot, on average.
SLOT = 4000


class ChunkTokens:
    """Token ids of whole texts by a ``tokenizers`` file, with the ids of repeated chunks kept.

    The byte-level pattern always starts a new token at a single space between two characters that are not white
    space, and nothing before such a place changes the ids behind it, so those chunks are encoded on their own and
    each distinct one once. A text with other white space next to a space is encoded in one go.

    Chunks of plain letters without special tokens go through a ``tiktoken`` encoding built from the same vocabulary, which
    gives the same ids in a third of the time; all else goes through ``tokenizers``.
    """

    def __init__(self, path: str, limit: int = CHUNKS) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.limit = limit
        self.known: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that start with the space of a chunk
        self.opens[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = {letter: byte for byte, letter in byte_letters().items()}
        ranks = {bytes(letters[c] for c in token): i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.fast = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk with a space in front: many in one text, which is cut again where a token starts with a space."""
        out: list[bytes] = []
        for at in range(0, len(chunks), 4096):
            some = chunks[at:at + 4096]
            text = "".join([" " + c for c in some])
            plain = max(text) < PLAIN_BELOW and not any(s in text for s in self.special)
            ids = np.array(self.fast(text) if plain else self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            cuts = [*(4 * np.flatnonzero(self.opens[ids])).tolist(), 4 * len(ids)]
            if len(cuts) != len(some) + 1:
                raise ValueError("the vocabulary joins words over a space")
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [t.split(" ") for t in texts]
        every = set().union(*split)
        new = every.difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = every
        plain = [c for c in new if c and not c[0].isspace() and not c[-1].isspace()]
        self.known.update(dict.fromkeys(new.difference(plain)))  # None: not to be cut here
        self.known.update(zip(plain, self._encode_chunks(plain)))
        out: list[bytes | None] = []
        get = self.known.__getitem__
        for chunks in split:
            first = chunks[0]
            try:
                cut = len(chunks) > 1 and first and not first[-1].isspace()
                out.append(b"".join(map(get, chunks[1:])) if cut else None)
            except TypeError:  # one of them is not to be cut
                out.append(None)
        odd = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(odd, self._encode([texts[i] for i in odd])):
            out[i] = ids
        odd_set = set(odd)
        first = [i for i in range(len(texts)) if i not in odd_set]
        for i, ids in zip(first, self._encode([split[i][0] for i in first])):
            out[i] = ids + out[i]
        return out


_TOKENS: dict[str, ChunkTokens] = {}


def tokens_of(path: str) -> ChunkTokens:
    """The one reader of ``path`` in this Python worker."""
    if path not in _TOKENS:
        _TOKENS[path] = ChunkTokens(path)
    return _TOKENS[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): each document's ids and ``end_id``, cut into full windows and a rest.

    ``ids`` are little-endian unsigned 32-bit numbers.
    """
    schema = "doc_id long, start long, length long, doc_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens_of(tokenizer_path)
        end = np.array([end_id], np.uint32).tobytes()
        parts = (batch.slice(at, 256) for batch in batches for at in range(0, batch.num_rows, 256))
        try:
            for part in parts:
                encoded = [x + end for x in encoder.encode(part.column(1).to_pylist())]
                rows = [(i, s, e) for i, x in enumerate(encoded) for s in range(0, len(x), 4 * capacity)
                        for e in (min(len(x), s + 4 * capacity),)]
                index = np.array([r[0] for r in rows], np.int64)
                start = np.array([r[1] for r in rows], np.int64) // 4
                stop = np.array([r[2] for r in rows], np.int64) // 4
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(index)), pa.array(start), pa.array(stop - start),
                     pa.array(np.array([len(x) // 4 for x in encoded], np.int64)[index]),
                     pa.array([encoded[i][s:e] for i, s, e in rows], pa.binary())],
                    ["doc_id", "start", "length", "doc_tokens", "ids"])
        finally:
            encoder.known.clear()  # the worker lives on, with other work

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return rows.mapInArrow(run, schema)


class RoomTree:
    """How many open windows have each remaining capacity; finds the smallest capacity in use from a given one up."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.counts[at] += n
            at //= 2

    def tightest(self, least: int) -> int | None:
        at = least + self.size
        if self.counts[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.counts[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.counts[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit_plan(lengths: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first window, offset): where the pieces of each length go, longest first.

    Windows filled alike stand in runs of neighbouring numbers, and a run is only cut where pieces run out, so the
    plan's size depends on ``capacity``, not on how many pieces there are.
    """
    tree, runs = RoomTree(capacity), {}
    plan, windows = [], 0

    def open_again(room: int, first: int, n: int) -> None:
        if room and n:
            runs.setdefault(room, []).append((first, n))
            tree.add(room, n)

    for length in sorted((n for n in lengths if 0 < n <= capacity), reverse=True):
        rank, left = 0, lengths[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, windows
                n = -(-left // (room // length))
                windows += n
            else:
                first, n = runs[room].pop()
                tree.add(room, -n)
            # a window that took a piece is the tightest for the next one, so each is filled before its neighbour
            fit = room // length
            full = min(n, left // fit)
            rest = left - full * fit if full < n else 0
            for at, count, each in ((first, full, fit), (first + full, 1, rest)):
                for k in range(each if count else 0):
                    plan.append((length, rank, count, at, capacity - room + k * length))
                    rank += count
                if each:
                    open_again(room - each * length, at, count)
            left -= full * fit + rest
            used = full + (rest > 0)
            open_again(room, first + used, n - used)
    return plan


def assign(pieces: DataFrame, capacity: int = 1024, slot_rows: int = SLOT) -> DataFrame:
    """Adds sequence_id and offset; ``pieces`` has doc_id, start and length (1 to ``capacity``) and any other columns.

    Full pieces take the first sequences, one each; the plan places the others behind them.
    """
    spark = pieces.sparkSession
    cut = stored(pieces, "packing")
    slots = max(1, cut.count() // slot_rows)
    # the order within a slot is that of the data, not of files or tasks: a task that runs again gives the same ranks
    order = [c for c in ("doc_id", "start", "doc_tokens", "ids_crc32") if c in cut.columns]
    slotted = cut.withColumn("slot", F.pmod(F.xxhash64("doc_id", "start"), F.lit(slots)).cast("int"))
    sizes = slotted.groupBy("length", "slot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored(sizes.select("length", "slot", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")), "packing")
    lengths = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    plan = [(n, r, c, w + lengths.get(capacity, 0), o)
            for n, r, c, w, o in best_fit_plan({n: c for n, c in lengths.items() if n < capacity}, capacity)]
    plan.append((capacity, 0, lengths.get(capacity, 0), 0, 0))
    # a step of the plan meets a slot of its length where their ranks overlap; both are counts, not pieces
    steps = spark.createDataFrame(plan, "length long, rank long, count long, window long, offset long")
    place = (
        sizes.join(steps, "length").where("rank < earlier + n and earlier < rank + count")
        .groupBy("length", "slot", "earlier").agg(F.sort_array(F.collect_list(F.struct("rank", "window", "offset"))).alias("steps"))
    )
    inside = Window.partitionBy("length", "slot").orderBy(*order)
    ranked = slotted.withColumn("position", F.row_number().over(inside) - 1)
    step = F.element_at(F.filter("steps", lambda s: s["rank"] <= F.col("earlier") + F.col("position")), -1)
    return (
        ranked.join(place, ["length", "slot"]).withColumn("step", step)
        .select(*cut.columns, (F.col("step.window") + F.col("earlier") + F.col("position") - F.col("step.rank")).alias("sequence_id"),
                F.col("step.offset").alias("offset"))
    )
