"""N-gram language model in tries of Elias-Fano coded levels, trained and asked block by block.

A level holds its contexts as a monotone sequence, a monotone pointer from each context to its first successor, and the
successors of all contexts as one sequence that is made monotone by adding to each the last value of the context before it;
all three are Elias-Fano coded (low bits packed, high bits in unary with a directory for select). A lookup finds the context,
reads two pointers, and looks for the successor of the word counted from the context's base. Beside each n-gram stands its
smoothed probability as one of some thousand steps on a logarithmic scale. A level is one buffer, and every array is a view of it,
so it can be mapped from a file as well.

Smoothing: an n-gram's own part is count / (context's count + PRIOR), to which PRIOR / (context's count + PRIOR) of the
probability by the next shorter context is added; below all stands the add-one share of the word. The first context of a document
is a start mark; contexts that were never seen pass the shorter one's value on.

Spark's part: documents are kept in blocks (numbers of their own words, compressed). N-grams of a level are counted in each
block, dealt by a hash of the whole n-gram into slices of bounded size, so that no frequent word or context is one task; the
slice's task adds up the blocks, builds its level and answers each block for the n-grams it asked, also those of documents
that are only scored. What moves is one key for each different n-gram of a block. Nothing is dropped: every n-gram counts.

Defined cases: null and empty texts have the end as their only token; repeated rows and null ids are documents like any other;
without training rows every probability is one; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urndraw.llm.blocks import packed, unpacked
from urndraw.llm.common import stored, text_or_empty

ORDER = 2
PRIOR = 8.0
#: Steps of a stored probability for each power of ten.
STEPS = 256
#: Tokens of the corpus for each slice of a level.
SLICE = 4_000_000
#: Characters of text after which a block of documents ends.
CHARS = 20_000_000
#: Marks that no word can be: before and behind a document.
START, END = b" ", b"\n"
U = np.uint64


class EliasFano:
    """A sequence of numbers that never falls: ``n`` of them, the lowest ``width`` bits of each packed, the rest in unary."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> None:
        self.n, self.width, self.low, self.high, self.ones = n, width, low, high, ones

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        width = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        low = np.zeros((n * width >> 6) + 2, U)
        if width:
            rest = values & U((1 << width) - 1)
            start = np.arange(n, dtype=U) * U(width)
            word, shift = (start >> U(6)).astype(np.int64), start & U(63)
            np.bitwise_or.at(low, word, rest << shift)
            over = shift + U(width) > U(64)
            np.bitwise_or.at(low, word[over] + 1, rest[over] >> (U(64) - shift[over]))
        tops = (values >> U(width)).astype(np.int64)
        bits = np.zeros(-(-(n + (int(tops[-1]) if n else 0) + 2) // 64) * 64, np.uint8)
        bits[tops + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(U)
        return cls(n, width, low, high, np.r_[0, np.cumsum(np.bitwise_count(high), dtype=np.int64)])

    def _select(self, before: np.ndarray, words: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The place of the k-th set bit of ``words``, which have ``before`` set bits in front of each."""
        at = np.searchsorted(before, k, side="right") - 1
        left, word, place = (k - before[at]).astype(U), words[at], at.astype(U) << U(6)
        for step in (32, 16, 8, 4, 2, 1):
            inside = np.bitwise_count(word & U((1 << step) - 1)).astype(U)
            on = left >= inside
            left = np.where(on, left - inside, left)
            word = np.where(on, word >> U(step), word)
            place += np.where(on, U(step), U(0))
        return place.astype(np.int64)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        return self._select(np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones, ~self.high, k)

    def _rest(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), U)
        start = i.astype(U) * U(self.width)
        word, shift = (start >> U(6)).astype(np.int64), start & U(63)
        both = (self.low[word] >> shift) | np.where(shift > 0, self.low[word + 1] << ((U(64) - shift) & U(63)), U(0))
        return both & U((1 << self.width) - 1)

    def at(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        return ((self._select(self.ones, self.high, i) - i).astype(U) << U(self.width)) | self._rest(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the first number that is ``x`` or more, and whether it is ``x``."""
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        top = (x >> U(self.width)).astype(np.int64)
        most = 64 * len(self.high) - int(self.ones[-1]) - 1  # zeros behind it
        beyond = top > most
        top = np.minimum(top, most)
        # numbers with one high part lie between two zeros
        low = np.where(top > 0, self._zero(np.maximum(top - 1, 0)) - np.maximum(top - 1, 0), 0)
        low, high = np.minimum(low, self.n), np.minimum(self._zero(top) - top, self.n)
        low, stop = np.where(beyond, self.n, low), np.where(beyond, self.n, high)
        high, rest = stop.copy(), x & U((1 << self.width) - 1)
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            less = self._rest(middle) < rest[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < high[open_]]
        inside = low < stop
        same = np.zeros(len(x), bool)
        same[inside] = self._rest(low[inside]) == rest[inside]
        return low, same


class Level:
    """The n-grams of one slice: (context, word) with the step of the smoothed probability; a place for each."""

    def __init__(self, contexts: EliasFano, pointers: EliasFano, words: EliasFano, steps: np.ndarray) -> None:
        self.contexts, self.pointers, self.words, self.steps = contexts, pointers, words, steps

    @classmethod
    def of(cls, context: np.ndarray, word: np.ndarray, steps: np.ndarray) -> Level:
        """From different n-grams, sorted by context, then word."""
        contexts, first = np.unique(context, return_index=True)
        pointers = np.r_[first, len(context)]
        last = (word[pointers[1:] - 1] + U(1)) if len(context) else np.zeros(0, U)
        base = np.cumsum(last, dtype=U) - last
        values = word + U(1) + np.repeat(base, np.diff(pointers))
        return cls(EliasFano.of(contexts), EliasFano.of(pointers.astype(U)), EliasFano.of(values), steps.astype(np.uint16))

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The place of each n-gram, or -1."""
        out = np.full(len(context), -1, np.int64)
        at, known = self.contexts.successor(context)
        asked = np.flatnonzero(known)
        first, end = (self.pointers.at(at[asked] + more).astype(np.int64) for more in (0, 1))
        base = np.where(first > 0, self.words.at(np.maximum(first - 1, 0)), U(0)) if len(asked) else np.zeros(0, U)
        place, same = self.words.successor(base + word[asked] + U(1))
        hit = same & (place < end)
        out[asked[hit]] = place[hit]
        return out

    def buffer(self) -> bytes:
        """All arrays behind one table of their sizes."""
        parts = [a for s in (self.contexts, self.pointers, self.words) for a in (s.low, s.high, s.ones.astype(U))]
        sizes = [(s.n, s.width) for s in (self.contexts, self.pointers, self.words)]
        head = np.array([*[x for s in sizes for x in s], *map(len, parts)], U)
        return head.tobytes() + b"".join([p.tobytes() for p in parts]) + self.steps.tobytes()

    @classmethod
    def view(cls, data) -> Level:
        """A level whose arrays are views of ``data``, which may be a memory map."""
        head, at, coded = np.frombuffer(data, U, 15), 15 * 8, []
        for i in range(3):
            arrays = []
            for size in head[6 + 3 * i:9 + 3 * i].tolist():
                arrays.append(np.frombuffer(data, U, size, at))
                at += 8 * size
            coded.append(EliasFano(int(head[2 * i]), int(head[2 * i + 1]), arrays[0], arrays[1], arrays[2].view(np.int64)))
        return cls(*coded, np.frombuffer(data, np.uint16, offset=at))


def sorted_order(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The order by context, then word; ids below 2 ** 32 are compared as one number."""
    if not len(word) or not context.any():
        return np.argsort(word, kind="stable")
    if max(int(context.max()), int(word.max())) < 1 << 32:
        return np.argsort((context << U(32)) | word, kind="stable")
    return np.lexsort((word, context))


def step_of(probability: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """1 for a probability of one, one more for each step below; 0 is kept for what is not stored."""
    return np.minimum(1 + np.rint(-np.log10(probability) * steps), 65535).astype(np.uint16)


def probability_of(step: np.ndarray, steps: int = STEPS) -> np.ndarray:
    return np.where(step > 0, 10.0 ** (-(step.astype(np.float64) - 1) / steps), 0.0)


BLOCK = "block long, doc_ids array<long>, train binary, lengths binary, tokens binary, words binary, n_tokens long, n_train long"
ASK = "slice long, block long, contexts binary, words binary, totals binary, counts binary"
#: An answer to a block, or for a null block the number of different n-grams of the slice and the sum of their counts.
ANSWER = "level int, slice long, block long, n long, total long, ids binary, counts binary, steps binary"


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()  # both treat ASCII only


def blocks(docs: DataFrame, train: Column, chars: int = CHARS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each block of documents; store it, its numbers hold for one run of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        made, task = 0, TaskContext.get().partitionId()
        ids, learned, tokens, size, index = [], [], [], 0, None

        def row() -> pa.RecordBatch:
            every = np.concatenate(tokens)
            names = np.fromiter((xxhash.xxh64_intdigest(w, 42) >> 1 for w in index), U, len(index))
            values = [np.array(learned, np.uint8), np.array([len(t) for t in tokens], np.int32), every, names]
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) | made], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 *[pa.array([packed(v)], pa.binary()) for v in values], pa.array([len(every)], pa.int64()),
                 pa.array([sum(learned)], pa.int64())],
                [c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            for name, learn, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if index is None:
                    index = defaultdict()
                    index.default_factory = index.__len__
                    index[START], index[END]
                words = _words(text)
                words.append(END)
                ids.append(name)
                learned.append(learn)
                tokens.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
                size += len(text)
                if size >= chars:
                    yield row()
                    ids, learned, tokens, size, index, made = [], [], [], 0, None, made + 1
        if ids:
            yield row()

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"),
                       text_or_empty(text_column).alias("text"))
    return rows.mapInArrow(run, BLOCK)


class Grams:
    """The n-grams of one block, level by level, as the slices' answers come in."""

    def __init__(self, row: dict) -> None:
        self.lengths = unpacked(row["lengths"], np.int32).astype(np.int64)
        self.tokens = unpacked(row["tokens"], np.int32).astype(np.int64)
        self.learned = np.repeat(unpacked(row["train"], np.uint8).astype(bool), self.lengths)
        self.first = np.zeros(len(self.tokens), bool)
        self.first[np.cumsum(self.lengths) - self.lengths] = True
        self.level = 1
        names = unpacked(row["words"], U)
        times = np.bincount(self.tokens[self.learned], minlength=len(names))
        times[0] = unpacked(row["train"], np.uint8).sum()  # the start stands before each document
        self.at = self.tokens
        self._ask(np.zeros(len(names), U), names, np.zeros(len(names), np.int64), times)

    def _ask(self, context: np.ndarray, word: np.ndarray, total: np.ndarray, times: np.ndarray) -> None:
        self.context, self.word, self.total, self.times = context, word, total, times

    def slices(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(order, ends): the level's n-grams by slice, context and word, and where each slice ends."""
        mixed = (self.context * U(0x9E3779B97F4A7C15)) ^ (self.word * U(0xC2B2AE3D27D4EB4F))
        mixed = (mixed ^ (mixed >> U(29))) * U(0xBF58476D1CE4E5B9)
        part = ((mixed >> U(32)) % U(count)).astype(np.int64)
        order = sorted_order(self.context, self.word)
        narrow = part[order].astype(np.uint16 if count <= 1 << 16 else np.int64)
        return order[np.argsort(narrow, kind="stable")], np.cumsum(np.bincount(part, minlength=count))

    def asks(self, block: int, count: int) -> Iterator[tuple]:
        order, ends = self.slices(count)
        for part, (low, high) in enumerate(zip(np.r_[0, ends[:-1]], ends)):
            if high > low:
                mine = order[low:high]
                # contexts rise within a slice; their differences are small
                contexts = np.diff(self.context[mine], prepend=U(0))
                yield part, block, *map(packed, (contexts, self.word[mine], self.total[mine], self.times[mine]))

    def take(self, answers: list[dict], count: int, offsets: np.ndarray | None) -> None:
        """The slices' answers to this level; without ``offsets`` it is the last one and has no ids."""
        order, _ = self.slices(count)
        answers = sorted(answers, key=lambda a: a["slice"])

        def whole(name: str, dtype) -> np.ndarray:
            out = np.zeros(len(order), dtype)
            out[order] = np.concatenate([np.zeros(0, dtype), *[unpacked(a[name], dtype) for a in answers]])
            return out

        self.steps = whole("steps", np.uint16)
        if offsets is not None:
            self.counts, self.ids = whole("counts", np.int64), whole("ids", np.int64)
            own = np.repeat([offsets[a["slice"]] for a in answers], [a["n"] for a in answers]).astype(np.int64)
            self.ids[order] += own
            self.ids[self.counts == 0] = -1
        if self.level == 1:
            self.word_ids, self.word_counts = self.ids, self.counts

    def longer(self) -> None:
        """Go on to the n-grams that are one word longer."""
        before = np.r_[-1, self.at[:-1]]
        before[self.first] = 0 if self.level == 1 else -1
        # the count of each token's context, 0 where it has none that was seen
        self.context_count = np.where(before >= 0, self.counts[before], 0)
        valid = (self.context_count > 0) & (self.word_ids[self.tokens] >= 0)
        keys, inverse = np.unique(before[valid] * len(self.word_ids) + self.tokens[valid], return_inverse=True)
        at = np.full(len(self.tokens), -1, np.int64)
        at[valid] = inverse
        context, word = keys // len(self.word_ids), keys % len(self.word_ids)
        times = np.bincount(inverse[self.learned[valid]], minlength=len(keys))
        self._ask(self.ids[context].astype(U), self.word_ids[word].astype(U), self.counts[context], times)
        self.at, self.level = at, self.level + 1


def _answers(level: int, last: bool, prior: float):
    """The task of a slice: add up the blocks, build the level, and look every n-gram that was asked up in it."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("slice")[0].as_py()
        asked = table.sort_by("block").to_pylist()
        contexts = [np.cumsum(unpacked(a["contexts"], U), dtype=U) for a in asked]
        words = [unpacked(a["words"], U) for a in asked]
        counts, totals = (np.concatenate([unpacked(a[c], np.int64) for a in asked]) for c in ("counts", "totals"))
        context, word = np.concatenate(contexts), np.concatenate(words)
        learned = np.flatnonzero(counts > 0)
        order = learned[sorted_order(context[learned], word[learned])]
        new = np.r_[True, (np.diff(context[order]) != 0) | (np.diff(word[order]) != 0)][:len(order)]
        starts = np.flatnonzero(new)
        summed = np.add.reduceat(counts[order], starts) if len(starts) else np.zeros(0, np.int64)
        one = order[starts]
        steps = step_of(summed / (totals[one] + prior)) if level > 1 else np.zeros(len(one), np.uint16)
        trie = Level.view(Level.of(context[one], word[one], steps).buffer())
        rows = [(level, part, None, len(one), int(summed.sum()), None, None, None)]
        for a, c, w in zip(asked, contexts, words):
            place = trie.find(c, w)
            found = place >= 0
            step, times = np.zeros(len(place), np.uint16), np.zeros(len(place), np.int64)
            step[found], times[found] = trie.steps[place[found]], summed[place[found]]
            ids = (None, None) if last else (packed(np.maximum(place, 0)), packed(times))
            rows.append((level, part, a["block"], len(place), None, *ids, packed(step)))
        return _table(rows, ANSWER_TYPES, ANSWER)

    return run


def _table(rows: list[tuple], types: list, schema: str) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * len(types)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in schema.split(", ")])


ASK_TYPES = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
ANSWER_TYPES = [pa.int32(), *[pa.int64()] * 4, *[pa.binary()] * 3]


def _resumed(left: pa.Table, right: pa.Table) -> Iterator[tuple[dict, Grams, list[list]]]:
    """Each block as it was made, and the answers it has by level."""
    told = right.to_pylist()
    levels = [[a for a in told if a["level"] == k + 1] for k in range(max((a["level"] for a in told), default=0))]
    for row in left.to_pylist():
        yield row, Grams(row), levels


def score(docs: DataFrame, train: Column | None = None, order: int = ORDER, prior: float = PRIOR, slice_tokens: int = SLICE,
          chars: int = CHARS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score): base 10 logarithms for every row of ``docs``, by a model
    of n-grams up to ``order`` words of the rows where ``train`` is true (all, if none is given)."""
    train = F.lit(True) if train is None else train
    made = stored(blocks(docs, train, chars, id_column, text_column), "ngrams")
    sums = made.agg(F.sum("n_tokens").alias("tokens"), F.sum("n_train").alias("train")).first()
    slices = max(1, -(-(sums["tokens"] or 0) // slice_tokens))
    offsets: list[np.ndarray] = []  # where the ids of each slice of a level start; one number a slice
    answers: list[DataFrame] = []
    tokens = words = 0

    def first_asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _table(list(Grams(row).asks(row["block"], slices)), ASK_TYPES, ASK).to_batches()

    def more_asks(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for row, grams, levels in _resumed(left, right):
            for answer, starts in zip(levels, offsets):
                grams.take(answer, slices, starts)
                grams.longer()
            rows += grams.asks(row["block"], slices)
        return _table(rows, ASK_TYPES, ASK)

    def told() -> DataFrame:
        every = reduce(DataFrame.unionAll, answers).where("block is not null")
        return every.select("level", "slice", F.col("block").alias("asker"), "n", "ids", "counts", "steps")

    bodies = made.drop("doc_ids", "n_tokens", "n_train")
    for level in range(1, order + 1):
        if level == 1:
            asks = bodies.mapInArrow(first_asks, ASK)
        else:
            asks = bodies.groupBy("block").cogroup(told().groupBy("asker")).applyInArrow(more_asks, ASK)
        last = level == order and level > 1
        answers.append(stored(asks.groupBy("slice").applyInArrow(_answers(level, last, prior), ANSWER), "ngrams"))
        if not last:
            sizes = answers[-1].where("block is null").select("slice", "n", "total").collect()
            own = np.zeros(slices, np.int64)
            for row in sizes:
                own[row["slice"]] = row["n"]
            offsets = [*offsets, np.cumsum(own) - own]
            if level == 1:  # the start is no token
                tokens = sum(row["total"] for row in sizes) - (sums["train"] or 0)
                words = int(own.sum()) - (1 if sums["train"] else 0)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for row, grams, levels in _resumed(left, right):
            grams.take(levels[0], slices, offsets[0])
            share = ((grams.word_counts + 1) / (tokens + words + 1))[grams.tokens]
            starts = np.cumsum(grams.lengths) - grams.lengths
            known = np.add.reduceat((grams.word_counts[grams.tokens] > 0).astype(np.int64), starts)
            base, probability = np.add.reduceat(np.log10(share), starts), share
            for level in range(2, order + 1):
                grams.longer()
                grams.take(levels[level - 1] if level <= len(levels) else [], slices, offsets[level - 1] if level < order else None)
                own = np.zeros(len(grams.tokens))
                own[grams.at >= 0] = probability_of(grams.steps[grams.at[grams.at >= 0]])
                weight = prior / (grams.context_count + prior)
                probability = np.where(grams.context_count > 0, own + weight * probability, probability)
            n = len(grams.lengths)
            columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(unpacked(row["train"], np.uint8).astype(bool)), pa.array(grams.lengths),
                       pa.array(known), pa.array(np.full(n, tokens, np.int64)), pa.array(base), pa.array(np.add.reduceat(np.log10(probability), starts))]
            tables.append(pa.table(columns, [c.split()[0] for c in SCORED.split(", ")]))
        return pa.concat_tables(tables) if tables else _table([], SCORED_TYPES, SCORED)

    return made.drop("n_tokens", "n_train").groupBy("block").cogroup(told().groupBy("asker")).applyInArrow(scored, SCORED)


SCORED = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
SCORED_TYPES = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
